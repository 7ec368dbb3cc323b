import base64
import gzip
import hashlib
import random
import time

from millrace.llm import warc


def record(n, payload, kind="response", more=""):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{n}>\r\nWARC-Payload-Digest: sha1:{digest}\r\n{more}Content-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def ids(data):
    return [warc._page(f.headers["warc-record-id"]) for f in warc.salvage(data) if f.kind == "record"]


def gaps(data):
    return [(f.offset, f.length) for f in warc.salvage(data) if f.kind == "gap"]


def test_plain_and_gzip_archives():
    parts = [record(n, b"<p>%d</p>" % n * n) for n in range(6)]
    for data in (b"".join(parts), b"".join(map(gzip.compress, parts)), gzip.compress(b"".join(parts)), parts[0] + gzip.compress(parts[1])):
        assert gaps(data) == []
    assert ids(b"".join(parts)) == ids(b"".join(map(gzip.compress, parts))) == ids(gzip.compress(b"".join(parts))) == list(range(6))
    assert list(warc.salvage(b"")) == []


def test_salvage_recovers_later_records():
    parts = [record(n, b"x" * 50) for n in range(5)]
    for pack in (bytes, gzip.compress):
        own = [pack(p) for p in parts]
        starts = [sum(map(len, own[:i])) for i in range(6)]
        broken = bytearray(b"".join(own))
        broken[starts[2] - 12 - (pack is bytes) * 10] ^= 0xFF  # inside record 1
        assert ids(bytes(broken)) == [0, 2, 3, 4]
        assert gaps(bytes(broken)) == [(starts[1], len(own[1]))]
        cut = b"".join(own)[: starts[4] + 30]
        assert ids(cut) == [0, 1, 2, 3] and gaps(cut) == [(starts[4], 30)]
        noise = b"junk" + own[0] + b"more\x1f\x8b\x08junk" + own[1]
        assert ids(noise) == [0, 1] and gaps(noise)[0] == (0, 4)


def test_records_before_the_break_of_a_member():
    parts = [record(n, random.Random(n).randbytes(3000)) for n in range(9)]
    member = gzip.compress(b"".join(parts))
    after = gzip.compress(record(9, b"later"))
    for cut in (len(member) * 2 // 3, len(member) - 5):
        assert ids(member[:cut])[:5] == [0, 1, 2, 3, 4] and gaps(member[:cut]) == [(0, cut)]
        broken = bytearray(member)
        broken[cut] ^= 0xFF
        found = ids(bytes(broken) + after)
        assert found[:5] == [0, 1, 2, 3, 4] and found[-1] == 9 and len(found) == len(set(found))
        assert gaps(bytes(broken) + after) == [(0, len(member))]
    # without a digest nothing in a broken member can be trusted
    bare = b"".join(p.replace(b"WARC-Payload-Digest", b"X-Other") for p in parts)
    assert ids(gzip.compress(bare)) == list(range(9)) and ids(gzip.compress(bare)[:-9]) == []


def test_many_members_take_linear_time():
    rng = random.Random(4)
    members = [gzip.compress(record(n, rng.randbytes(8000)), 1) for n in range(4000)]
    start = time.perf_counter()
    assert len(ids(b"".join(members))) == 4000
    assert time.perf_counter() - start < 4


def test_gaps_are_a_table(spark, tmp_path):
    parts = [record(n, b"x" * 50) for n in range(3)]
    (tmp_path / "a.warc").write_bytes(parts[0] + b"noise" + parts[1])
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(parts[2])[:-3])
    records, lost = warc.read_records(spark, str(tmp_path))
    assert sorted(r.page_id for r in records.collect()) == [0, 1, 2]
    assert sorted((r.start, r.length, r.reason) for r in lost.collect()) == [(0, len(gzip.compress(parts[2])) - 3, "gzip member without end"), (len(parts[0]), 5, "no version line or gzip member")]


def test_null_ids_and_skewed_sizes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MOST_BYTES", 60_000)
    rows = [(None, "u", "same"), (4, "u", "same"), (None, "u", "alone"), (None, "u", "twice"), (None, None, "twice"), (7, "u", "z" * 30_000)] + [(100 + i, "u", f"p{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_warc(df, str(tmp_path / "w"))
    assert max(p.stat().st_size for p in (tmp_path / "w").glob("part-*")) < 60_000
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_warc(spark, str(tmp_path / "w")).filter("page_id IS NULL OR page_id < 100").collect()]
    assert sorted(got, key=str) == sorted([(None, 4, "revisit", 4), (4, 4, "response", None), (None, 5, "response", None), (None, 5, "response", None), (None, 5, "response", None), (7, 30_000, "response", None)], key=str)


def test_every_byte_is_a_record_or_a_gap():
    rng = random.Random(1)
    whole = b"".join(record(n, bytes(rng.randrange(256) for _ in range(40))) for n in range(8))
    for _ in range(200):
        data = bytearray(whole)
        for _ in range(rng.randrange(4)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        spans = [(f.offset, f.length) for f in warc.salvage(bytes(data))]
        at = 0
        for offset, length in spans:
            assert offset == at
            at += length
        assert at == len(data)


def test_round_trip(spark, tmp_path):
    pages = [(1, "http://a", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b\r\nEvil: 1", None), (4, "http://c", ""), (5, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"), (6, "u", "é" * 100000), (7, "u", "<p>x</p>"), (8, "u", "y"), (8, "u", "y")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, digest string")
    warc.write_warc(df, str(tmp_path / "w"))
    got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert all(r.kind == "record" for r in got) and len(got) == len(pages)
    html = {i: (h or "").encode() for i, _, h in pages}
    for r in got:
        assert (r.payload_bytes, r.payload_digest) == (len(html[r.page_id]), base64.b32encode(hashlib.sha1(html[r.page_id]).digest()).decode())
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.refers_to) == [(1, "revisit", 7), (2, "revisit", 7), (3, "revisit", 4)]
    warc.write_warc(df, str(tmp_path / "v"), min_revisit_bytes=100)
    assert warc.read_warc(spark, str(tmp_path / "v")).filter("record_type = 'revisit'").count() == 0
    warc.write_warc(df.limit(0), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0


def bare(n, payload, kind="response"):
    return b"".join(line for line in record(n, payload, kind).splitlines(True) if b"Payload-Digest" not in line)


def kinds(data):
    return [(f.kind, warc._page(f.headers.get("warc-record-id"))) for f in warc.salvage(data)]


def test_payloads_that_hold_records():
    outer, later = record(1, b"<p>" + bare(2, b"text") + b"</p>"), record(3, b"x")
    assert kinds(outer + later) == [("record", 1), ("record", 3)]
    # a flip in the payload: the record's length still holds, and all of it is the gap
    flipped = outer.replace(b"<p>", b"<q>")
    assert kinds(flipped + later) == [("gap", None), ("record", 3)]
    # a lost length: what looks like a record is not taken for one
    lost = outer.replace(b"Content-Length: ", b"Content-Length- ", 1)
    assert kinds(lost + later) == [("gap", None), ("unsure", 2), ("gap", None), ("record", 3)]
    # one with a false digest neither, and it hides nothing behind it
    false = record(1, record(2, b"text").replace(b"text", b"tuxt")).replace(b"Content-Length: ", b"Content-Length- ", 1)
    assert kinds(false + later) == [("gap", None), ("record", 3)]


def test_revisits_behind_damage():
    noise, revisit = b"noise", record(4, b"", "revisit")
    assert kinds(noise + revisit + revisit + record(5, b"y")) == [("gap", None), ("record", 4), ("record", 4), ("record", 5)]
    assert kinds(noise + revisit) == [("gap", None), ("record", 4)]
    assert kinds(noise + revisit + noise + record(5, b"y")) == [("gap", None), ("unsure", 4), ("gap", None), ("record", 5)]


def test_hostile_archives_end():
    start = time.perf_counter()
    lines = b"WARC/1.1\r\n" * 200_000
    assert kinds(lines + record(1, b"x"))[-1] == ("record", 1)
    assert kinds(lines)[-1] == ("gap", None)
    nested = record(7, b"deep")
    for _ in range(1500):
        nested = gzip.compress(nested, 1)
    assert kinds(nested)[0][0] == "gap"
    # every header claims all the rest, with a wrong digest
    head = record(1, b"x").split(b"\r\n\r\n")[0]
    claims, end = [], b"z" * 1000 + b"\r\n\r\n"
    for n in range(20_000):
        own = head[: head.rindex(b" ")] + b" %d\r\n\r\n"
        claims.append(own % sum(map(len, (end, *claims[-1:]))))
    data = b"junk" + b"".join(claims) + end
    assert kinds(data)[-1][0] == "gap"
    far = head[: head.rindex(b" ")]
    size, parts = 1_000_000, []
    tail = b"y" * size + b"\r\n\r\n"
    for n in range(3000):
        own = far + b" %d\r\n\r\n" % size
        parts.append(own)
        size += len(own)
    assert kinds(b"junk" + b"".join(reversed(parts)) + tail)[-1][0] == "gap"
    assert time.perf_counter() - start < 30


def test_deep_members_within_the_limit():
    data = record(1, b"x")
    for _ in range(warc.MAX_DEPTH):
        data = gzip.compress(data)
    assert ids(data) == [1]
