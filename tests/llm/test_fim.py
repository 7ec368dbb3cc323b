import hashlib
import random

from millrace.llm import fim

SCHEMA = "doc_id long, text string, k1 string, form int"


def brute(doc_id, text):
    t = text or ""
    n = len(t)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def rows():
    rng = random.Random(3)
    made = [(i, "".join(rng.choice("ab<>PSM é𝄞\n") for _ in range(rng.randrange(40)))) for i in range(300)]
    return made + [(900, None), (901, ""), (902, "x<P>y"), (903, "é𝄞" * 70_000), (904, "<" * 50), (904, "<" * 50), (905, "<S" * 30), (None, "null id"), (None, "null id"), (906, "same"), (907, "same")]


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows()], SCHEMA)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = sorted((str(i), *b[:4], sha(b[4]), sha(t or "")) for i, t in rows() for b in [brute(i, t)])
    got = sorted((str(r[0]), *r[1:]) for r in fim.fim_report(df).collect())
    assert str(got) == str(want)
    texts = sorted((str(r[0]), r.output, r.restored) for r in fim.fim_texts(df).collect())
    assert texts == sorted((str(i), brute(i, t)[4], t or "") for i, t in rows())
    assert {brute(i, t)[1] for i, t in rows()} == {"plain", "psm", "spm"}


def test_pieces_are_small_and_in_order(spark, monkeypatch):
    df = spark.createDataFrame([(i, "abcdefghij" * 10_000) for i in range(20)], "doc_id long, text string")
    pieces = fim.output_pieces(fim.fim_plan(df))
    own = {}
    for r in pieces.toLocalIterator():
        assert r.piece is None or len(r.piece) <= fim.CHUNK + 3
        own.setdefault(r.id, []).append(r)
    for i, parts in own.items():
        assert [p.at for p in parts] == sorted(p.at for p in parts) and parts[0].at == -1
        assert "".join(p.piece for p in parts[1:]) == brute(i, "abcdefghij" * 10_000)[4]
    # one exchange: the second order is made inside the partitions of the first
    plan = fim.fim_report(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 2


def test_marks_over_pieces():
    for size in range(1, 5):
        stream = fim._Stream("psm", True)
        output, found = "<P>a<S<<S>cd<<M>b>", []
        for at in range(0, len(output), size):
            found += stream.feed(output[at : at + size])
        found += stream.end()
        assert "".join(t for _, _, t in sorted(found)) == "a<S<" + "b>" + "cd<"


def test_empty_table_and_other_ids(spark):
    df = spark.createDataFrame([("a", "some text"), ("b", None)], "name string, body string")
    assert fim.fim_report(df.limit(0), "body", "name").count() == 0
    assert sorted((r.name, r.output, r.restored) for r in fim.fim_texts(df, "body", "name").collect()) == [("a", brute("a", "some text")[4], "some text"), ("b", "", "")]
