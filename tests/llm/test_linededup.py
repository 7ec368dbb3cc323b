import random

from millrace.llm import linededup
from millrace.llm.common import WORDS


def brute(rows):
    """Kept text by (id, text); rows with equal id and text count once."""
    order = sorted({(i is not None, i if i is not None else 0, t) for i, t in rows if t is not None})
    seen, gone = set(), {}
    per = {}
    for _, i, t in order:
        lines = t.split("\n")
        full = [p for p, x in enumerate(lines) if WORDS.search(x)]
        per[i, t] = [(tuple(lines[p] for p in full[k : k + 3]), full[k : k + 3]) for k in range(len(full) - 2)]
    for (i, t), windows in per.items():
        for w, at in windows:
            if w in seen:
                gone.setdefault((i, t), set()).update(at)
            seen.add(w)
    return {(i, t): "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get((i, t), ())) for i, t in rows if t is not None}


def test_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(n, "\n".join(rng.choice(["a", "b", "c", " ", ""]) for _ in range(rng.randrange(12)))) for n in range(150)]
    rows += [(900, None), (901, ""), (902, "x\ny"), (903, "\n".join(["same line"] * 3000)), (904, "p\nq\nr\ns"), (905, "z\np\nq\nr\ns\nt")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, gone string, __k1 int")
    out = linededup.dedup_lines(df)
    assert out.columns == df.columns
    want = brute(rows)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {i: None if t is None else want[i, t] for i, t in rows}
    assert got[905] == "z\nt" and got[902] == "x\ny"


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc\nd"), (2, "a\nb\nc")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text) for r in linededup.dedup_lines(df).collect())
    assert got == [("1", ""), ("1", ""), ("2", ""), ("None", "a\nb\nc\nd")]
    assert linededup.dedup_lines(df.limit(0)).count() == 0
    assert linededup.dedup_report(df).count() == 4


def test_a_window_that_overlaps_itself_keeps_what_no_later_one_covers(spark):
    df = spark.createDataFrame([(1, "x\nx\nx\nx\nx"), (2, "a\nb\na\nb\na")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()} == {1: "x", 2: "a\nb"}
