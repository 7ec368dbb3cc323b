import hashlib
import random
import re

import pytest
from millrace.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, tests, size=10):
    windows = [("" if i is None else str(i), tuple(w[s : s + size])) for i, t in tests for w in [words(t)] if w for s in range(max(1, len(w) - size + 1))]
    out = []
    for i, t in docs:
        w, hit, items = words(t), set(), set()
        for item, x in windows:
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s : s + len(x)]) == x:
                    hit.update(range(s, s + len(x)))
                    items.add(item)
        out.append((str(i), len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def tables(seed):
    rng = random.Random(seed)
    some = lambda n, letters="abcDé": " ".join(rng.choice(letters) * rng.choice([1, 1, 2]) for _ in range(n))
    tests = [(i, some(rng.randrange(30))) for i in range(12)] + [(50, "Rare Words-only, HERE 12 times; x_y!"), (51, "aa"), (52, None), (53, "..."), (54, "same test"), (55, "same test"), (None, "x y"), (56, "b " * 25), (57, "unheard of")]
    docs = [(i, some(rng.randrange(120))) for i in range(60)]
    docs += [(100 + i, some(15) + " " + (t or "") + " " + some(5)) for i, (_, t) in enumerate(tests)]
    docs += [(200, None), (201, ""), (None, "b " * 60), (None, "x Y"), (202, "b " * 60), (202, "b " * 60), (203, "a rare words only here 12 times x y"), (204, "SAME test Same TEST"), (205, "É é")]
    return docs, tests


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, tests = tables(seed)
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, k1 string, term int")
    b = spark.createDataFrame([(i, t, 2) for i, t in tests], "item_id long, text string, words int")
    for size in (10, 3):
        got = sorted((str(r[0]), *r[1:]) for r in decontam.contamination_report(d, b, size=size).collect())
        assert got == brute(docs, tests, size)
    assert any(r[5] for r in got)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontam.contamination_report(d.limit(0), b).count() == 0
    assert [tuple(r)[1:4] for r in decontam.contamination_report(d, b.limit(0)).collect()] == [(2, 0, 0)]


def test_proximity_equals_brute_force(spark):
    docs, tests = tables(4)
    tests = [(i, " ".join(words(t)[:4])) for i, t in tests if words(t)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(tests, "item_id long, text string")
    found, owners = decontam.windows(b)
    postings, known = decontam.build_index(d)  # of all words
    keyed = d.select("text", *decontam._keys("text")).distinct()
    got = decontam.proximity_matches(postings, known, found, 6).join(keyed, ["k1", "k2"]).join(owners, "phrase").select("item", "text").distinct().collect()
    want = set()
    for i, t in tests:
        need = set(words(t))
        for _, text in docs:
            w = words(text)
            if any(need <= set(w[s : s + 6]) for s in range(len(w))):
                want.add(("" if i is None else str(i), text))
    assert {tuple(r) for r in got} == want and want


def test_the_plan_is_native(spark):
    docs, tests = tables(1)
    out = decontam.contamination_report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "CartesianProduct" not in plan
