import random

import numpy as np
import pytest
from millrace.llm import neardup
from millrace.llm.common import WORDS


def grams(text):
    w = WORDS.findall(text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {t: grams(t) for _, t in rows}
    texts = [t for t in sets if sets[t]]
    links = {t: set() for t in sets}
    for x in range(len(texts)):
        for y in range(x):
            a, b = sets[texts[x]], sets[texts[y]]
            if len(a & b) >= 0.8 * len(a | b):
                links[texts[x]].add(texts[y])
                links[texts[y]].add(texts[x])
    ids = {}
    for i, t in rows:
        ids.setdefault(t, []).append(i)
    out = {}
    for t in texts:
        seen, todo = {t}, [t]
        while todo:
            for u in links[todo.pop()] - seen:
                seen.add(u)
                todo.append(u)
        out[t] = (min(i for u in seen for i in ids[u]), len(links[t]))
    return {(i, t): out.get(t, (i, 0)) for i, t in rows}


def corpus(seed, groups, size):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, size)):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("small,chunk", [(32, 128), (3, 4)])
def test_equals_brute_force(spark, small, chunk, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    texts = corpus(4, 40, 14)
    rows = list(enumerate(texts + texts[:10] + ["", None, " \n", "one", "one", "two words", "a b c d e " * 2000]))
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, node int")
    got = {(r.doc_id, rows[r.doc_id][1]): (r.class_id, r.n_links) for r in neardup.near_duplicates(df).collect()}
    assert got == brute(rows)
    kept = neardup.keep_one_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for (i, _), (c, _) in got.items() if i == c)


def test_edges(spark):
    rows = [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "x y z"), (2, "p q r"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in neardup.near_duplicates(df).collect())
    assert got == [("1", "1", 0), ("1", "1", 0), ("2", "2", 0), ("2", "2", 0), ("3", "3", 0), ("None", "None", 0)]
    assert neardup.near_duplicates(df.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in neardup.keep_one_each(df).collect()) == ["1", "2", "2", "3", "None"]


def test_only_the_row_that_names_its_class_stays(spark):
    b = "one text of some words that others copy"
    rows = [(3, b), (5, "quite another text of other words"), (5, b), (7, b + " " * 3), (8, b), (8, b)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, id int")
    got = sorted((r.doc_id, r.text) for r in neardup.keep_one_each(df).collect())
    assert got == sorted(rows[:2])
    # two texts of the smallest id in one class: one of them stays
    long = " ".join(f"w{i}" for i in range(100))
    near = [(1, long), (1, long + " more"), (2, long)]
    assert [r.doc_id for r in neardup.keep_one_each(spark.createDataFrame(near, "doc_id long, text string")).collect()] == [1]


def test_sizes_at_the_edge_of_their_classes(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 2)
    monkeypatch.setattr(neardup, "CHUNK", 3)
    words = [f"w{i}" for i in range(204)]
    # sets of 200 down to 150 grams, each inside the others
    rows = [(k, " ".join(words[: 204 - k])) for k in range(51)]
    got = {(r.doc_id, rows[r.doc_id][1]): (r.class_id, r.n_links) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert {k: c for k, (c, _) in got.items()} == {k: c for k, (c, _) in want.items()}
    # a pair at the very threshold shares no band with a chance of RECALL at most
    assert sum(n for _, n in got.values()) >= 0.995 * sum(n for _, n in want.values())


def test_recall_at_the_threshold():
    bands, rows = neardup.choose_bands()
    rng = np.random.default_rng(6)
    hits = 0
    for _ in range(300):
        pool = rng.integers(1, 1 << 63, 450, dtype=np.uint64)
        a, b = np.sort(pool[:405]), np.sort(np.concatenate([pool[:360], pool[405:]]))  # 360 of 450
        hits += bool((neardup.band_hashes(a, bands, rows) == neardup.band_hashes(b, bands, rows)).any())
    assert hits >= 297
