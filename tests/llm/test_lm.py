import math
import random
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from millrace import scratch
from millrace.llm import lm, queries
from pyspark.sql import functions as F


def brute(rows, order, min_context=1):
    seq = {k: [*lm.tokens((t or '').encode()), None] for k, t, _ in rows}
    train = [k for k, _, use in rows if use]
    grams = [None, *(Counter() for _ in range(4))]
    contexts = Counter()
    for k in train:
        s = ["<s>", *seq[k]]
        for n in range(1, order + 1):
            for i in range(len(s) - n + 1):
                g = tuple(s[i : i + n])
                if n == 1 and i == 0:
                    continue
                grams[n][g] += 1
        contexts["<s>",] += 1
    n_all, v = sum(grams[1].values()), len(grams[1])
    once, twice = (sum(c == x for c in grams[1].values()) for x in (1, 2))
    d = once / (once + 2 * twice + 1) if once else 0.5

    def p(h, w):
        if not h:
            c = grams[1][w,]
            return (c - d) / n_all if c else d * v / n_all if n_all else 1.0
        lower = p(h[1:], w)
        c = contexts[h] if h == ("<s>",) else grams[len(h)][h]
        a = lm.MIX[len(h) + 1]
        if len(h) > 1 and c < min_context:
            return lower
        return a * grams[len(h) + 1][*h, w] / c + (1 - a) * lower if c else lower

    out = {}
    for k, s in seq.items():
        full = ["<s>", *s]
        score = sum(math.log10(p(tuple(full[max(0, i - order + 1) : i]), full[i])) for i in range(1, len(full)))
        c = [grams[1][w,] for w in s]
        out[k] = (len(s), sum(x > 0 for x in c), n_all, sum(math.log10((x + 1) / (n_all + v + 1)) for x in c), score)
    return out, p, grams


@pytest.mark.parametrize("order,min_context,fan", [(1, 1, 100), (2, 1, 3), (3, 1, 100), (3, 2, 3), (4, 1, 2), (4, 3, 100)])
def test_equals_brute_force(spark, order, min_context, fan, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(lm, "RANGE_BYTES", 7000)
    monkeypatch.setattr(lm, "FAN", fan)
    monkeypatch.setattr(lm, "WALK_TOKENS", 100)
    rng = random.Random(order)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocab, [1 / (k + 1) for k in range(60)], k=rng.randrange(30))), zlib.crc32(str(i).encode()) % 7 != 2) for i in range(200)]
    rows += [(300, None, True), (301, "", False), (302, "W1 w1 x É\tnew words", False), (303, "w0 w1 " * 2000, True), (304, "\x1c", True)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, training boolean, row string")
    got = {r.doc_id: tuple(r)[1:] for r in lm.score_texts(df, "training", order=order, min_context=min_context).collect()}
    want, p, grams = brute(rows, order, min_context)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][:3] == want[k][:3]
        assert got[k][3:] == pytest.approx(want[k][3:], rel=1e-9)
    for h in [(), ("<s>",), (b"w0",), (b"nothing",), (b"w0", b"w1")][: (1, 4, 5, 5)[order - 1]]:
        known = sum(p(h, w) for (w,) in grams[1])
        assert known + p(h, "no such word") == pytest.approx(1)


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b", False), (1, "a b", None), (None, "a", False)], "doc_id long, text string, training boolean")
    out = lm.score_texts(df, "training").collect()
    assert [tuple(r)[1:] for r in sorted(out, key=lambda r: r.n_tokens)] == [(2, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert lm.score_texts(df.limit(0), "training").count() == 0
    same = df.withColumn("training", F.lit(True))
    assert lm.score_texts(same, "training").count() == 3


def test_junk_scores_below_ordinary_text(spark, tmp_path):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(4000)]
    rows = [(i, " ".join(rng.choices(vocab, [1 / (k + 1) for k in range(4000)], k=60))) for i in range(300)]
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 7 == 2][:4]
    rows += [(i, " ".join(f"q{rng.randrange(10**9)}z" for _ in range(60))) for i in held]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_lm(spark, str(tmp_path)).collect()}
    ordinary = [r.score / r.n_tokens for i, r in got.items() if i < 300 and r.held_out]
    junk = [got[i].score / got[i].n_tokens for i in held]
    assert ordinary and all(got[i].held_out and got[i].n_known == 1 for i in held)
    assert max(junk) < min(ordinary)
    # over the known words and V + 1 unknown ones the root's probabilities sum to 1
    words = [b"a b c c", b"x"]
    block = lm.Block(words)
    machine, _, _ = lm.build(block, [lm._counts(block, np.array([1.0, 0.0]), 1)[0][1]], [5, 4, 3, 1], 1, 1, spread_unseen=True)
    p = 10**machine.root
    unknown = p[block.ids[block.starts[1]]]
    assert p.sum() - unknown + 5 * unknown == pytest.approx(1)


def test_counts_beyond_32_bits(spark):
    keys = np.array([3, 1 << 40, (1 << 63) + 5], np.uint64)
    sent = [(1, r, b, k, c) for b, counts in ((7, [1 << 32, 3, 0]), (8, [5, 1 << 40, 255])) for r, k, c in lm._send(keys, np.array(counts, np.int64), 1)]
    rows = lm.add_up(spark.createDataFrame(sent, lm.SENT), 1).collect()
    assert {r.block: lm._unpack(r.totals).tolist() for r in rows if r.block >= 0} == dict.fromkeys((7, 8), [(1 << 32) + 5, (1 << 40) + 3, 255])
    assert [r.stats for r in rows if r.block < 0] == [[(1 << 32) + (1 << 40) + 263, 3, 0, 0]]


def test_ids_of_any_type_and_repeated_rows(spark):
    rows = [("x", "a b", True, 1)] * 40 + [(None, "a b", True, 2)] * 40 + [("y", "b", False, 3)]
    df = spark.createDataFrame(rows, "doc_id string, text string, training boolean, block int")
    out = lm.score_texts(df, "training", order=3, min_context=2).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
    assert {r.train_tokens for r in out} == {240} and len({r.score for r in out}) == 2


def test_walk_follows_failure_arcs():
    texts = [b"a b c", b"a b d", b"x b c"]
    block = lm.Block(texts)
    counts = [c for _, c in lm._counts(block, np.array([1.0, 1.0, 1.0]), 3)]
    machine, start, _ = lm.build(block, counts, [12, 6, 2, 0], 3, 3)
    arcs = machine.load(0, len(block.ids))
    for a, b in zip(block.starts, block.ends):
        words, state, total = block.ids[a:b].tolist(), start, 0.0
        for w in words:
            while state and (state << 32 | w) not in arcs:
                total += machine._fail_weight[state]
                state = machine._fail_state[state]
            step, state = arcs[state << 32 | w] if state else (machine.root[w], machine._root_target[w])
            total += step
        assert machine.walk(words, start, arcs) == pytest.approx(total)
    # no arc from (x, b) over d: two words, one word, and, b having an arc, no further
    ids = dict(zip([b"a", b"b", b"c", b"", b"d", b"x"], [1, 2, 3, 0, 4, 5]))
    at_xb = machine.walk([ids[b"x"], ids[b"b"], ids[b"d"]], start, arcs) - machine.walk([ids[b"x"], ids[b"b"]], start, arcs)
    assert at_xb == pytest.approx(math.log10(0.5 * (0.5 * 1 / 3 + 0.5 * 10 ** machine.root[4])))


def test_shuffle_files_go_with_each_step(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in Path(str(d)).rglob("shuffle_*.data")}
    rows = [(i, f"w{i % 7} w{i % 5} w{i % 3}".encode(), 1) for i in range(200)]
    blocks = scratch.written(lm.pack_blocks(spark.createDataFrame(rows, "row long, text binary, training int")), "blocks")
    before, setting = files(), spark.conf.get(scratch.FREE_SHUFFLES)
    totals = lm.exchange(lambda ranges: lm.first_counts(blocks, 3, ranges), 1, 1, "totals")
    longer = lm.exchange(lambda ranges: lm.next_counts(blocks, totals.filter("block >= 0"), 3, ranges, 200, 3, 2), 1, 1, "longer")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)  # they are taken away in the background
    assert not files() - before
    assert spark.conf.get(scratch.FREE_SHUFFLES) == setting
    assert longer.count() > 1
