import math

import numpy as np
import pytest
from millrace.llm import toxicity
from pyspark.sql import functions as F


def corpus(n=900):
    rng = np.random.default_rng(3)
    words = ["w" + "".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    out = []
    for i in range(n):
        text = list(rng.choice(words, 60))
        bad = i % 9 == 0
        if bad:
            text[5:7] = ["vilest", f"nastyword{chr(97 + i % 20)}"]
        out.append((i, " ".join(text), int(bad)))
    return out


def test_finds_held_out_toxic_texts(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (5002, "vilest " * 9000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if i % 2] + [(99999, 1), (3, None)], "doc_id long, toxic int")
    train = "doc_id % 5 != 0"
    model = toxicity.fit(docs.filter(train), labels.filter(train))
    got = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.toxicity(model, F.col("text")).alias("s")).collect()}
    held = [(b, got[i] >= 0.5) for i, _, b in rows if i % 5 == 0]
    assert all(p for b, p in held if b) and sum(p for b, p in held if not b) <= 1
    assert got[5000] == got[5001] < 0.5 and all(0 <= s <= 1 for s in got.values())


def test_no_positive_label(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is None
    assert toxicity.fit(docs.limit(0), labels.limit(0)) is None
    assert docs.select(toxicity.toxicity(None, F.col("text"))).first()[0] == 0.0


def brute_risk(w, xp, xu, prior):
    """The two parts of the risk, text by text."""
    loss = lambda row, y: math.log(1 + math.exp(-y * sum(a * b for a, b in zip(w, row))))
    mean = lambda rows, y: sum(loss(r, y) for r in rows) / len(rows)
    return prior * mean(xp, 1), mean(xu, -1) - prior * mean(xp, -1)


def test_risk_and_gradient_equal_brute_force():
    rng = np.random.default_rng(11)
    xp, xu = (rng.integers(0, 2, (n, 5)).astype(float) for n in (7, 13))
    w = rng.normal(size=5)
    positive, negative, gp, gn = toxicity.nnpu_risk(w, xp, xu, 0.3)
    assert (positive, negative) == pytest.approx(brute_risk(w, xp, xu, 0.3))
    for i in range(5):
        step = np.eye(5)[i] * 1e-6
        up, down = brute_risk(w + step, xp, xu, 0.3), brute_risk(w - step, xp, xu, 0.3)
        assert (gp[i], gn[i]) == pytest.approx(((up[0] - down[0]) / 2e-6, (up[1] - down[1]) / 2e-6), abs=1e-6)


def test_negative_part_is_pushed_back_up():
    # unlabelled texts that are all like the positives: the plain risk would fall without end
    xp, xu = np.ones((20, 2), np.float32), np.concatenate([np.ones((20, 2)), np.eye(2)[[1] * 5]]).astype(np.float32)
    w = toxicity.fit_nnpu(xp, xu, 0.9)
    assert toxicity.nnpu_risk(w, xp, xu, 0.9)[1] > -0.2 and np.abs(w).max() < 30


def test_scores_equal_brute_force(spark):
    model = toxicity.WordModel({"bad": 1.5, "bads*": -0.25, "worse": 0.75, "wors*": 0.5}, -1.0)
    texts = {1: "BAD bad word", 2: "badstuff", 3: None, 4: "worse bad", 5: "bad " * 50_000, 6: "x1bad2"}
    z = {1: 0.5, 2: -1.25, 3: -1.0, 4: 1.75, 5: 0.5, 6: 0.5}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.s for r in df.select("doc_id", toxicity.toxicity(model, F.col("text")).alias("s")).collect()}
    assert got == pytest.approx({k: 1 / (1 + math.exp(-v)) for k, v in z.items()})


def test_conflicting_repeated_and_null_labels(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "vilest")], "doc_id long, text string")
    plain = [(i, b) for i, _, b in rows if i % 2]
    odd = plain + plain[:50] + [(i, 0) for i, b in plain if b][:20] + [(None, 1), (None, 0)]
    one, two = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (plain, odd))
    assert one.bias == two.bias and one.weights == two.weights
