import numpy as np
import pytest
from millrace.llm import langid
from pyspark.sql import functions as F


def corpus():
    rng = np.random.default_rng(1)
    parts = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "ung", "eit", "ber"]}
    out = []
    for i in range(400):
        lang = "xx" if i % 2 else "yy"
        words = ["".join(rng.choice(parts[lang], 3)) for _ in range(40)]
        out.append((i, " ".join(words), lang))
    return out


def test_learns_and_predicts(spark):
    rows = corpus() + [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 !", "xx"), (1003, "kalomi " * 2000, None), (1003, "kalomi " * 2000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.fit(df.filter("doc_id % 4 != 2"))
    out = df.select("doc_id", "lang", langid.language(net, F.col("text")).alias("p")).select("doc_id", "lang", "p.*").collect()
    held = [r for r in out if r.doc_id < 400 and r.doc_id % 4 == 2]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)
    assert [(r.lang_pred, r.score) for r in out if r.doc_id in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert [r.lang_pred for r in out if r.doc_id == 1003] == ["xx", "xx"]


def test_tables_equal_the_plain_convolution():
    rng = np.random.default_rng(2)
    net = langid.ByteCNN(["a", "b"], [rng.normal(size=(w, 256, 3)).astype(np.float32) for w in langid.WIDTHS], np.ones((9, 2), np.float32), np.zeros(2, np.float32))
    x = rng.integers(0, 256, (5, 40)).astype(np.uint8)
    plain = [[max(0, max(sum(w[j, row[p + j], f] for j in range(len(w))) for p in range(40 - len(w) + 1))) for w in net.filters for f in range(3)] for row in x]
    assert np.allclose(net.pooled(x), plain, atol=1e-4)


def test_windows_cover_every_byte():
    for n in (1, 255, 256, 257, 5000):
        raw = bytes(np.arange(n) % 255 + 1)
        windows, _ = langid.cut_windows(raw)
        grams = {bytes(w[i : i + 4]) for w in windows for i in range(253)}
        assert all(raw[i : i + 4] in grams for i in range(n - 3))


def brute_predict(net, text):
    """Class and score of one text: every window's filters, softmax and weight, number by number."""
    raw = text.lower().encode()
    starts = list(range(0, max(1, len(raw) - langid.WINDOW + langid.STRIDE), langid.STRIDE))
    sums, weights = [0.0] * len(net.classes), 0.0
    for start in starts:
        x = raw[start : start + langid.WINDOW]
        size, x = len(x), x + bytes(langid.WINDOW - len(x))
        h = [max(0.0, max(sum(float(w[j, x[p + j], f]) for j in range(len(w))) for p in range(len(x) - len(w) + 1))) for w in net.filters for f in range(w.shape[2])]
        z = [sum(a * float(d) for a, d in zip(h, net.dense[:, c])) + float(net.bias[c]) for c in range(len(net.classes))]
        e = np.exp(np.array(z) - max(z))
        p = e / e.sum()
        weight = size * (p.max() - 1 / len(p) + 1e-3) ** langid.WINDOW_POWER
        sums = [s + weight * q for s, q in zip(sums, p)]
        weights += weight
    best = int(np.argmax(sums))
    return net.classes[best], sums[best] / weights


def test_predict_equals_brute_force(monkeypatch):
    monkeypatch.setattr(langid, "BATCH_WINDOWS", 3)
    rng = np.random.default_rng(5)
    net = langid.ByteCNN(["a", "b", "c"], [rng.normal(0, 0.2, (w, 256, 2)).astype(np.float32) for w in langid.WIDTHS], rng.normal(0, 0.5, (6, 3)).astype(np.float32), rng.normal(0, 0.1, 3).astype(np.float32))
    texts = ["word", "Ünï cödé " * 40, "x" * 254, "a" * 255, "b c " * 64, "long text " * 90, "y" * 256]
    labels, scores = langid.predict(net, texts + [None, "12"])
    want = [brute_predict(net, t) for t in texts]
    assert labels == [label for label, _ in want] + ["und", "und"]
    assert scores == pytest.approx([s for _, s in want] + [0.0, 0.0], abs=1e-4)


def test_repeated_rows_and_names(spark):
    rows = corpus()[:60] * 2
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    net = langid.fit(df)
    out = df.withColumn("p", langid.language(net, F.col("text"))).collect()
    assert all(r.lang_pred == "x" and r.score == 1.0 for r in out)
    assert len({(r.doc_id, r.p) for r in out}) == 60


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.fit(df) is None
    assert df.select(langid.language(None, F.col("text")).alias("p")).first().p == ("und", 0.0)
    assert langid.fit(df.limit(0)) is None
