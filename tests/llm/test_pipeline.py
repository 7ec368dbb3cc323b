"""The whole pipeline on the smallest tables against brute force, and its stages on odd rows."""

import hashlib
import sys
from fractions import Fraction
from pathlib import Path

import numpy as np
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline
from millrace.llm import mixing
from tests.llm import test_linededup, test_neardup, test_quality

DIR = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    verdict = {}
    for i, t in docs:
        n, _, symbols, dup, _, failed = test_quality.brute(t)
        words = test_quality.WORDS.findall(t or "")
        lines = [x for x in (t or "").split("\n") if test_quality.WORDS.search(x)]
        lettered = sum(any(c.isalpha() for c in w) for w in words)
        verdict[i] = not (failed or 10 * symbols > 3 * n or 2 * (t or "").count("!") > n or 2 * sum(w.isupper() for w in words) > n or 10 * lettered < 7 * n or 2 * dup > len(lines))
    kept = [(i, t) for i, t in docs if verdict[i]]
    cut = test_linededup.brute(kept)
    texts = [(i, cut[i, t]) for i, t in kept]
    classes = test_neardup.brute(texts)
    left = [(i, t) for i, t in texts if classes[i, t][0] == i]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: hashlib.sha256(np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest() for i, t in left}
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, DIR).collect()}
    assert got == want


def test_stages_on_odd_rows(spark):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    rows = [(1, good, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (None, good + " more", "en", "b", 1), (4, good, "en", "a", 1), (4, good, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        at = table
        for name, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, DIR)
            if name != "bpe":
                assert at.columns == docs.columns
        ids = sorted(str(r.doc_id) for r in at.collect())
        assert ids == (["1", "None"] if table is docs else [])


def test_stages_keep_extra_columns(spark):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    docs = spark.createDataFrame([(1, good, "en", "a", 1, "g", 2)], "doc_id long, text string, lang string, source string, n_chars long, gone string, rank int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DIR)
    assert docs.columns[-2:] == ["gone", "rank"] and tuple(docs.first())[-2:] == ("g", 2)


def brute_mixture(rows, block_rows=32):
    """Ids in the order of the mixture, slot by slot; each source has at most one bucket of rows."""
    own = {}
    for i, s in rows:
        own.setdefault(s, []).append(i)
    # Spark's hash of (id, "order"): the hash of each value is the seed of the next
    hashed = lambda i: np.int64(np.uint64(xxhash.xxh64_intdigest(b"order", xxhash.xxh64_intdigest(int(i).to_bytes(8, "little"), 42))).view(np.int64))
    names = sorted(own)
    exact = {s: Fraction(repr(len(own[s]) ** 0.5)) for s in names}
    weight = {s: w / sum(exact.values()) for s, w in exact.items()}
    blocks = {s: [ids[k : k + block_rows] for k in range(0, len(ids), block_rows)] for s, ids in ((s, sorted(own[s], key=hashed)) for s in names)}
    done, out, slot = dict.fromkeys(names, 0), [], 0
    while any(done[s] < len(blocks[s]) for s in names):
        # Pfair windows: block k is released at floor(k / w) and due by ceil((k + 1) / w)
        ready = [s for s in names if done[s] / weight[s] // 1 <= slot]
        s = min(ready, key=lambda s: (-(-(done[s] + 1) // weight[s]), s))
        out += blocks[s][done[s]] if done[s] < len(blocks[s]) else []
        done[s] += 1
        slot += 1
    return out


def test_run_keeps_the_order_of_the_mixture(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many files
    try:
        got = {r.mix_position: r.doc_id for r in corpus_pipeline.run(spark, DIR).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    want = brute_mixture([(i, source[i]) for i in got.values()])
    assert len(set(source.values())) > 1
    assert [got[k] for k in range(len(got))] == want


def test_position_is_that_of_files_and_rows(spark, tmp_path):
    spark.range(1000).repartitionByRange(13, F.desc("id")).sortWithinPartitions(F.desc("id")).write.parquet(f"{tmp_path}/t")
    for table in (spark.read.parquet(f"{tmp_path}/t"), spark.range(999, -1, -1, 7)):
        assert sorted(tuple(r) for r in mixing.with_position(table).collect()) == [(i, 999 - i) for i in range(1000)]
    assert mixing.with_position(spark.read.parquet(f"{tmp_path}/t").limit(0)).count() == 0
