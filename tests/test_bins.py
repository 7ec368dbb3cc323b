import random

import pytest
from millrace.operators import bins
from pyspark.sql import functions as F


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small tables stay in as many slices as large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def fold(rows, max_rows, max_bytes, max_age=None):
    """The bins of rows (key, at, i, size) by the plain fold."""
    out, state = {}, {}
    for k, at, i, s in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] if max_age is not None else 0, r[2])):
        b = state.get(k)
        s = max(s or 0, 0)
        if b is None or b[1] + 1 > (max_rows or 1 << 62) or b[2] + s > (max_bytes if max_bytes is not None else 1 << 62) or (max_age is not None and at - b[3] > max_age):
            b = [b[0] + 1 if b else 0, 0, 0, at]
        b[1], b[2] = b[1] + 1, b[2] + s
        state[k] = b
        out[k, i] = b[0]
    return out


CASES = [(3, None, None), (None, 20, None), (4, 20, None), (1000, 300, None), (None, None, 50), (7, 40, 30), (1, None, None), (None, 0, None), (100_000, None, None)]


@pytest.mark.parametrize("max_rows,max_bytes,max_age", CASES)
def test_one_key_over_many_slices_equals_the_fold(spark, max_rows, max_bytes, max_age):
    rng = random.Random(str((max_rows, max_bytes)))
    rows = [(rng.choice([1, 1, 1, 1, 2, None]), t, i, rng.choice([0, 1, 5, 5, 9, 25, None])) for i, t in enumerate(sorted(rng.randrange(3000) for _ in range(1500)))] + [(77, 0, -1, 3)]
    df = spark.createDataFrame(rows, "k int, at long, i int, s int").withColumn("t", F.timestamp_seconds("at")).repartition(7)
    out = bins.merge_bins(df, "k", ["i"], max_rows, max_bytes, F.col("s"), *(("t", max_age) if max_age is not None else ()))
    assert out.columns == [*df.columns, "bin"]
    assert {(r.k, r.i): r.bin for r in out.collect()} == fold(rows, max_rows, max_bytes, max_age)


@pytest.mark.parametrize("kind", ["double", "string", "date", "struct<a:int>"])
def test_null_keys_of_any_type(spark, kind):
    df = spark.range(40).select(F.lit(None).cast(kind).alias("k"), F.col("id").alias("i"))
    assert [r.bin for r in bins.merge_bins(df, "k", ["i"], 2, None, F.lit(1)).orderBy("i").collect()] == [i // 2 for i in range(40)]
    nan = spark.createDataFrame([(float("nan"), i) for i in range(5)] + [(None, i) for i in range(5)], "k double, i int")
    assert sorted(r.bin for r in bins.merge_bins(nan, "k", ["i"], 2, None, F.lit(1)).collect()) == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_a_hot_key_is_many_even_tasks(spark):
    df = spark.range(80_000).select(F.lit(1).alias("k"), "id")
    out = bins.merge_bins(df, "k", ["id"], None, 1000, F.col("id") % 13)
    per_task = sorted(r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect())
    assert len(per_task) >= 4 and per_task[-1] <= 3 * per_task[len(per_task) // 2]
    got = {r.id: r.bin for r in out.collect()}
    assert got == {i: b for (_, i), b in fold([(1, 0, i, i % 13) for i in range(80_000)], None, 1000).items()}


def test_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, "a")] * 5 + [(1, 1, "b")] * 5, "k int, i int, v string")
    assert sorted(r.bin for r in bins.merge_bins(df, "k", ["i"], 4, None, F.lit(1)).collect()) == [0] * 4 + [1] * 4 + [2] * 2
    assert bins.merge_bins(df.limit(0), "k", ["i"], 4, None, F.lit(1)).count() == 0
    with pytest.raises(ValueError):
        bins.merge_bins(df, "k", ["i"], 4, None, F.lit(1), "v")


def test_states_of_bins(spark):
    df = spark.createDataFrame([("full", 0), ("full", 1), ("full", 2), ("few", 0), (None, 0), ("old", -500)], "k string, at int").withColumn("t", F.timestamp_seconds("at"))
    out = bins.bin_states(bins.merge_bins(df, "k", ["at"], 2, None, F.lit(10)), "k", F.lit(10), 1, 15, "t", 100.0, F.timestamp_seconds(F.lit(50)))
    assert {(r.k, r.bin): (r.n, r.bytes, r.state) for r in out.collect()} == {("full", 0): (2, 20, "closed"), ("full", 1): (1, 10, "waiting"), ("few", 0): (1, 10, "waiting"), (None, 0): (1, 10, "waiting"), ("old", 0): (1, 10, "expired")}
