import datetime

import pytest
from millrace.streaming import streams, waiting


def at(minute):
    return datetime.datetime(2024, 1, 1, 0, minute)


@pytest.mark.parametrize("slices", [1, 3])
def test_rows_wait_for_counted_signals(spark, tmp_path, slices):
    rows = spark.createDataFrame([("a", 2, "r2", at(0)), ("a", 1, "r1", at(0)), ("b", 1, "alone", at(0)), (None, 1, "null", at(0)), ("c", 1, "gone", at(1))], "s string, n int, v string, t timestamp")
    signals = spark.createDataFrame([("a", 2, at(2)), ("a", None, at(2)), (None, 3, at(2)), ("b", 1, at(2)), ("x", 9, at(2))], "s string, d int, t timestamp")
    streams_of = {}
    for name, df in (("rows", rows), ("signals", signals)):
        df.write.parquet(str(tmp_path / name))
        streams_of[name] = spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
    state, out = str(tmp_path / "state"), str(tmp_path / "out")

    def step():
        found = []
        df = waiting.wait_for_count(streams_of["rows"], streams_of["signals"], "s", 3, "n", "d", "t", "10 minutes", slices=slices)
        streams.run_to_end(df, sink=lambda batch, _: found.extend((r.s, r.n, r.v, r.t, r.outcome) for r in batch.collect()), checkpoint=state)
        return found

    first = step()
    assert [r for r in first if r[4] == "released"] == [(None, 1, "null", at(0), "released")] and len(first) == 1
    # the third of a's signals, and a late row of a
    spark.createDataFrame([("a", 1, at(3))], "s string, d int, t timestamp").write.mode("append").parquet(str(tmp_path / "signals"))
    spark.createDataFrame([("a", 0, "r0", at(3))], "s string, n int, v string, t timestamp").write.mode("append").parquet(str(tmp_path / "rows"))
    second = step()
    assert sorted(r[2] for r in second) == ["r0", "r1", "r2"] and {r[4] for r in second} == {"released"}
    if slices == 1:
        assert [r[1] for r in second] == [0, 1, 2]
    # time passes: what still waits expires; a comes at once
    spark.createDataFrame([("a", 7, "r7", at(30))], "s string, n int, v string, t timestamp").write.mode("append").parquet(str(tmp_path / "rows"))
    assert sorted((r[2], r[4]) for r in step()) == [("alone", "expired"), ("gone", "expired"), ("r7", "released")]


def test_an_expiry_needs_times(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        waiting.wait_for_count(df, df, "id", 1, "id", ts="id")
