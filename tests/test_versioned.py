"""Merges by file against merges of whole tables."""

import pytest
from millrace.sources import versioned, writers
from pyspark.sql import functions as F

SCHEMA = "k bigint, v string"


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "a table")
    versioned.create_table(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v")), path, ["k"], rows_per_file=100)
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_only_touched_files_are_written(spark, table):
    before = {r.file: r for r in versioned.files(spark, table).collect()}
    target = versioned.read_table(spark, table)
    source = spark.createDataFrame([(k, "new") for k in (205, 206, 207, 5000)], SCHEMA)
    expected = rows(writers.upsert(target, source, ["k"]))
    done = versioned.merge_table(spark, table, source, ["k"], rows_per_file=100)
    after = {r.file for r in versioned.files(spark, table).collect()}
    touched = {f for f, r in before.items() if r.low <= 207 and r.high >= 205}
    assert set(before) - after == touched and done.rewritten == len(touched) <= 2
    assert done.kept == len(before) - len(touched) and done.kept + done.written == len(after)
    assert rows(versioned.read_table(spark, table)) == expected
    assert rows(versioned.read_table(spark, table, 0)) == rows(target)


def test_keys_in_a_range_but_in_no_file(spark, table):
    versioned.merge_table(spark, table, spark.createDataFrame([(2000, "far")], SCHEMA), ["k"])
    done = versioned.merge_table(spark, table, spark.createDataFrame([(1500, "between"), (-1, "low")], SCHEMA), ["k"])
    assert done.rewritten == 0 and versioned.read_table(spark, table).count() == 1003


def test_ignore_delete_sequence_and_nulls(spark, table):
    source = spark.createDataFrame([(5, "no"), (1001, "b"), (1001, "a"), (None, "x"), (None, "y")], SCHEMA)
    done = versioned.merge_table(spark, table, source, ["k"], "v", ignore=True)
    got = rows(versioned.read_table(spark, table).filter("v <> 'old'"))
    assert got == [(1001, "a"), (None, "x"), (None, "y")] and done.rewritten == 0
    gone = spark.createDataFrame([(7, "z", True, 1), (8, "z", False, 1), (9, "z", None, 1), (7, "y", False, 0)], f"{SCHEMA}, d boolean, n int")
    versioned.merge_table(spark, table, gone, ["k"], "n", delete="d")
    got = rows(versioned.read_table(spark, table).filter("k BETWEEN 6 AND 10 OR k IS NULL"))
    assert got == [(10, "old"), (6, "old"), (8, "z"), (9, "z"), (None, "x"), (None, "y")]
    with pytest.raises(Exception, match="repeated"):
        versioned.merge_table(spark, table, spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA), ["k"])
    with pytest.raises(ValueError, match="columns"):
        versioned.merge_table(spark, table, spark.createDataFrame([(1,)], "k bigint"), ["k"])


def test_all_rows_deleted_and_empty_tables(spark, table):
    everything = versioned.read_table(spark, table).withColumn("d", F.lit(True))
    versioned.merge_table(spark, table, everything, ["k"], delete="d")
    assert versioned.read_table(spark, table).count() == 0 and versioned.files(spark, table).count() == 0
    versioned.merge_table(spark, table, spark.createDataFrame([], SCHEMA), ["k"])
    versioned.merge_table(spark, table, spark.createDataFrame([(1, "a")], SCHEMA), ["k"])
    assert rows(versioned.read_table(spark, table)) == [(1, "a")]


def test_second_writer_and_broken_commit(spark, table, monkeypatch):
    commit, source = versioned._commit, spark.createDataFrame([(1, "mine")], SCHEMA)

    def other_first(*args):
        monkeypatch.setattr(versioned, "_commit", commit)
        versioned.merge_table(spark, table, spark.createDataFrame([(2, "theirs")], SCHEMA), ["k"])
        commit(*args)

    monkeypatch.setattr(versioned, "_commit", other_first)
    with pytest.raises(RuntimeError, match="another writer"):
        versioned.merge_table(spark, table, source, ["k"])
    assert rows(versioned.read_table(spark, table).filter("v <> 'old'")) == [(2, "theirs")]
    open(f"{table}/commits/{2:012d}", "w").close()
    assert versioned.version(spark, table).number == 1
    with pytest.raises(RuntimeError, match="broke off"):
        versioned.merge_table(spark, table, source, ["k"])
    assert versioned.read_table(spark, table).count() == 1000


def test_vacuum(spark, table):
    for v in ("a", "b"):
        versioned.merge_table(spark, table, spark.createDataFrame([(1, v)], SCHEMA), ["k"])
    gone = versioned.vacuum(spark, table)
    assert len(gone) == 2 and versioned.versions(spark, table) == [2]
    assert rows(versioned.read_table(spark, table).filter("k = 1")) == [(1, "b")] and versioned.read_table(spark, table).count() == 1000
    with pytest.raises(ValueError):
        versioned.read_table(spark, table, 0)
    assert versioned.vacuum(spark, table) == []


def test_two_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.create_table(spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), (None, 1, "x")], "s string, n int, v string"), path, ["s", "n"])
    versioned.merge_table(spark, path, spark.createDataFrame([("a", 2, "y"), ("b", 1, "y"), (None, 1, "y")], "s string, n int, v string"), ["s", "n"])
    assert rows(versioned.read_table(spark, path)) == [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "y"), (None, 1, "x"), (None, 1, "y")]
