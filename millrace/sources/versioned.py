"""Tables that a merge changes by file: only files that hold a key of the source are written again.

A table is a folder.  ``data`` has Parquet files, each over a range of keys;
``manifest`` has, for each version, a table of its files with their ranges; and
``commits`` has one small file for each version, made last and only if no other
writer made it.  Whatever breaks off before that leaves the version before.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.scratch import written
from millrace.sources.writers import _one_each

ROWS_PER_FILE = 1_000_000
#: Ranges that stand for the source's keys when files are chosen by their ranges; this many rows are broadcast.
RANGES = 256


class Version(NamedTuple):
    number: int
    manifest: str
    schema: T.StructType


class Merge(NamedTuple):
    """What a merge did: the new version, and how many files it wrote again, wrote, and left alone."""

    version: int
    rewritten: int
    written: int
    kept: int


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _commit(spark: SparkSession, path: str, number: int, manifest: str, schema: T.StructType) -> None:
    fs, place = _fs(spark, f"{path}/commits/{number:012d}")
    try:
        out = fs.create(place, False)
    except Py4JJavaError as e:
        raise RuntimeError(f"version {number} of {path} exists: another writer was first, or its commit broke off") from e
    out.write(bytearray(json.dumps({"manifest": manifest, "schema": schema.json()}).encode()))
    out.close()


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions that are kept."""
    marks = spark.read.schema("value string").text(f"{path}/commits").select(F.col("_metadata.file_name").cast("long").alias("n"))
    return sorted(r.n for r in marks.collect())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The last version, or one that is named."""
    marks = spark.read.schema("value string").text(f"{path}/commits").select(F.col("_metadata.file_name").cast("long").alias("n"), "value")
    found = (marks if number is None else marks.filter(F.col("n") == number)).agg(F.max(F.struct("n", "value")).alias("m")).first().m
    if found is None:
        raise ValueError(f"no version {'' if number is None else number} of a table in {path}")
    note = json.loads(found.value)
    return Version(found.n, note["manifest"], T.StructType.fromJson(json.loads(note["schema"])))


def files(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """(file, rows, low, high): the files of a version and the range of the first key column in each."""
    return spark.read.parquet(f"{path}/manifest/{version(spark, path, number).manifest}")


def _rows(spark: SparkSession, path: str, names: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*(f"{path}/data/{n}" for n in names)) if names else spark.createDataFrame([], schema)


def _names(df: DataFrame) -> list[str]:
    # one name for each file, as Spark itself holds them when it plans a scan
    return sorted(r.file for r in df.select("file").collect())


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the last version, or of an older one that is still kept."""
    return _rows(spark, path, _names(files(spark, path, number)), version(spark, path, number).schema)


def _write(df: DataFrame, path: str, key: str, rows: int, rows_per_file: int) -> tuple[str, DataFrame]:
    """Rows in files by ranges of the key, and what the manifest says of them."""
    spark, folder = df.sparkSession, uuid.uuid4().hex
    place = f"{path}/data/{folder}"
    df.repartitionByRange(max(1, math.ceil(rows / rows_per_file)), f"`{key}`").sortWithinPartitions(f"`{key}`").write.parquet(place)
    read = spark.read.schema(df.schema).parquet(place)
    file = F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name"))
    return folder, read.select(F.col(f"`{key}`").alias("k"), file.alias("file")).groupBy("file").agg(F.count("*").alias("rows"), F.min("k").alias("low"), F.max("k").alias("high"))


def create_table(df: DataFrame, path: str, keys: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """A new table, its files by ranges of the first key column.  A folder that has a table is an error."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    _, manifest = _write(df, path, keys[0], df.count(), rows_per_file)
    name = uuid.uuid4().hex
    manifest.write.parquet(f"{path}/manifest/{name}")
    _commit(df.sparkSession, path, 0, name, schema)


def _candidates(manifest: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Files whose range meets one of at most ``RANGES`` ranges that hold all keys of the source."""
    keys = source.select(F.col(f"`{key}`").alias("k")).filter("k IS NOT NULL").repartitionByRange(RANGES, "k")
    ranges = keys.groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("first"), F.max("k").alias("last"))
    return manifest.join(F.broadcast(ranges), (F.col("low") <= F.col("last")) & (F.col("high") >= F.col("first")), "left_semi")


def merge_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], sequence: str | None = None, ignore: bool = False, delete: str | None = None, rows_per_file: int = ROWS_PER_FILE) -> Merge:
    """Upsert a source, which has the table's columns, into the table by its keys.

    Files are chosen by their ranges first; of those the key columns alone are
    read to find which hold a key of the source, and only these are written
    again.  With ``ignore`` rows of known keys are left out and no file is
    written again.  A boolean column of the source named by ``delete`` marks
    keys to be taken out.  Of a repeated key the last row by ``sequence``
    counts (with ``ignore`` the first); without it a repeated key is an error.
    ``sequence`` may be a column that the table does not have.  Rows with a null in a key equal none and
    come in as they are; a null mark deletes nothing.  A writer that was first makes this one an error, and
    the table stays as the first left it.
    """
    now = version(spark, path)
    extra = {c for c in (delete, sequence) if c} - set(now.schema.names)
    if set(source.columns) - extra != set(now.schema.names):
        raise ValueError(f"the source has columns {source.columns}, the table {now.schema.names}")
    source = written(_one_each(source, keys, sequence, not ignore), "merge-source")
    manifest = spark.read.parquet(f"{path}/manifest/{now.manifest}")
    wanted = source.select(*(f"`{k}`" for k in keys))
    columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in now.schema]
    known = _rows(spark, path, _names(_candidates(manifest, source, keys[0])), T.StructType([now.schema[k] for k in keys]))
    if ignore:
        touched, old = [], None
        fresh = source.join(known, list(keys), "left_anti")
    else:
        place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        file = F.concat_ws("/", place, F.col("_metadata.file_name"))
        held = known.withColumn("file", file) if known.inputFiles() else known.withColumn("file", F.lit(""))
        touched = _names(held.join(wanted, list(keys), "left_semi").select("file").distinct())
        old = _rows(spark, path, touched, now.schema).join(wanted, list(keys), "left_anti").select(*columns)
        fresh = source
    if delete:
        fresh = fresh.filter(~F.coalesce(F.col(f"`{delete}`"), F.lit(False)))
    fresh = fresh.select(*columns)
    rows = (fresh if old is None else old.unionByName(fresh)) if touched or ignore else fresh
    rows = written(rows, "merge-rows")
    _, new = _write(rows, path, keys[0], rows.count(), rows_per_file)
    name = uuid.uuid4().hex
    gone = spark.createDataFrame([(t,) for t in touched], "file string")
    manifest.join(gone, "file", "left_anti").select(*new.columns).union(new).write.parquet(f"{path}/manifest/{name}")
    _commit(spark, path, now.number + 1, name, now.schema)
    after = files(spark, path, now.number + 1).select(F.count("*").alias("n")).first().n
    before = manifest.count()
    return Merge(now.number + 1, len(touched), after - before + len(touched), before - len(touched))


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Forget all but the last ``keep`` versions and delete the files that only those had; their names.

    Files of a writer that has not committed are its own and stay: only files that a forgotten
    version names are deleted.
    """
    if keep < 1:
        raise ValueError("one version has to be kept")
    numbers = versions(spark, path)
    old, kept = numbers[:-keep], numbers[-keep:]
    if not old:
        return []
    live = [f"{path}/manifest/{version(spark, path, n).manifest}" for n in kept]
    dead = {n: version(spark, path, n).manifest for n in old}
    names = _names(spark.read.parquet(*(f"{path}/manifest/{m}" for m in dead.values())).select("file").distinct().join(spark.read.parquet(*live), "file", "left_anti"))
    # the commits go first, so that no version is left whose files are gone
    for place in [f"{path}/commits/{n:012d}" for n in old] + [f"{path}/manifest/{m}" for m in dead.values()] + [f"{path}/data/{n}" for n in names]:
        fs, p = _fs(spark, place)
        fs.delete(p, True)
    return names
