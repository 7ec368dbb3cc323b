"""Writers, and merges that give a table's next state."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.schema import union_records
from millrace.scratch import scratch_path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists", **options: str) -> None:
    df.write.mode(mode).options(header=header, **options).csv(path)


def write_json(df: DataFrame, path: str, grouping: str = "lines", nulls: str = "never_suppress", mode: str = "errorifexists") -> None:
    """One object a line, or one array in each file (``array``); a table without rows is an empty array.

    ``nulls``: never_suppress, always_suppress, or suppress_missing: only
    fields null in every row, which stand for those missing from the data.
    """
    if nulls == "suppress_missing":
        seen = df.agg(*(F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns))).first()
        df = df.select(*(F.col(f"`{c}`") for i, c in enumerate(df.columns) if seen[i]))
    keep = {"ignoreNullFields": str(nulls == "always_suppress").lower()}
    if grouping == "lines":
        df.write.mode(mode).options(**keep).json(path)
        return
    # a line for each batch, with commas between and brackets around each partition's file
    from collections.abc import Iterator

    import pandas as pd

    def bracketed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = "["
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"value": [before + ",\n".join(frame["value"])]})
                before = ","
        if before == ",":
            yield pd.DataFrame({"value": ["]"]})

    lines = df.select(F.to_json(F.struct("*"), keep).alias("value")).mapInPandas(bracketed, "value string")
    lines.write.mode(mode).text(path)
    # the first partition is written even if it is empty, and an empty file is no JSON
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    parts = [f for f in store.listStatus(folder) if f.getPath().getName().startswith("part-")]
    empty = [f for f in parts if f.getLen() == 0]
    for f in empty:
        store.delete(f.getPath(), False)
    if len(empty) == len(parts):
        df.sparkSession.range(0, 1, 1, 1).select(F.lit("[]").alias("value")).write.mode("append").text(path)


def write_avro(df: DataFrame, path: str, schema: str | None = None, mode: str = "errorifexists") -> None:
    """By the spark-avro jar; ``sources.avro`` writes without it."""
    writer = df.write.mode(mode).format("avro")
    (writer.option("avroSchema", schema) if schema else writer).save(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", block_size: int | None = None, page_size: int | None = None, dictionary_page_size: int | None = None, codec: str = "snappy", version: str | None = None) -> None:
    names = {"parquet.block.size": block_size, "parquet.page.size": page_size, "parquet.dictionary.page.size": dictionary_page_size, "parquet.writer.version": version}
    df.write.mode(mode).options(compression=codec, **{k: str(v) for k, v in names.items() if v is not None}).parquet(path)


def write_orc(df: DataFrame, path: str, mode: str = "errorifexists", codec: str = "snappy") -> None:
    df.write.mode(mode).option("compression", codec).orc(path)


def write_xml(df: DataFrame, path: str, row_tag: str = "record", root_tag: str = "records", array_tag: str = "item", mode: str = "errorifexists") -> None:
    df.write.mode(mode).format("xml").options(rowTag=row_tag, rootTag=root_tag, arrayElementName=array_tag).save(path)


def write_free_text(df: DataFrame, path: str, template: str, variables: dict[str, str] | None = None, mode: str = "errorifexists") -> None:
    """A line for each row from a template with ${names}; a row's fields win over outside variables."""
    free_text(df, template, variables).write.mode(mode).text(path)


def free_text(df: DataFrame, template: str, variables: dict[str, str] | None = None) -> DataFrame:
    parts = []
    for i, piece in enumerate(re.split(r"\$\{([^}]+)\}", template)):
        if i % 2 == 0:
            parts.append(F.lit(piece))
        elif piece in df.columns:
            parts.append(F.coalesce(F.col(f"`{piece}`").cast("string"), F.lit("")))
        else:
            parts.append(F.lit((variables or {}).get(piece, "")))
    return df.select(F.concat(*parts).alias("value"))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, batch_size: int = 1000) -> None:
    """Batch insert."""
    df.write.jdbc(url, table, mode="append", properties={"batchsize": str(batch_size), **(properties or {})})


def _one_each(source: DataFrame, keys: Sequence[str], sequence: str | None, last: bool) -> DataFrame:
    """A row for each key: the last or first by ``sequence``; without one a repeated key is an error.

    A null in a key equals no other, so such rows all stay.
    """
    rest = [c for c in source.columns if c not in keys]
    whole = F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.struct(F.lit(0).alias("none"))
    if sequence is None:
        one = F.when(F.count("*") == 1, F.first(whole)).otherwise(F.raise_error(F.lit(f"a key ({', '.join(keys)}) of the source is repeated")))
    else:
        one = (F.max_by if last else F.min_by)(whole, F.struct(sequence, F.xxhash64(*source.columns)))
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    grouped = source.filter(known).groupBy(*keys).agg(one.alias("__row"))
    return grouped.select(*(F.col(f"__row.`{c}`") if c in rest else F.col(f"`{c}`") for c in source.columns)).union(source.filter(f"NOT ({known})"))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """The target with the source's rows: of one key the source's counts.

    Of a key that the source repeats the last row by ``sequence``, as if the
    rows had come one after another; without it such a key is an error.
    """
    return union_records(target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns), _one_each(source, keys, sequence, True))


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """The target with those rows of the source whose key it does not have; of a repeated key the first by ``sequence``."""
    return union_records(target, _one_each(source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns), keys, sequence, False))


# The upsert statements of the databases.
_UPSERTS = {
    "postgresql": "INSERT INTO {t} ({c}) VALUES ({v}) ON CONFLICT ({k}) DO UPDATE SET {set_excluded}",
    "mysql": "INSERT INTO {t} ({c}) VALUES ({v}) ON DUPLICATE KEY UPDATE {set_values}",
    "phoenix": "UPSERT INTO {t} ({c}) VALUES ({v})",
}
_IGNORES = {
    "postgresql": "INSERT INTO {t} ({c}) VALUES ({v}) ON CONFLICT ({k}) DO NOTHING",
    "mysql": "INSERT IGNORE INTO {t} ({c}) VALUES ({v})",
}


def merge_statement(table: str, columns: Sequence[str], keys: Sequence[str], dialect: str, ignore: bool = False) -> str:
    """The database's statement to insert a row or, on a key conflict, to update it or to leave it."""
    form = (_IGNORES if ignore else _UPSERTS).get(dialect)
    if form is None:
        raise ValueError(f"no such statement for {dialect}")
    return form.format(t=table, c=", ".join(columns), v=", ".join("?" * len(columns)), k=", ".join(keys), set_excluded=", ".join(f"{c} = EXCLUDED.{c}" for c in columns), set_values=", ".join(f"{c} = VALUES({c})" for c in columns))


def merge_jdbc(df: DataFrame, connect: Callable[[], object], table: str, keys: Sequence[str], dialect: str, ignore: bool = False, batch_size: int = 1000, mark: str = "%s") -> None:
    """Upsert in batches from the tasks, by a function that opens a DB-API connection there; a task that fails leaves nothing."""
    names = df.columns
    sql = merge_statement(table, names, keys, dialect, ignore).replace("?", mark)

    def send(rows: Iterable) -> None:
        connection = connect()
        try:
            cursor, batch = connection.cursor(), []
            for row in rows:
                batch.append(tuple(row))
                if len(batch) >= batch_size:
                    cursor.executemany(sql, batch)
                    batch = []
            if batch:
                cursor.executemany(sql, batch)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    df.foreachPartition(send)


def write_table(df: DataFrame, table: str, mode: str = "append", evolve: bool = False, path: str | None = None) -> None:
    """Rows to a catalog table; ``evolve`` adds columns that the table lacks.  A new table lies at ``path``, else in the warehouse."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        (df.write.option("path", path) if path else df.write).saveAsTable(table)
        return
    have = spark.table(table).columns
    new = [f for f in df.schema.fields if f.name not in have]
    if new and not evolve:
        raise ValueError(f"the table lacks {[f.name for f in new]}")
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in new)})")
    wanted = spark.table(table).schema
    df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted.fields)).write.mode(mode).insertInto(table)


def write_kafka(df: DataFrame, servers: str, topic: str, key: str | None = None, **options: str) -> None:
    """Rows as JSON messages; needs the Kafka connector."""
    kafka_messages(df, key).write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic, **options}).save()


def kafka_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    return df.select((F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_object_store(df: DataFrame, uri: str, kind: str = "parquet", mode: str = "errorifexists", **options: str) -> None:
    df.write.mode(mode).format(kind).options(**options).save(uri)


def write_sequence_file(df: DataFrame, path: str, key: str, value: str) -> None:
    """Pairs to Hadoop sequence files.  Only RDDs write this format."""
    df.select(F.col(key).cast("string"), F.col(value).cast("string")).rdd.map(tuple).saveAsSequenceFile(path)


def route_to_sinks(df: DataFrame, name: str, sinks: dict[str, Callable[[DataFrame], None]], default: Callable[[DataFrame], None] | None = None) -> None:
    """Each row to the sink that its column names; others to the default, or it is an error.

    The source is read once: rows are written to the shared folder by sink, and each sink gets its part.
    """
    path = scratch_path(df.sparkSession, "routed")
    numbers = {sink: i for i, sink in enumerate(sinks)}
    number = F.lit(len(sinks))
    for sink, i in numbers.items():
        number = F.when(F.col(name) == sink, i).otherwise(number)
    df.withColumn("__sink", number).write.partitionBy("__sink").parquet(path)
    routed = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("__sink", T.IntegerType())])).parquet(path)
    part = lambda i: routed.filter(F.col("__sink") == i).drop("__sink")
    rest = part(len(sinks))
    if default is None and not rest.isEmpty():
        raise ValueError("rows name no known sink")
    for sink, write in sinks.items():
        write(part(numbers[sink]))
    if default is not None:
        default(rest)


def put_record(df: DataFrame, write: Callable[[DataFrame], None], send_zero: bool = False) -> bool:
    """Hand rows to a sink; an empty table only with ``send_zero``.  Tells whether it was handed over."""
    if send_zero or not df.isEmpty():
        write(df)
        return True
    return False


def convert_format(spark, source: str, source_format: str, target: str, target_format: str, files: int | None = None, **options: str) -> None:
    """The same rows in another format, in a number of files if given."""
    df = spark.read.format(source_format).options(**options).load(source)
    (df.repartition(files) if files else df).write.format(target_format).save(target)
