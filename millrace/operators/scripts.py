"""User code as operators: predicates, transforms, keys, readers, sinks, rules, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage


def script_filter(df: DataFrame, predicate: Callable[[dict, int], bool]) -> DataFrame:
    """Rows for which the user function of (record, index in its partition) is true."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = 0
        for frame in frames:
            keep = []
            for record in frame.to_dict("records"):
                keep.append(bool(predicate(record, index)))
                index += 1
            yield frame[keep]

    return df.mapInPandas(run, df.schema)


def script_transform(df: DataFrame, function: Callable[[dict], dict | list[dict] | None], schema: str) -> DataFrame:
    """A record to none, one or several records of a schema."""
    names = T._parse_datatype_string(schema).fieldNames()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for record in frame.to_dict("records"):
                made = function(record)
                out += made if isinstance(made, list) else [] if made is None else [made]
            yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


def script_partition(df: DataFrame, key: Callable[[dict], str], columns: list[str], name: str = "partition", partitions: int | None = None) -> DataFrame:
    """Adds the user's key of chosen columns and brings equal keys together."""

    @F.pandas_udf("string")
    def run(records: pd.DataFrame) -> pd.Series:
        return pd.Series([key(r) for r in records.to_dict("records")])

    keyed = df.withColumn(name, run(F.struct(*columns)))
    return keyed.repartition(partitions, name) if partitions else keyed.repartition(name)


def script_rules(df: DataFrame, engine: Callable[[dict], list[tuple[str, str]]], columns: list[str]) -> DataFrame:
    """A row for each (action, detail) that the user's engine gives for a record's facts."""

    @F.pandas_udf("array<struct<action:string,detail:string>>")
    def run(facts: pd.DataFrame) -> pd.Series:
        return pd.Series([[{"action": a, "detail": d} for a, d in engine(r)] for r in facts.to_dict("records")])

    return df.withColumn("__a", F.explode(run(F.struct(*columns)))).select(*df.columns, "__a.*")


def reader_source(name: str, schema: str, parts: Callable[[dict], list[object]], read: Callable[[object], Iterable[tuple]]) -> type[DataSource]:
    """A batch data source from two user functions: options to parts, and part to rows."""

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def partitions(self):
            return [InputPartition(p) for p in parts(dict(self.options))]

        def read(self, partition):
            yield from read(partition.value)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader(self.options)

    return Source


def sink_source(name: str, send: Callable[[int, Iterable], int]) -> type[DataSource]:
    """A batch sink from a user function of (partition id, rows) that gives the number sent."""

    class Sent(WriterCommitMessage):
        def __init__(self, rows: int):
            self.rows = rows

    class Writer(DataSourceWriter):
        def write(self, iterator):
            from pyspark import TaskContext

            return Sent(send(TaskContext.get().partitionId(), iterator))

        def commit(self, messages):
            return None

        def abort(self, messages):
            return None

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def writer(self, schema, overwrite):
            return Writer()

    return Source


def read_script(spark: SparkSession, source: type[DataSource], **options: str) -> DataFrame:
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(**options).load()


def write_script(df: DataFrame, source: type[DataSource], **options: str) -> None:
    df.sparkSession.dataSource.register(source)
    df.write.format(source.name()).mode("append").options(**options).save()
