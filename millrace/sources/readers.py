"""Readers: files, tables, databases, topics, change feeds, generated rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.schema import cast_to, infer_schema


class MissingConnector(RuntimeError):
    """A format needs a jar that the session does not have."""


def _loaded(read, what: str) -> DataFrame:
    try:
        return read()
    except Exception as e:
        if "AVRO_NOT_LOADED" in str(e) or "DATA_SOURCE_NOT_FOUND" in str(e) or "Failed to find data source" in str(e) or "deploy" in str(e).lower():
            raise MissingConnector(f"reading {what} needs its Spark connector on the class path") from e
        raise


def _strict(c: Column, kind: T.DataType, name: str) -> Column:
    """A text as a type; what does not fit is an error, and an empty text is null unless a text is wanted."""
    if isinstance(kind, T.StringType):
        return c
    text = F.when(F.trim(c) != "", c)
    return F.coalesce(text.try_cast(kind), F.when(text.isNotNull(), F.raise_error(F.format_string(f"column {name}: '%s' is no {kind.simpleString()}", text))).cast(kind))


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, drop_unknown: bool = True, header: bool = True, malformed: str | None = None, separator: str = ",") -> DataFrame:
    """By an explicit schema, by place.  Values past the schema are dropped, or kept as unknown_field_index_<i>.

    ``malformed`` names a column for lines that do not fit; without it values of
    the wrong type are errors.  The header is the first line of each file; a
    missing value is null.
    """
    want = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    reader = spark.read.options(sep=separator, header=header, enforceSchema=True, mode="PERMISSIVE")
    if malformed:
        return reader.schema(T.StructType([*want.fields, T.StructField(malformed, T.StringType())])).option("columnNameOfCorruptRecord", malformed).csv(path)
    n = widest = len(want.fields)
    if not drop_unknown:
        # separators inside quotes count too many, which the columns that no row fills show
        most = spark.read.text(path).agg(F.max(F.size(F.split("value", re.escape(separator))))).first()[0] or n
        widest = max(n, most)
    # read as texts, by place: the parser itself has no strict mode that lets a line have more values
    rows = reader.schema(T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(widest)])).csv(path)
    if widest > n:
        last = rows.agg(F.max(F.greatest(F.lit(0), *(F.when(F.col(f"c{i}").isNotNull(), i + 1) for i in range(n, widest))))).first()[0] or 0
        widest = max(n, last)
    known = [_strict(F.col(f"c{i}"), f.dataType, f.name).alias(f.name) for i, f in enumerate(want.fields)]
    return rows.select(*known, *(F.col(f"c{i}").alias(f"unknown_field_index_{i}") for i in range(n, widest)))


def read_csv_header(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """Names from the header line, all columns text."""
    return spark.read.options(header=True, sep=separator, inferSchema=False).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """Types from all rows, by this library's lattice; a file of a header only has text columns."""
    texts = read_csv_header(spark, path, separator)
    return cast_to(texts, infer_schema(texts))


def read_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None, lines: bool = False, malformed: str | None = None) -> DataFrame:
    """Objects or arrays of objects; each array element is a row.  Missing fields are null, others are skipped."""
    reader = spark.read.option("multiLine", not lines).option("mode", "PERMISSIVE" if malformed or schema is None else "FAILFAST")
    if schema is not None:
        want = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        reader = reader.schema(T.StructType([*want.fields, T.StructField(malformed, T.StringType())]) if malformed else want)
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    return reader.json(path)


def read_json_paths(spark: SparkSession, path: str, paths: dict[str, str], whole_files: bool = False) -> DataFrame:
    """A text column for each JSON path, of each line or file."""
    return spark.read.text(path, wholetext=whole_files).select(*(F.get_json_object("value", p).alias(n) for n, p in paths.items()))


def read_avro(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """By the schema in the file or by another in JSON, by the spark-avro jar; ``sources.avro`` reads without it."""
    reader = spark.read.format("avro")
    return _loaded(lambda: (reader.option("avroSchema", schema) if schema else reader).load(path), "Avro")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    """A row for each element; a repeated child is an array, leaves are typed by inference without a schema."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def read_text_lines(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """(value, file): a row for each line, or file."""
    return spark.read.text(path, wholetext=whole).select("value", F.col("_metadata.file_path").alias("file"))


def read_binary(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, modificationTime, length, content)."""
    reader = spark.read.format("binaryFile")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)


def read_sequence_file(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a Hadoop sequence file, as texts.  Only RDDs read this format."""
    return spark.sparkContext.sequenceFile(path).map(lambda kv: (None if kv[0] is None else str(kv[0]), None if kv[1] is None else str(kv[1]))).toDF("key string, value string")


OBJECT_STORES = ("s3a", "abfs", "abfss", "wasb", "wasbs", "gs", "hdfs", "file", "viewfs")


def read_object_store(spark: SparkSession, uri: str, kind: str = "parquet", **options: str) -> DataFrame:
    """The same readers over a store's URI; the store's Hadoop file system has to be on the class path."""
    scheme = uri.split("://")[0] if "://" in uri else "file"
    if scheme not in OBJECT_STORES:
        raise ValueError(f"no such store: {scheme}")
    return spark.read.format(kind).options(**options).load(uri)


def list_files(spark: SparkSession, path: str, known: DataFrame | None = None, pattern: str | None = None) -> DataFrame:
    """(path, modificationTime, length) of files that are new or changed since a listing; content is not read."""
    now = read_binary(spark, path, pattern).select("path", "modificationTime", "length")
    return now if known is None else now.join(known.select("path", "modificationTime", "length"), ["path", "modificationTime", "length"], "left_anti")


def split_statements(sql: str) -> list[str]:
    """Statements between ``;`` that no backslash escapes; empty ones are left out."""
    return [s.replace(r"\;", ";").strip() for s in re.split(r"(?<!\\);", sql) if s.strip()]


def read_jdbc(spark: SparkSession, url: str, sql: str, properties: dict[str, str] | None = None) -> list[DataFrame]:
    """The rows of each SELECT."""
    return [spark.read.format("jdbc").options(url=url, query=s, **(properties or {})).load() for s in split_statements(sql)]


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, slices: int, properties: dict[str, str] | None = None) -> DataFrame:
    """Slices of a table by ranges of a numeric column, read in parallel."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=slices, properties=properties or {})


def table_slices(df: DataFrame, column: str, size: int) -> DataFrame:
    """(low, high, predicate) of slices ``column >= low AND column < high`` over the column's range."""
    bounds = df.agg(F.min(column).alias("a"), F.max(column).alias("b")).filter("a IS NOT NULL")
    low = bounds.select(F.explode(F.sequence(F.col("a").cast("long"), F.col("b").cast("long"), F.lit(size).cast("long"))).alias("low"))
    return low.select("low", (F.col("low") + size).alias("high"), F.format_string(f"{column} >= %d AND {column} < %d", "low", F.col("low") + size).alias("predicate"))


def paged_sql(sql: str, order: str, size: int, number: int, dialect: str = "standard") -> str:
    """One page of a query in a database's own form: LIMIT/OFFSET, ROWNUM or ROW_NUMBER()."""
    low, high = number * size, (number + 1) * size
    if dialect == "oracle":
        return f"SELECT * FROM (SELECT a.*, ROWNUM rnum FROM ({sql} ORDER BY {order}) a WHERE ROWNUM <= {high}) WHERE rnum > {low}"
    if dialect == "mssql2008":
        return f"SELECT * FROM (SELECT q.*, ROW_NUMBER() OVER (ORDER BY {order}) rnum FROM ({sql}) q) p WHERE rnum > {low} AND rnum <= {high}"
    return f"{sql} ORDER BY {order} LIMIT {size} OFFSET {low}"


def read_page(df: DataFrame, order: Sequence[str], size: int, number: int) -> DataFrame:
    """One page, from 0."""
    from millrace.operators.analytics import page

    return page(df, order, size, number)


def read_incremental(df: DataFrame, column: str, state: DataFrame | None, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows above the stored maximum of (name, value), the new state of one row)."""
    kind = df.schema[column].dataType
    # the largest by the column's own order, not that of texts
    saved = state.filter(F.col("name") == name).agg(F.max(F.col("value").cast(kind)).cast("string")).first()[0] if state is not None else None
    fresh = df if saved is None else df.filter(F.col(column) > F.lit(saved).cast(kind))
    return fresh, fresh.agg(F.lit(name).alias("name"), F.coalesce(F.max(column).cast("string"), F.lit(saved)).alias("value"))


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(name, database, type, temporary) of a catalog's tables."""
    rows = [(t.name, ".".join(t.namespace or []), t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, database string, type string, temporary boolean")


def read_kafka(spark: SparkSession, servers: str, topic: str, schema: str | None = None, stream: bool = False, **options: str) -> DataFrame:
    """A row for each record's value, as JSON of a schema if one is given; needs the Kafka connector."""
    reader = (spark.readStream if stream else spark.read).format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, **options})
    df = _loaded(reader.load, "Kafka")
    return kafka_rows(df, schema)


def kafka_rows(df: DataFrame, schema: str | None) -> DataFrame:
    """Key, offset and the value's fields of rows as the Kafka source gives them."""
    value = F.col("value").cast("string")
    parsed = F.from_json(value, schema) if schema else F.struct(value.alias("value"))
    return df.select(F.col("key").cast("string").alias("key"), "topic", "partition", "offset", parsed.alias("r")).select("key", "topic", "partition", "offset", "r.*")


def read_hive(spark: SparkSession, sql: str) -> DataFrame:
    """A SELECT over the session's catalog."""
    return spark.sql(sql)


def generate_rows(spark: SparkSession, n: int, text: Column | str, attributes: dict[str, Column | str] | None = None, stream_rate: int | None = None) -> DataFrame:
    """Rows with an index, a text, and attributes; endless at ``stream_rate`` a second if that is given."""
    base = spark.readStream.format("rate").option("rowsPerSecond", stream_rate).load().select(F.col("value").alias("id")) if stream_rate else spark.range(n)
    made = lambda v: v if isinstance(v, Column) else F.lit(v)
    return base.select("id", made(text).alias("text"), *(made(v).alias(k) for k, v in (attributes or {}).items()))


def read_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A row for each feature: type and JSON of the geometry, and the properties by a schema."""
    schema = f"features array<struct<geometry:struct<type:string,coordinates:string>,properties:struct<{properties}>>>"
    return spark.read.option("multiLine", True).schema(schema).json(path).select(F.explode("features").alias("f")).select(F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"), "f.properties.*")
