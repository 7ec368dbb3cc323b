"""The folder that driver and executors share, for tables between steps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """From ``spark.checkpoint.dir``, or as the context has it.

    Where the session names none, a local master gets a temporary folder that
    goes when the process ends; on a cluster it is an error, as executors and
    driver have to share the folder.  What is written to a named folder stays
    there until its owner clears it.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not known:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="spark-checkpoint-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
        known = context.getCheckpointDir()
    return known.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in that folder that nothing else uses."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Spark's setting by which an execution's shuffle files go when it ends, not when the driver next collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write as Parquet to the shared folder and read back, which cuts the lineage; shuffle files of the writing go."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before) if before is not None else spark.conf.unset(FREE_SHUFFLES)
    return spark.read.schema(df.schema).parquet(path)
