"""Small helpers that the operators of this package share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.scratch import scratch_dir, scratch_path, written

__all__ = ["WORDS", "WORD_PATTERN", "free_name", "remainder", "scratch_dir", "scratch_path", "table", "written"]

#: A word: a run of anything but space and the ASCII controls tab to carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD_PATTERN)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; -1 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus, F.lit(-1))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
