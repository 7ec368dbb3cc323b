"""Line dedup over overlapping three-line windows.

The lines of a text that hold a word are hashed, and every three consecutive
ones form a window.  A window found more than once in the whole table is
repeated; its first occurrence, by (id, place), stays, and the lines of every
later occurrence go, also where it overlaps the first one, so a line on its own
repeated five times leaves its first occurrence's lines that no later one
covers: one.  Covered places of overlapping windows are merged, so a
repeated passage of any length of three lines or more goes as one.

Plan: windows are counted by a partially aggregated shuffle of two 64-bit
hashes, repeated ones are joined back to the occurrences (adaptive skew joins
split a hot window), and places go back to their row by a key.  No group is
ever sorted or collected by window; only one row's places are collected.

Defined cases: a null text stays null; texts of fewer than three lines with a
word have no window and stay as they are; blank lines are never part of a
window and stay; if all lines go the text is empty.  Rows with equal id and
text count as one occurrence and get equal results; null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name

LINES = 3


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n")


def _row_key(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """Adds two hashes that stand for (id, text)."""
    return df.withColumns({"__k1": F.xxhash64(id_column, text), "__k2": F.xxhash64(F.lit(1), text, id_column)})


def line_windows(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(__k1, __k2, id, place, lines, h1, h2) for every window; ``lines`` are positions in the text."""
    own = _row_key(df.select(F.col(id_column).alias("__id"), F.col(text).cast("string").alias("__text")), "__id", "__text")
    numbered = F.transform(_lines("__text"), lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(2), x).alias("b"), x.rlike(r"[^\x20\x09-\x0D]").alias("full")))
    own = own.select("__k1", "__k2", "__id", F.filter(numbered, lambda s: s["full"]).alias("l")).filter(F.size("l") >= LINES)
    at = lambda i, field: [F.col("l")[i + j][field] for j in range(LINES)]
    windows = F.transform(F.sequence(F.lit(0), F.size("l") - LINES), lambda i: F.struct(F.array(*at(i, "i")).alias("lines"), F.xxhash64(*at(i, "a")).alias("h1"), F.xxhash64(*at(i, "b")).alias("h2")))
    return own.select("__k1", "__k2", F.col("__id").alias("id"), F.explode(windows).alias("w")).select("__k1", "__k2", "id", F.col("w.lines")[0].alias("place"), "w.lines", "w.h1", "w.h2")


def removed_lines(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(__k1, __k2, gone): the positions that later occurrences cover, for rows that have any."""
    windows = line_windows(df, text, id_column)
    first = F.min(F.struct("id", "__k1", "__k2", "place"))
    repeated = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1").select("h1", "h2", "first")
    later = windows.join(repeated, ["h1", "h2"]).filter(~F.struct("id", "__k1", "__k2", "place").eqNullSafe(F.col("first")))
    return later.groupBy("__k1", "__k2").agg(F.array_distinct(F.flatten(F.collect_set("lines"))).alias("gone"))


def _with_gone(df: DataFrame, text: str, id_column: str) -> tuple[DataFrame, list[str]]:
    """``df`` with the removed positions beside its own columns, which get safe names."""
    names = [free_name(df, f"__c{i}") for i in range(len(df.columns))]
    own = df.toDF(*names)
    t, i = names[df.columns.index(text)], names[df.columns.index(id_column)]
    own = _row_key(own.withColumn(t, F.col(t).cast("string")), i, t)
    return own.join(removed_lines(df, text, id_column), ["__k1", "__k2"], "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>"))), names


def _kept_text(text: str) -> Column:
    lines = _lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    return F.when(F.size("gone") == 0, F.col(text)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))


def dedup_lines(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``df`` with later occurrences of repeated windows cut from ``text``; all rows and columns stay."""
    marked, names = _with_gone(df, text, id_column)
    t = names[df.columns.index(text)]
    return marked.withColumn(t, _kept_text(t)).select(*names).toDF(*df.columns)


def dedup_report(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n_lines, n_removed, kept_sha256) of every row; a null text counts as empty."""
    marked, names = _with_gone(df.select(id_column, text), text, id_column)
    i, t = names
    return marked.select(
        F.col(i).alias(id_column),
        F.when(F.col(t).isNull(), 0).otherwise(F.size(_lines(t))).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        F.sha2(F.coalesce(_kept_text(t), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


REPORT_SQL = r"""
WITH l AS (
  SELECT doc_id, u.i AS pos, string_split(text, chr(10))[u.i] AS line
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)
), c AS (
  SELECT doc_id, pos, line, lead(line) OVER w AS l2, lead(line, 2) OVER w AS l3, lead(pos) OVER w AS p2, lead(pos, 2) OVER w AS p3
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), win AS (
  SELECT *, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, pos) AS rn FROM c WHERE p3 IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, unnest([pos, p2, p3]) AS pos FROM win WHERE rn > 1
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text FROM l ANTI JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id
), n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
