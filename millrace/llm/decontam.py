"""Benchmark decontamination over a distributed positional inverted index.

The index is a table of postings (term, text key, position): one row for each
place of a term in a training text.  ``build_index`` writes those of a given
vocabulary, here the words of the tests, as no other list is ever asked for;
without one, of all words.  Texts are keyed by two 64-bit hashes, so equal texts
share their lists.  A posting of the empty word stands behind each text's last
word, so its position is the text's length.

``phrase_matches`` finds every occurrence of phrases:

1. The lengths of all lists are counted, and each phrase's terms ranked from the
   rarest; a phrase with a term that no text has is gone.
2. The lists of its two rarest terms, each position less the term's offset in
   the phrase, are intersected: rows are grouped by (phrase, text, start) and
   stay where both terms are there.
3. For the starts that are left, the other terms are looked up in the postings of
   the texts concerned, at start plus offset; a start with all of them is a match.
   These postings are found by a hash join over shuffles at every size, with a
   text's positions dealt to ``SLICES`` tasks.

``proximity_matches`` finds texts that have all words of a phrase, in any order,
within so many words: positions of the rarest word are met by those of the
others in cells of that length.

Only DataFrame functions are used.  Lists are never collected: they are grouped
and joined by (text, start), with partial aggregation, so neither a frequent
word nor a text with many copies meets in one task.  No side is forced to
broadcast; Spark does so for tests small enough, and joins by shuffles beyond.

Defined cases: a null text has no words; an item without words matches nothing;
an item of fewer words than a window is one window.  Repeated rows get equal
results, null ids too.  Items with a null id count as one, written as nothing.
Equal items are matched once and each counted.  Empty tables give no matches;
columns other than ids and texts are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import written

WINDOW = 10
#: Slices of a text's positions where lists are looked up by text.
SLICES = 16
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word in mixed case; lower-casing A-Z makes it one of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).when(word.rlike("[A-Z]"), F.translate(word, _UPPER, _UPPER.lower())).otherwise(word)


def words(text: str) -> Column:
    """The words of a text in lower case; null for a null text."""
    value = F.col(text).cast("string")
    found = lambda c: F.regexp_extract_all(c, F.lit(_WORD), F.lit(0))
    # most texts, or most words of others, have only ASCII letters, which are cheap to lower
    return F.when(F.octet_length(value) == F.char_length(value), found(F.lower(value))).otherwise(F.transform(found(value), lower_ascii))


def _keys(text: str) -> list[Column]:
    value = F.col(text).cast("string")
    return [F.xxhash64(value).alias("k1"), F.xxhash64(F.lit(1), value).alias("k2")]


def windows(tests: DataFrame, size: int = WINDOW, text: str = "text", id_column: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """((phrase, words, size): the distinct windows of all items; (phrase, item): whose they are)."""
    own = tests.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), words(text).alias("w")).filter(F.size("w") > 0)
    places = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = own.select("item", F.explode(F.transform(places, lambda i: F.slice("w", i, size))).alias("words")).distinct()
    cut = written(cut, "windows-items")
    phrases = written(cut.select("words", F.size("words").alias("size")).distinct().withColumn("phrase", F.monotonically_increasing_id()), "windows")
    return phrases, cut.join(phrases, "words").select("phrase", "item")


def vocabulary(phrases: DataFrame) -> DataFrame:
    """(word, term): a number for each word of the phrases, written."""
    return written(phrases.select(F.explode("words").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id()), "vocabulary")


def build_index(docs: DataFrame, known: DataFrame | None = None, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((term, k1, k2, pos): postings, written; (word, term): the words they are for).

    Postings are written by the tasks that read the texts, without a shuffle.
    ``known`` is a written vocabulary; without it all words are indexed.  The
    empty word is term -1, at the position after each text's last word.
    """
    # keys and words are made once for each text, before its words become rows
    listed = docs.select(*_keys(text), F.concat(words(text), F.array(F.lit(""))).alias("words"))
    tokens = listed.select("k1", "k2", F.posexplode("words").alias("pos", "word"))
    if known is None:
        known = written(tokens.filter("word <> ''").select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "vocabulary")
    end = docs.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(-1).cast("long").alias("term"))
    return written(tokens.join(known.select("word", "term").unionByName(end), "word").select("term", "k1", "k2", "pos"), "postings"), known


def text_lengths(postings: DataFrame) -> DataFrame:
    """(k1, k2, n_words) of every text that is not null."""
    return postings.filter("term = -1").groupBy("k1", "k2").agg(F.max("pos").cast("long").alias("n_words"))


def _of_texts(postings: DataFrame, texts: DataFrame) -> DataFrame:
    """The postings, once each, of the texts (k1, k2)."""
    slice_ = F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)))
    few = texts.select("k1", "k2").distinct().withColumn("slice", slice_).hint("shuffle_hash")
    found = postings.withColumn("slice", F.pmod("pos", F.lit(SLICES))).join(few, ["k1", "k2", "slice"], "left_semi")
    return found.select("term", "k1", "k2", "pos").distinct()


def _ranked(postings: DataFrame, known: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, size, term, off, rank, n) of phrases whose terms all occur; rank 1 is the rarest, of ties the first."""
    terms = phrases.select("phrase", "size", F.posexplode("words").alias("off", "word")).join(known, "word").select("phrase", "size", "off", "term")
    lengths = postings.groupBy("term").agg(F.count("*").alias("n"))
    by = Window.partitionBy("phrase")
    met = terms.join(lengths, "term").withColumns({"rank": F.row_number().over(by.orderBy("n", "off")), "met": F.count("*").over(by)})
    return written(met.filter("met = size").drop("met"), "ranked-terms")


def _bit(rank: str) -> Column:
    return F.expr(f"shiftleft(1L, {rank} - 1)")


def phrase_matches(postings: DataFrame, known: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, k1, k2, start, size): every occurrence of a phrase of up to 63 words, once for each text, written."""
    ranked = _ranked(postings, known, phrases)
    at = ["phrase", "size", "k1", "k2", "start"]
    rare = postings.join(ranked.filter("rank <= 2"), "term").withColumn("start", F.col("pos") - F.col("off")).filter("start >= 0")
    both = rare.groupBy(*at).agg(F.bit_or(_bit("rank")).alias("seen")).filter("seen = if(size > 1, 3, 1)")
    both = written(both.select(*at), "rarest-terms")
    wanted = both.filter("size > 2").join(ranked.filter("rank > 2").select("phrase", "term", "off", "rank"), "phrase").withColumn("pos", F.col("start") + F.col("off"))
    theirs = _of_texts(postings, both.filter("size > 2"))
    whole = wanted.join(theirs, ["k1", "k2", "term", "pos"]).groupBy(*at).agg(F.bit_or(_bit("rank")).alias("seen"))
    return written(whole.filter("seen + 3 = shiftleft(1L, size) - 1").select(*at).unionByName(both.filter("size <= 2")), "phrase-matches")


def proximity_matches(postings: DataFrame, known: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """(phrase, k1, k2, pos): places of a phrase's rarest word that lie in a stretch of ``within`` words with all its distinct words."""
    distinct = phrases.select("phrase", F.array_distinct("words").alias("words")).withColumn("size", F.size("words"))
    ranked = _ranked(postings, known, distinct)
    anchors = postings.join(ranked.filter("rank = 1").select("term", "phrase", "size"), "term").select("phrase", "size", "k1", "k2", F.col("pos").alias("anchor")).distinct()
    anchors = written(anchors, "anchors")
    cell = lambda c: F.floor(F.col(c) / within).cast("long")
    near = anchors.withColumn("cell", F.explode(F.sequence(cell("anchor") - 1, cell("anchor") + 1)))
    near = near.join(ranked.filter("rank > 1").select("phrase", "term", "rank"), "phrase")
    theirs = _of_texts(postings, anchors).withColumn("cell", cell("pos"))
    met = near.join(theirs, ["k1", "k2", "term", "cell"]).filter(F.abs(F.col("pos") - F.col("anchor")) < within).select("phrase", "size", "k1", "k2", "anchor", "pos", "rank")
    own = anchors.select("phrase", "size", "k1", "k2", "anchor", F.col("anchor").alias("pos"), F.lit(1).alias("rank"))
    lists = met.unionByName(own).groupBy("phrase", "size", "k1", "k2", "anchor").agg(F.collect_set(F.struct("pos", "rank")).alias("l"))

    def whole(x: Column) -> Column:
        inside = F.filter("l", lambda y: (y["pos"] >= x["pos"]) & (y["pos"] < x["pos"] + within))
        return (x["pos"] + within > F.col("anchor")) & (x["pos"] <= F.col("anchor")) & (F.size(F.array_distinct(F.transform(inside, lambda y: y["rank"]))) == F.col("size"))

    return lists.filter(F.exists("l", whole)).select("phrase", "k1", "k2", F.col("anchor").alias("pos"))


def matched_texts(matches: DataFrame, owners: DataFrame) -> DataFrame:
    """(k1, k2, n_hit, items): words inside any occurrence, and the sorted items whose windows occur, of each text."""
    spans = matches.groupBy("k1", "k2", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
    covered = F.aggregate(
        F.array_sort("l"), F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto")),
        lambda s, x: F.struct((s["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["upto"]))).alias("hit"), F.greatest(s["upto"], x["end"]).alias("upto")),
    )["hit"]
    hits = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("l")).select("k1", "k2", covered.cast("long").alias("n_hit"))
    items = matches.select("k1", "k2", "phrase").distinct().join(owners, "phrase").groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return hits.join(items, ["k1", "k2"])


def contamination(docs: DataFrame, tests: DataFrame, size: int = WINDOW, text: str = "text", id_column: str = "doc_id", test_text: str = "text", item_column: str = "item_id") -> DataFrame:
    """(id, n_words, n_hit, items) of every document; ``items`` is null where nothing matches."""
    phrases, owners = windows(tests, size, test_text, item_column)
    postings, known = build_index(docs, vocabulary(phrases), text)
    found = matched_texts(phrase_matches(postings, known, phrases), owners)
    found = text_lengths(postings).join(found, ["k1", "k2"], "left")
    own = docs.select(F.col(id_column).alias("__id"), *_keys(text))
    number = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return own.join(found, ["k1", "k2"], "left").select(F.col("__id").alias(id_column), number("n_words"), number("n_hit"), "items")


def contamination_report(docs: DataFrame, tests: DataFrame, **options) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    items = F.coalesce("items", F.array().cast("array<string>"))
    found = contamination(docs, tests, **options)
    return found.select(
        found.columns[0], "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


REPORT_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, ws[i:i + 9] AS w, least(len(ws), 10) AS size FROM b, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS u(i) WHERE len(ws) > 0
), sizes AS (SELECT DISTINCT size FROM bw), phrases AS (SELECT DISTINCT w FROM bw), heads AS (SELECT DISTINCT w[1] AS head FROM bw
), dw AS (
  SELECT doc_id, i, size, ws[i:i + size - 1] AS w FROM d, sizes, unnest(range(1, len(ws) - size + 2)) AS u(i) WHERE ws[i] IN (SELECT head FROM heads)
), m AS (
  SELECT doc_id, i, size, w FROM dw SEMI JOIN phrases USING (w)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT m.doc_id, coalesce(bw.item_id::VARCHAR, '') AS item FROM m JOIN bw USING (w)) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(ws), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
