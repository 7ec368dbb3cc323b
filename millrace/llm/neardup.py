"""N-gram Jaccard join by MinHash banding, and the classes of near duplicates.

A text's set is its word 5-grams (all its words as one gram if it has fewer).
Two different texts are linked if their sets' Jaccard similarity is at least
0.8.  Rows per band and bands are chosen so that a pair at the threshold shares
a band with probability ``RECALL``; band hashes are shuffled, and every pair
that shares a bucket is verified on the full sets.

* Equal texts are one node from the start; they are never paired.
* A bucket of at most ``SMALL`` nodes gives its pairs, each verified once.
* A larger bucket is cut by set size, in classes so wide that only sets of one
  class or of neighbours can be similar enough, and each class in chunks of
  about ``CHUNK`` nodes, or fewer of many grams.  Each pair of chunks that can hold links is one group,
  which verifies all its pairs in numpy and returns only
  each node's number of links and a spanning forest of them.  A pair that
  meets in several buckets counts in one of them, so numbers are exact and a
  hot bucket is dealt over many tasks without a row for each pair.
* Gram hashes are made once for each node and travel in place of the texts;
  nodes meet them before they are dealt to pairs of chunks, so no node is a
  hot key of a join.
* Classes are the connected components of the links, found by alternating
  large-star and small-star steps on written tables; 50 rounds without an end
  (a chain of more than about 2^25 texts) are an error.

Defined cases: texts with no words, null ones included, are never linked and
are classes of their own row; rows with a null id get a null class and no
links; repeated ids with different texts are different nodes; the class id is
the smallest id in it.  Ids are whole numbers (texts of them are read, others
are an error); an empty table gives an empty result; other columns, of any
name, are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORDS, free_name, written

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9995
MAX_HASHES = 128
SMALL = 32
CHUNK = 512
#: Gram hashes in a chunk, which long texts fill before ``CHUNK`` nodes do (8 MB).
CHUNK_GRAMS = 1 << 20
#: Hashes that a worker keeps, and the longest words that they are kept of.
KNOWN_WORDS = 100_000
KNOWN_LETTERS = 64
_M = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, (2, MAX_HASHES), dtype=np.uint64)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows with which ``most`` hashes reach the recall at the threshold."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("the recall needs more hashes")


_known: dict[str, int] = {}


def _word_hash(word: str) -> int:
    value = _known.get(word)
    if value is None:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= KNOWN_LETTERS:
            if len(_known) >= KNOWN_WORDS:
                _known.clear()
            _known[word] = value
    return value


def gram_hashes(text: str | None, n: int = GRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams."""
    words = WORDS.findall(text or "")
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array([_word_hash(w) for w in words], np.uint64)
    size = min(n, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            total = (total ^ h[j : j + len(total)]) * _M
            total ^= total >> np.uint64(31)
    return np.unique(total)


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash of each band's minima, with the band's number mixed in."""
    a, b = (s[: bands * rows] for s in _SEEDS)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(grams), 512):
            x = grams[i : i + 512, None] * (a | np.uint64(1))
            x ^= b
            low = np.minimum(low, (x * _M).min(axis=0))
        out = np.arange(bands, dtype=np.uint64) * _M
        for j in range(rows):
            out = (out ^ low.reshape(bands, rows)[:, j]) * _M
            out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _nodes(df: DataFrame, text: str, id_column: str) -> DataFrame:
    """(id, node, text): a node stands for all equal texts."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return df.select(F.col(id_column).cast("long").alias("id"), F.unhex(F.md5(t)).alias("node"), t.alias("text"))


def sketch(nodes: DataFrame, bands: int, rows: int, n: int = GRAM) -> DataFrame:
    """(id, node, size, bands) of rows with an id and a word; ``size`` is that of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sizes, hashes = [], [], []
            last, found = None, None
            for i, (node, text) in enumerate(zip(batch.column(1), batch.column(2))):
                if node != last:
                    grams = gram_hashes(text.as_py(), n)
                    last, found = node, band_hashes(grams, bands, rows) if len(grams) else None
                if found is not None:
                    keep.append(i)
                    sizes.append(len(grams))
                    hashes.append(found)
            picked = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(picked), batch.column(1).take(picked), pa.array(sizes, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], ["id", "node", "size", "bands"])

    return nodes.filter("id IS NOT NULL").mapInArrow(run, "id long, node binary, size long, bands array<long>")


def gram_table(texts: DataFrame, n: int) -> DataFrame:
    """(node, grams): the sorted gram hashes of (node, text) rows as 64-bit numbers in one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([gram_hashes(t.as_py(), n).tobytes() for t in part.column(1)], pa.binary())], ["node", "grams"])

    return texts.select("node", "text").mapInArrow(run, "node binary, grams binary")


def verify_pairs(pairs: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, own = [], None, None
            for i, (a, ta, tb) in enumerate(zip(batch.column(0), batch.column(2), batch.column(3))):
                if a != last:
                    last, own = a, np.frombuffer(ta.as_py(), np.uint64)
                other = np.frombuffer(tb.as_py(), np.uint64)
                both = len(np.intersect1d(own, other, assume_unique=True))
                if both >= threshold * (len(own) + len(other) - both) - 1e-9:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)], ["a", "b"])

    second = grams.select(F.col("node").alias("b"), F.col("grams").alias("tb"))
    first = grams.select(F.col("node").alias("a"), F.col("grams").alias("ta"))
    return pairs.join(second, "b").join(first, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def _common(left: np.ndarray, right: np.ndarray, grams: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left set with each right set."""
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    _, where, times = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = times[where] > 1
    columns, where = np.unique(where[shared], return_inverse=True)
    owner = owner[shared]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(where, kind="stable")
    where, owner = where[order], owner[order]
    for start in range(0, len(columns), 4096):
        a, b = np.searchsorted(where, [start, start + 4096])
        m = np.zeros((len(grams), 4096), np.float32)
        m[owner[a:b], where[a:b] - start] = 1
        out += m[left] @ m[right].T
    return out


def link_chunks(groups: DataFrame, threshold: float, bands: int) -> DataFrame:
    """(a, b, n) for each pair of chunks: forest edges (a, b, 0) and numbers of links (a, null, n)."""
    schema = "a binary, b binary, n long"
    names = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64())])

    def run(key: tuple, group: pa.Table) -> pa.Table:
        band, one_chunk = key[1].as_py(), key[2].as_py() == key[3].as_py()
        node = group.column("node").to_pylist()
        side = np.array(group.column("side").to_pylist())
        grams = [np.frombuffer(g, np.uint64) for g in group.column("grams").to_pylist()]
        size = np.array([len(g) for g in grams], np.float32)
        marks = np.zeros((2, len(node), bands), np.int64)  # small buckets, large buckets
        for i, own in enumerate(group.column("marks").to_pylist()):
            for m in own:
                marks[int(m["large"]), i, m["band"]] = m["bucket"]
        left = np.flatnonzero(side == 0)
        right = left if one_chunk else np.flatnonzero(side == 1)
        both = _common(left, right, grams)
        linked = both >= threshold * (size[left][:, None] + size[right][None, :] - both) - 1e-4
        for i, row in enumerate(linked):
            hit = np.flatnonzero(row)
            if one_chunk:
                hit = hit[hit > i]
            row[:] = False
            x, others = marks[:, left[i]], right[hit]
            small = ((marks[0, others] == x[0]) & (x[0] != 0)).any(axis=1)
            large = (marks[1, others] == x[1]) & (x[1] != 0)
            row[hit[~small & (large.argmax(axis=1) == band)]] = True
        counts = np.zeros(len(node), np.int64)
        np.add.at(counts, left, linked.sum(axis=1))
        np.add.at(counts, right, linked.sum(axis=0))
        parent = list(range(len(node)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        rows = [(node[i], None, int(counts[i])) for i in np.flatnonzero(counts)]
        for i, j in np.argwhere(linked):
            p, q = root(int(left[i])), root(int(right[j]))
            if p != q:
                parent[p] = q
                rows.append((node[left[i]], node[right[j]], 0))
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else ((), (), ()), names)], schema=names)

    return groups.groupBy("bucket", "band", "ci", "cj").applyInArrow(run, schema)


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root) of all nodes with an edge; the root is the smallest node of its component."""
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        # large star: each node's larger neighbours go to its least neighbour
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: each node and its smaller neighbours go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = written(small.filter("a <> b").distinct(), "edges")
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _classes(df: DataFrame, text: str, id_column: str, n: int = GRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows as (id, node, text), those with an id and a word as (id, node, ...), and the class of each such node.

    A class is (node, class_id, n_links, first); ``first`` is the node of the row that gives the class its id.
    """
    bands, rows = choose_bands(threshold, recall)
    all_rows = _nodes(df, text, id_column)
    sketches = written(sketch(all_rows, bands, rows, n), "sketches")
    reps = sketches.groupBy("node").agg(F.min("id").alias("rep"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    banded = reps.select("node", "rep", "size", F.posexplode("bands").alias("band", "bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    members = written(banded.join(sizes, "bucket").select("bucket", "band", "node", "rep", "size", (F.col("m") > SMALL).alias("large")), "members")
    chosen = members.select("node", "rep").distinct()
    texts = all_rows.join(chosen.withColumnRenamed("rep", "id"), ["node", "id"], "left_semi").select("node", "text").dropDuplicates(["node"])
    grams = written(gram_table(texts, n), "grams")

    # small buckets: at most SMALL nodes are collected, and give each of their pairs
    own = members.filter("NOT large").groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("node", "size"))).alias("l"))
    near = lambda x, y: F.least(x["size"], y["size"]) >= (threshold - 1e-6) * F.greatest(x["size"], y["size"])
    tails = F.transform("l", lambda x, i: F.transform(F.filter(F.slice(F.col("l"), i + 2, F.size("l")), lambda y: near(x, y)), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b"))))
    pairs = own.select(F.explode(F.flatten(tails)).alias("p")).select("p.a", "p.b").distinct()
    links = written(verify_pairs(pairs, grams, threshold), "links")

    # large buckets: pairs of chunks; sets whose sizes lie two classes apart cannot be linked
    large = members.filter("large").withColumn("band_of_size", F.floor(F.log(F.col("size").cast("double")) / -math.log(threshold - 1e-6)))
    marks = members.join(large.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.collect_list(F.struct("band", "bucket", "large")).alias("marks"))
    chunks_of = written(large.groupBy("bucket", "band_of_size").agg(F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("size") / CHUNK_GRAMS)).cast("int").alias("k")), "chunks")
    around = chunks_of.select("bucket", F.explode(F.array(*(F.col("band_of_size") + d for d in (-1, 0, 1)))).alias("band_of_size"), F.struct(F.col("band_of_size").alias("s"), "k").alias("c"))
    around = around.groupBy("bucket", "band_of_size").agg(F.collect_list("c").alias("near"))
    # written, so that its size is known when the join is planned, and a hot bucket is not dealt by its number
    chunks = large.join(written(chunks_of.join(around, ["bucket", "band_of_size"]), "chunks-around"), ["bucket", "band_of_size"])
    mine = F.struct(F.col("band_of_size").alias("s"), F.pmod(F.xxhash64("node", "bucket"), F.col("k")).cast("int").alias("c"))
    # what a node is compared with is met by the node first, then dealt
    dealt = chunks.select("bucket", "band", "node", "near", mine.alias("mine")).join(marks, "node").join(grams, "node")
    others = F.flatten(F.transform("near", lambda c: F.transform(F.sequence(F.lit(0), c["k"] - 1), lambda j: F.struct(c["s"].alias("s"), j.alias("c")))))
    place = F.transform(others, lambda o: F.struct(F.least("mine", o).alias("ci"), F.greatest("mine", o).alias("cj"), F.when(F.col("mine") <= o, 0).otherwise(1).alias("side")))
    groups = dealt.withColumn("g", F.explode(place)).select("bucket", "band", "node", "g.*", "marks", "grams")
    found = written(link_chunks(groups, threshold, bands), "chunk-links")

    edges = links.union(found.filter("b IS NOT NULL").select("a", "b"))
    counts = links.select(F.col("a").alias("node"), F.lit(1).cast("long").alias("n")).union(links.select("b", F.lit(1).cast("long"))).union(found.filter("b IS NULL").select("a", "n"))
    counts = counts.groupBy("node").agg(F.sum("n").alias("n_links"))
    rooted = components(edges)
    named = reps.select("node", "rep")
    of_root = rooted.join(named, "node").groupBy("root").agg(F.min(F.struct("rep", "node")).alias("least")).select("root", F.col("least.rep").alias("class_id"), F.col("least.node").alias("first"))
    linked = rooted.join(of_root, "root").join(counts, "node", "left").select("node", "class_id", "first", "n_links")
    by_node = named.join(linked, "node", "left").select("node", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("first", "node").alias("first"))
    return all_rows, sketches, written(by_node, "by-node")


def near_duplicates(df: DataFrame, text: str = "text", id_column: str = "doc_id", n: int = GRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, class_id, n_links) of every row; ``n_links`` counts the different texts linked to the row's."""
    all_rows, _, by_node = _classes(df, text, id_column, n, threshold, recall)
    # the join stands alone, so a text with many copies is split as a skewed key
    out = all_rows.select("id", "node").join(by_node, "node", "left")
    return out.select(F.col("id").alias(id_column), F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"), F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"))


def keep_one_each(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``df`` with one row of each class: that which gives the class its id, by id and text.

    Of rows equal in both, any one stays.  Rows with a null id, and rows
    without words, all stay.
    """
    _, sketches, by_node = _classes(df, text, id_column)
    kept = by_node.filter("node = first").select(F.col("class_id").alias("__id"), F.col("node").alias("__node"))
    # rows that the table repeats need one picked; without any, rows only meet the small table of ids
    repeated = sketches.groupBy("id", "node").count().filter("count > 1").limit(1).count() > 0
    names = [free_name(df, f"__c{i}") for i in range(len(df.columns))]
    own = df.toDF(*names)
    i, t = names[df.columns.index(id_column)], names[df.columns.index(text)]
    node = F.unhex(F.md5(F.coalesce(F.col(t).cast("string"), F.lit(""))))
    sorted_out = F.col(i).isNotNull() & F.coalesce(F.col(t).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    out = own.filter(sorted_out).join(kept, (F.col(i).cast("long") == F.col("__id")) & (node == F.col("__node")), "left_semi")
    if repeated:
        out = out.dropDuplicates([i, t])
    return out.union(own.filter(~sorted_out)).toDF(*df.columns)
