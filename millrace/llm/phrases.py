"""Phrase collocations by relational mining of sorted occurrences (SETM).

Texts are cut in pieces at punctuation and line ends, and pieces in words.  The
occurrences of phrases of k words are a relation (block, place, phrase), sorted
by place and kept as a table; places run through the pieces of a block of
neighbouring texts and skip one between pieces, so adjacent places are adjacent
words of one piece.

1. The relation of single words is written, in blocks of packed numbers.
2. Words are counted in each block, then over all blocks of a language; a
   semi-join with the frequent ones leaves the relation of frequent words.
3. For k = 2, 3, ... the relation is merge-joined with itself by piece and
   adjacent position: phrases of k - 1 words at places p and p + 1 make one of k
   words at p.  Its groups, a pair of numbers, are counted by block and then over
   all blocks; a semi-join with the frequent groups gives the next relation.

A phrase of k words is frequent only if both its parts of k - 1 words are, so no
frequent one is lost.  The frequent phrases of k words are numbered from 0, so a
pair of them is one number of 64 bits and stands for the phrase exactly; a mix of it
only deals it out.  What a block of about ``BLOCK_TOKENS`` tokens has counted goes to
the group once.  Words are summed over a window.  Groups of pairs are dealt in ranges,
and a block's pairs of one range travel as one message, sorted and packed; the range
adds up and returns, for each message, the numbers of its frequent pairs.  Scores are
decimals of 38 digits, exact for counts of 64 bits.

Defined cases: a null text is empty and has no words, a null language is
``und``, like the text "und".  Repeated rows count again.  Pieces never go over
a text's end.  A text longer than a block makes its block longer.  An empty
table gives an empty result; columns other than text and language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import written
from millrace.llm.lm import _by_range, _expanded, _mix, _pack, _unpack
from millrace.operators.records import numbered

LEAST, LONGEST, TOP = 30, 4, 2000
#: A phrase inside a longer one with at least this percent of its frequency is dropped.
PERCENT = 80
SCALE = 2_000_000
#: Characters at which pieces end.
ENDS = "\n\x0b\x0c\r.,;:!?"
BLOCK_TOKENS = 1 << 20
#: Tokens of text for each range of groups.
RANGE_TOKENS = 4 << 20
#: Rows of found phrases handed on at once.
GROUP_ROWS = 1 << 17
#: Slices in which a language is ranked before its first ``TOP`` meet.
RANK_SLICES = 1024
#: Bits of a place in a block, and of a block in its task, in the number of a phrase.
PLACE_BITS, BLOCK_BITS, TASK_BITS = 29, 14, 20
#: By which a pair is multiplied before it is mixed.
_ODD = np.uint64(0x2545F4914F6CDD1D)
_MARKS = bytes.maketrans(b"\t" + ENDS.encode(), b" " + b"\n" * len(ENDS))


class _Words(dict):
    """The numbers, from 1, of one language's words in a block."""

    def __init__(self, lang: str, known: list[tuple[str, bytes]]):
        super().__init__({b"": -1, b"\n": 0})
        self.lang, self.known = lang, known

    def __missing__(self, word: bytes) -> int:
        self.known.append((self.lang, word))
        self[word] = number = len(self.known)
        return number


class _Block:
    """Word numbers of neighbouring texts; 0 ends a piece."""

    def __init__(self):
        self.known: list[tuple[str, bytes]] = []
        self.langs: dict[str, _Words] = {}
        self.grams: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes, lang: str) -> None:
        # lower-casing of bytes is that of A-Z; every end of a piece is a word of its own
        tokens = text.lower().translate(_MARKS).replace(b"\n", b" \n ").split(b" ")
        words = self.langs.get(lang) or self.langs.setdefault(lang, _Words(lang, self.known))
        ids = np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))
        ids = ids[ids >= 0]
        self.grams += [ids, np.zeros(1, np.int32)]
        self.size += len(ids) + 1

    def row(self, block: int) -> pa.RecordBatch:
        grams = np.concatenate(self.grams)
        n = np.bincount(grams, minlength=len(self.known) + 1)[1:]
        fields = {"local": pa.array(np.arange(1, len(n) + 1, dtype=np.int32)), "lang": pa.array([k[0] for k in self.known], pa.string()), "word": pa.array([k[1] for k in self.known], pa.binary()).cast(pa.string()), "n": pa.array(n.astype(np.int64))}
        words = pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_packed(grams)], pa.binary()), words], ["block", "grams", "words"])


def _packed(grams: np.ndarray) -> bytes:
    return pa.compress(_pack(grams), "zstd", asbytes=True) if len(grams) else b""


def _opened(raw: bytes) -> np.ndarray:
    return _unpack(_expanded(raw)).astype(np.int64) if raw else np.zeros(0, np.int64)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made, block = TaskContext.get().partitionId(), 0, _Block()
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            batch = whole.slice(first, 256)
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block.add(text, lang)
                if block.size >= BLOCK_TOKENS:
                    yield block.row(_number(task, made))
                    made, block = made + 1, _Block()
    if block.size:
        yield block.row(_number(task, made))


def _number(task: int, made: int) -> int:
    if task >> TASK_BITS or made >> BLOCK_BITS:
        raise ValueError("more tasks, or more blocks in a task, than numbers")
    return task << BLOCK_BITS | made


def word_relation(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(block, grams, words): the occurrences of all words, and each block's words with their counts."""
    own = df.select(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("t"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("l"))
    return own.mapInArrow(_to_blocks, "block long, grams binary, words array<struct<local:int,lang:string,word:string,n:long>>")


_RELATION = "block long, grams binary, ids binary"


def _relation(block: int, grams: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """``ids``, ascending, are the phrases' numbers over all blocks; ``grams`` has their places in it from 1, 0 for none."""
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_packed(grams)], pa.binary()), pa.array([_packed(np.diff(ids, prepend=0))], pa.binary())], ["block", "grams", "ids"])


def _fields(column: pa.Array, r: int) -> list[np.ndarray]:
    """The fields of row ``r`` of a column of arrays of records."""
    inner = column.slice(r, 1).flatten()
    return [f.to_numpy(zero_copy_only=False).astype(np.int64) for f in inner.flatten()]


def _keep_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The semi-join of a block's word occurrences with the frequent words."""
    for batch in batches:
        for r in range(batch.num_rows):
            local, ids = _fields(batch.column("back"), r)
            grams, order = _opened(batch.column("grams")[r].as_py()), np.argsort(ids)
            new = np.zeros(max(int(grams.max(initial=0)), int(local.max(initial=0))) + 1, np.int64)
            new[local[order]] = np.arange(1, len(order) + 1)
            yield _relation(batch.column("block")[r].as_py(), new[grams], ids[order])


def _adjacent(grams: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The relation merge-joined with itself on (piece, position + 1): places, and pairs of phrases as one number."""
    places = np.flatnonzero(grams)
    at = np.flatnonzero(places[1:] == places[:-1] + 1)
    left = places[at]
    return left, grams[left] * (size + 1) + grams[left + 1]


def _pairs(grams: np.ndarray, ids: np.ndarray, known: int, ranges: int) -> tuple[np.ndarray, ...]:
    """Places, the number of the distinct pair at each, the pairs' numbers in the order of their ranges, that order, and the range of each in it."""
    places, keys = _adjacent(grams, len(ids))
    keys, where = np.unique(keys, return_inverse=True)
    size = len(ids) + 1
    keys = ids[keys // size - 1] * known + ids[keys % size - 1]
    with np.errstate(over="ignore"):
        owner = ((_mix(keys.astype(np.uint64) * _ODD) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return places, where, keys[order], order, owner[order]


def _messages(known: int, ranges: int):  # noqa: ANN202
    """(range, block, keys, counts): a block's pairs at adjacent places, ascending in each range, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, grams, ids in zip(*(batch.column(c).to_pylist() for c in ("block", "grams", "ids"))):
                _, where, keys, order, owner = _pairs(_opened(grams), np.cumsum(_opened(ids)), known, ranges)
                if len(keys):
                    counts = np.bincount(where)[order]
                    cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(keys)]
                    sent = [(int(owner[a]), _packed(np.diff(keys[a:b], prepend=0)), _packed(counts[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]
                    part, packed, n = zip(*sent)
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([block] * len(sent), pa.int64()), pa.array(packed, pa.binary()), pa.array(n, pa.binary())], ["range", "block", "keys", "counts"])

    return run


_COUNTED = "range int, block long, numbers binary, keys array<long>, a array<long>"


def _add_up(least: int):  # noqa: ANN202
    """For each message of a range, its pairs' numbers among the range's frequent ones, from 1, 0 for others; and, as block -1, these with their sums."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        blocks = group.column("block").to_pylist()
        own = [np.cumsum(_opened(k)) for k in group.column("keys").to_pylist()]
        every, where = np.unique(np.concatenate(own), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, where, np.concatenate([_opened(c) for c in group.column("counts").to_pylist()]))
        often = total >= least
        numbers, ends = np.where(often, np.cumsum(often), 0)[where], np.cumsum([len(k) for k in own]).tolist()
        packed = [_packed(numbers[end - len(k) : end]) for k, end in zip(own, ends)]
        found = [[None] * len(own) + [x[often]] for x in (every, total)]
        columns = pa.array([key[0].as_py()] * (len(own) + 1), pa.int32()), pa.array([*blocks, -1], pa.int64()), pa.array([*packed, None], pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in found)
        return pa.Table.from_arrays(columns, ["range", "block", "numbers", "keys", "a"])

    return run


def _found(known: int, before: dict[int, int]):  # noqa: ANN202
    """(id, g1, g2, a) of the frequent pairs of ranges, numbered over all ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                keys, a = (batch.column(c).slice(r, 1).flatten().to_numpy() for c in ("keys", "a"))
                ids = np.arange(len(keys)) + before[batch.column("range")[r].as_py()]
                for at in range(0, len(keys), GROUP_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(x[at : at + GROUP_ROWS]) for x in (ids, keys // known, keys % known, a)], ["id", "g1", "g2", "a"])

    return run


def _keep_groups(known: int, ranges: int, before: dict[int, int]):  # noqa: ANN202
    """The semi-join of a block's joined occurrences with the frequent groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, grams, ids, back in zip(*(batch.column(c).to_pylist() for c in ("block", "grams", "ids", "back"))):
                grams = _opened(grams)
                places, where, _, order, owner = _pairs(grams, np.cumsum(_opened(ids)), known, ranges)
                back.sort(key=lambda x: x["range"])
                numbers = np.concatenate([_opened(x["numbers"]) for x in back])
                hit = np.flatnonzero(numbers)
                new = numbers[hit] - 1 + np.repeat([before[x["range"]] for x in back], np.diff(np.searchsorted(owner, [x["range"] for x in back] + [ranges])))[hit]
                by_id = np.argsort(new)
                local = np.zeros(len(order), np.int64)
                local[order[hit[by_id]]] = np.arange(1, len(hit) + 1)
                made = np.zeros(len(grams), np.int64)
                made[places] = local[where]
                if len(hit):
                    yield _relation(block, made, new[by_id])

    return run


def _frequent(counted: DataFrame, keys: list[str], place: str, least: int, label: str, once: list[str]) -> DataFrame:
    """The rows of blocks for groups counted ``least`` times or more, with the sum ``a``, the group's number ``id``, and ``first`` on one row of each; written.

    Columns named in ``once`` have values on the first rows only.
    """
    own = F.shiftleft("block", PLACE_BITS).bitwiseOR(F.col(place).cast("long"))
    by = Window.partitionBy(*keys)
    summed = counted.withColumn("own", own).withColumns({"a": F.sum("n").over(by), "id": F.min("own").over(by)})
    found = summed.filter(F.col("a") >= least).withColumn("first", F.col("own") == F.col("id")).drop("own", "n")
    return written(found.withColumns({c: F.when(F.col("first"), F.col(c)) for c in once}), label)


def _with_back(relation: DataFrame, back: DataFrame, fields: list[str]) -> DataFrame:
    """Each block's rows of ``back`` beside its relation; blocks without any have no frequent phrase and go.

    A merge join at every size: what goes back to the blocks grows with them.
    """
    return relation.join(back.groupBy("block").agg(F.collect_list(F.struct(*fields)).alias("back")).hint("merge"), "block")


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n): all word occurrences of each language; for k = 1..``longest`` the frequent phrases of k words).

    A table of phrases has id, lang, words, ``prefixes`` (the frequencies of the
    first 1, 2, ..., k words) and ``suffixes`` (of the last 1, 2, ..., k words).
    """
    blocks = written(word_relation(df, text, lang), "phrases-words")
    ranges = max(1, -(-blocks.count() * BLOCK_TOKENS // RANGE_TOKENS))
    words = blocks.select("block", F.explode("words").alias("w")).select("block", "w.*")
    back = _frequent(words, ["lang", "word"], "local", least, "phrases-found-1", ["lang", "word", "a"])
    found = numbered(back.filter("first").select("id", "lang", "word", "a"), ["id"], "number")
    found = found.select("id", "number", "lang", F.array("word").alias("words"), F.array("a").alias("prefixes"), F.array("a").alias("suffixes"))
    tables, labels = [], written(found, "phrases-1")
    tables.append(labels.select(F.col("number").alias("id"), "lang", "words", "prefixes", "suffixes"))
    back = back.select("block", "local", "id").join(labels.select("id", "number"), "id").select("block", "local", F.col("number").alias("id"))
    relation = _with_back(blocks.select("block", "grams"), back, ["local", "id"]).mapInArrow(_keep_words, _RELATION)
    known = labels.count()
    for k in range(2, longest + 1):
        if known >= 3_000_000_000:
            raise ValueError("more frequent phrases than pairs of them have numbers")
        relation = written(relation, f"phrases-relation-{k - 1}")
        messages = relation.mapInArrow(_messages(max(1, known), ranges), "range int, block long, keys binary, counts binary")
        counted = written(_by_range(messages, ranges).groupBy("range").applyInArrow(_add_up(least), _COUNTED), f"phrases-counted-{k}")
        # a number for each range: how many frequent pairs it has
        before, sizes = {}, counted.filter("block < 0").select("range", F.size("keys").alias("n")).orderBy("range").collect()
        total = 0
        for r in sizes:
            before[r["range"]], total = total, total + r["n"]
        of_pair = counted.filter("block < 0").select("range", "keys", "a").mapInArrow(_found(max(1, known), before), "id long, g1 long, g2 long, a long")
        side = lambda name: tables[-1].select(F.col("id").alias(name), F.struct("lang", "words", "prefixes", "suffixes").alias(f"of_{name}"))  # noqa: E731, B023
        found = of_pair.join(side("g1"), "g1").join(side("g2"), "g2").select(
            "id", "of_g1.lang", F.concat("of_g1.words", F.slice("of_g2.words", -1, 1)).alias("words"),
            F.concat("of_g1.prefixes", F.array("a")).alias("prefixes"), F.concat("of_g2.suffixes", F.array("a")).alias("suffixes"),
        )
        tables.append(written(found, f"phrases-{k}"))
        relation = _with_back(relation, counted.filter("block >= 0"), ["range", "numbers"]).mapInArrow(_keep_groups(max(1, known), ranges, before), _RELATION)
        known = total
    return words.groupBy("lang").agg(F.sum("n").alias("n")), tables


def _weakest_cut(k: int) -> Column:
    """(score, cut, l, r) of the cut with the lowest score, of ties the first."""

    def at(cut: int) -> Column:
        left, right = F.col("prefixes")[cut - 1], F.col("suffixes")[k - cut - 1]
        score = F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * CAST(prefixes[{k - 1}] AS DECIMAL(20,0)) DIV (CAST(prefixes[{cut - 1}] AS DECIMAL(20,0)) + CAST(suffixes[{k - cut - 1}] AS DECIMAL(20,0)))")
        return F.struct(score.cast("long").alias("score"), F.lit(cut).alias("cut"), left.alias("l"), right.alias("r"))

    return F.array_min(F.array(*map(at, range(1, k))))


def _inside(k: int) -> Column:
    """The shorter phrases, of two words and more, inside one of ``k`` words."""
    return F.array(*(F.slice("words", start, size) for size in range(2, k) for start in range(1, k - size + 2)))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    totals, tables = frequent_phrases(df, text, lang, least, longest)
    parts = [t.select("lang", "words", F.col("prefixes")[k - 1].alias("a"), _weakest_cut(k).alias("c")) for k, t in enumerate(tables[1:], 2)]
    candidates = parts[0]
    for p in parts[1:]:
        candidates = candidates.unionByName(p)
    longer = [t.select("lang", F.explode(_inside(k)).alias("words"), F.col("prefixes")[k - 1].alias("f")) for k, t in enumerate(tables[1:], 2) if k > 2]
    if longer:
        inside = longer[0]
        for p in longer[1:]:
            inside = inside.unionByName(p)
        most = inside.groupBy("lang", "words").agg(F.max("f").alias("f"))
        covered = F.expr(f"100 * CAST(f AS DECIMAL(20,0)) >= {PERCENT} * CAST(a AS DECIMAL(20,0))")
        candidates = candidates.join(most, ["lang", "words"], "left").filter(~F.coalesce(covered, F.lit(False)))
    scored = candidates.select("lang", F.array_join("words", " ").alias("phrase"), "a", "c.l", "c.r", "c.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = scored.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SLICES)))
    first = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
  SELECT lang, unnest(ws) AS phrase, 1 AS k FROM w
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i:i + 1], ' '))), 2 FROM w
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))), 3 FROM w
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))), 4 FROM w
), f AS MATERIALIZED (
  SELECT lang, phrase, k, count(*) AS a FROM grams GROUP BY ALL
), n AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), frequent AS MATERIALIZED (
  SELECT *, string_split(phrase, ' ') AS words FROM f WHERE a >= 30
), halves AS MATERIALIZED (
  SELECT lang, phrase, a, cut, array_to_string(words[1:cut], ' ') AS head, array_to_string(words[cut + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM frequent WHERE k > 1)
), cuts AS (
  SELECT h.lang, h.phrase, h.a, cut, x.a AS l, y.a AS r, ((2000000::HUGEINT * h.a) // (x.a::HUGEINT + y.a))::BIGINT AS score
  FROM halves h JOIN frequent x ON x.lang = h.lang AND x.phrase = h.head JOIN frequent y ON y.lang = h.lang AND y.phrase = h.tail
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), parts AS (
  SELECT lang, array_to_string(words[i:i + s - 1], ' ') AS phrase, a
  FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM frequent WHERE k > 2))
), inside AS (
  SELECT lang, phrase, max(a) AS f FROM parts GROUP BY ALL
), kept AS (
  SELECT weakest.* FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE f IS NULL OR 100 * f::HUGEINT < 80 * a::HUGEINT
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
