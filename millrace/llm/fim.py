"""Fill-in-the-middle transformation by a secondary sort.

Every document is cut in two places chosen by a hash of its id, and its parts
are put in the order psm (prefix, suffix, middle) or spm (suffix, prefix,
middle), each behind its mark; some documents stay plain.

1. ``fim_plan`` chooses form and cuts by built-in functions.
2. ``output_pieces`` emits each output as pieces of at most ``CHUNK`` units
   (code points), keyed by document and output position; they are dealt by
   document and sorted by (document, position) inside each partition.
3. A first walk over the sorted pieces feeds an incremental digest of the
   output.  It reads the marks in the stream, as the form says which come in
   which order, and emits the parts' pieces again at their place in the original.
4. The pieces are sorted once more inside their partition, with no other
   shuffle, and a second walk feeds the digest of the restored text.

So one document is never held whole by the digests: a task holds one piece and
two marks' worth of text, and sorts spill.

Defined cases: a null text is empty; an empty text and one that contains a mark
stay plain; a null id is hashed as no digits.  Rows with equal id and text meet
as one document and come out as often as they came in.  An empty table gives an
empty result.  Only the id and the text are read, so other columns may have any
name.  The id may be of any type that Spark hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units of the largest piece.
CHUNK = 1 << 15
#: Rows of text taken from a batch at once, and units after which pieces are handed on.
ROWS, FLUSH = 256, 1 << 22
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of documents to transform, and of these in the order suffix first.
FIM_PERCENT, SPM_PERCENT = 90, 20
#: The marks of each form in output order, with the place of their part in the original.
LAYOUT = {"plain": (), "psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}

_HEAD = "form string, n long, cut1 long, cut2 long"
#: The columns of a piece beside the id: document key, part, position and text; row -1 of a document has its plan.
_PIECE = f"k1 long, k2 long, part int, at long, piece string, {_HEAD}"
_NAMES = [f.split()[0] for f in _PIECE.split(", ")]


def fim_plan(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, k1, k2, text, form, n, cut1, cut2): the prefix ends after ``cut1`` units, the middle after ``cut2``; null if plain."""
    own = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    own = own.withColumns({"k1": F.xxhash64("id", "text"), "k2": F.xxhash64(F.lit(1), "text", "id"), "n": F.length("text").cast("long"), "d": digest})
    h = [F.conv(F.substring("d", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = F.when((F.col("n") == 0) | marked | (h[2] % 100 >= FIM_PERCENT), "plain").when(h[3] % 100 < SPM_PERCENT, "spm").otherwise("psm")
    a, b = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    own = own.withColumns({"form": form, "a": a, "b": b})
    cut = lambda f: F.when(F.col("form") != "plain", f("a", "b"))
    return own.select("id", "k1", "k2", "text", "form", "n", cut(F.least).alias("cut1"), cut(F.greatest).alias("cut2"))


def _parts(text: str, form: str, cut1: int | None, cut2: int | None) -> Iterator[str]:
    """The pieces of the output in order."""
    spans = {0: (0, cut1), 1: (cut1, cut2), 2: (cut2, len(text))}
    for mark, place in LAYOUT[form] or (("", None),):
        start, end = spans[place] if place is not None else (0, len(text))
        for s in range(start, max(end, start + 1), CHUNK):
            piece = mark + text[s : min(end, s + CHUNK)]
            mark = ""
            if piece:
                yield piece


def _made(ids: pa.Array, rows: list[int], columns: dict[str, list]) -> pa.RecordBatch:
    types = {"part": pa.int32(), "piece": pa.string(), "form": pa.string()}
    return pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), *(pa.array(columns[c], types.get(c, pa.int64())) for c in _NAMES)], ["id", *_NAMES])


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for first in range(0, whole.num_rows, ROWS):
            batch = whole.slice(first, ROWS)
            fields = {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "id"}
            rows, out, size = [], {c: [] for c in _NAMES}, 0

            def put(r: int, at: int, piece: str | None) -> None:
                head = at < 0
                rows.append(r)
                values = (fields["k1"][r], fields["k2"][r], 0, at, piece, *(fields[c][r] if head else None for c in ("form", "n", "cut1", "cut2")))
                for c, v in zip(_NAMES, values):
                    out[c].append(v)

            for r, text in enumerate(fields["text"]):
                put(r, -1, None)
                at = 0
                for piece in _parts(text, fields["form"][r], fields["cut1"][r], fields["cut2"][r]):
                    put(r, at, piece)
                    at += len(piece)
                    size += len(piece)
                    if size >= FLUSH:
                        yield _made(batch.column("id"), rows, out)
                        rows, out, size = [], {c: [] for c in _NAMES}, 0
            yield _made(batch.column("id"), rows, out)


def output_pieces(planned: DataFrame) -> DataFrame:
    """The outputs as pieces: dealt by document, sorted by (document, output position) in each partition."""
    pieces = planned.mapInArrow(_emit, f"id {planned.schema['id'].dataType.simpleString()}, {_PIECE}")
    return pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "part", "at")


class _Stream:
    """One document's output, piece by piece: its digest, and the parts' pieces at their place in the original."""

    def __init__(self, form: str, keep: bool):
        self.digest, self.kept = hashlib.sha256(), [] if keep else None
        self.marks, self.part, self.at, self.carry = list(LAYOUT[form]), 0, 0, ""

    def _give(self, text: str) -> Iterator[tuple[int, int, str]]:
        if text:
            yield self.part, self.at, text
            self.at += len(text)

    def feed(self, piece: str) -> Iterator[tuple[int, int, str]]:
        self.digest.update(piece.encode())
        if self.kept is not None:
            self.kept.append(piece)
        rest, self.carry = self.carry + piece, ""
        while self.marks:
            found = rest.find(self.marks[0][0])
            if found < 0:
                # a mark may go on in the next piece
                rest, self.carry = rest[:-2], rest[-2:]
                break
            yield from self._give(rest[:found])
            mark, self.part = self.marks.pop(0)
            self.at, rest = 0, rest[found + len(mark) :]
        yield from self._give(rest)

    def end(self) -> Iterator[tuple[int, int, str]]:
        yield from self._give(self.carry)
        if self.marks:
            raise ValueError(f"the output lacks {self.marks[0][0]}")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Array, int, dict]]:
    """(starts a document, ids, row, values) of each sorted piece; pieces of repeated rows come once, heads always."""
    key, last = None, None
    for whole in batches:
        for first in range(0, whole.num_rows, ROWS):
            batch = whole.slice(first, ROWS)
            fields = [batch.column(c).to_pylist() for c in batch.schema.names if c != "id"]
            names = [c for c in batch.schema.names if c != "id"]
            for r, values in enumerate(zip(*fields)):
                row = dict(zip(names, values))
                new = (row["k1"], row["k2"]) != key
                place = (row["part"], row["at"])
                if new:
                    key = row["k1"], row["k2"]
                elif row["at"] >= 0 and place <= last:
                    continue
                last = place
                yield new, batch.column("id"), r, row


def _walk_output(keep: bool):
    """Digests of outputs; hands on the pieces of the original, and a head at part -1 with copies and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = head = head_id = None
        ids, out, size = [], {c: [] for c in _WALKED}, 0

        def put(id_: pa.Array, row: dict) -> None:
            ids.append(id_)
            for c in _WALKED:
                out[c].append(row.get(c))

        def close() -> None:
            nonlocal size
            for part, at, text in stream.end():
                put(head_id, {"k1": head["k1"], "k2": head["k2"], "part": part, "at": at, "piece": text})
            put(head_id, head | {"part": -1, "output_sha256": stream.digest.hexdigest(), "output": "".join(stream.kept) if keep else None})
            size += sum(map(len, stream.kept or ()))

        def flush() -> pa.RecordBatch:
            nonlocal ids, out, size
            types = {"part": pa.int32(), "piece": pa.string(), "form": pa.string(), "output_sha256": pa.string(), "output": pa.string()}
            made = pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *(pa.array(out[c], types.get(c, pa.int64())) for c in _WALKED)], ["id", *_WALKED])
            ids, out, size = [], {c: [] for c in _WALKED}, 0
            return made

        for new, column, r, row in _documents(batches):
            if new:
                if stream:
                    close()
                    if size >= FLUSH or len(ids) > 8192:
                        yield flush()
                if row["at"] >= 0:
                    raise ValueError("a document's plan has to come before its pieces")
                head, head_id, stream = row | {"copies": 1}, column.slice(r, 1), _Stream(row["form"], keep)
            elif row["at"] < 0:
                head["copies"] += 1
            else:
                for part, at, text in stream.feed(row["piece"]):
                    put(head_id, {"k1": row["k1"], "k2": row["k2"], "part": part, "at": at, "piece": text})
                    size += len(text)
                if size >= FLUSH:
                    yield flush()
        if stream:
            close()
        if ids:
            yield flush()

    return run


_WALKED = [*_NAMES, "copies", "output_sha256", "output"]
_DONE = ["form", "n", "cut1", "cut2", "output_sha256", "output", "restored_sha256", "restored"]


def _walk_restored(keep: bool):
    """A row for each document: its plan, digests and, if kept, output and restored text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = head_id = digest = kept = None
        ids, out, size = [], {c: [] for c in _DONE}, 0

        def close() -> None:
            nonlocal size
            row = head | {"restored_sha256": digest.hexdigest(), "restored": "".join(kept) if keep else None}
            for _ in range(head["copies"]):
                ids.append(head_id)
                for c in _DONE:
                    out[c].append(row[c])
                size += 2 * sum(map(len, kept))

        def flush() -> pa.RecordBatch:
            nonlocal ids, out, size
            made = pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *(pa.array(out[c], pa.int64() if c in ("n", "cut1", "cut2") else pa.string()) for c in _DONE)], ["id", *_DONE])
            ids, out, size = [], {c: [] for c in _DONE}, 0
            return made

        for new, column, r, row in _documents(batches):
            if new:
                if head:
                    close()
                    if len(ids) >= 4096 or size >= FLUSH:
                        yield flush()
                if row["part"] >= 0:
                    raise ValueError("a document's plan has to come before its pieces")
                head, head_id, digest, kept = row, column.slice(r, 1), hashlib.sha256(), []
            else:
                digest.update(row["piece"].encode())
                if keep:
                    kept.append(row["piece"])
        if head:
            close()
        if ids:
            yield flush()

    return run


def _done(planned: DataFrame, keep: bool) -> DataFrame:
    id_type = planned.schema["id"].dataType.simpleString()
    walked = output_pieces(planned).mapInArrow(_walk_output(keep), f"id {id_type}, {_PIECE}, copies long, output_sha256 string, output string")
    again = walked.sortWithinPartitions("k1", "k2", "part", "at")
    return again.mapInArrow(_walk_restored(keep), f"id {id_type}, {_HEAD}, output_sha256 string, output string, restored_sha256 string, restored string")


def fim_texts(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output, restored): the transformed texts, and the texts rebuilt from them."""
    done = _done(fim_plan(df, text, id_column), True)
    return done.select(F.col("id").alias(id_column), "n", "form", F.col("cut1").alias("prefix_chars"), (F.col("cut2") - F.col("cut1")).alias("middle_chars"), "output", "restored")


def fim_report(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256), without any document held whole."""
    done = _done(fim_plan(df, text, id_column), False)
    return done.select(F.col("id").alias(id_column), "n", "form", F.col("cut1").alias("prefix_chars"), (F.col("cut2") - F.col("cut1")).alias("middle_chars"), "output_sha256", "restored_sha256")


REPORT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), x AS (
  SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM x
), p AS (SELECT *, t[1:a] AS pre, t[a + 1:b] AS mid, t[b + 1:n] AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
