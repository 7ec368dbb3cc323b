"""BPE encoding and decoding with forced-boundary splitting.

A pair of neighbouring symbols that occurs inside no vocabulary token can never
be merged over, so it marks a certain cut.  A pre-token is cut at all such
pairs, the fragments are encoded independently and the ids concatenated.  Only
the normalizer and the pre-tokenizer are the library's own, and those only for
chunks beyond Latin letters.  The result equals the tokenizers library's for a BPE file whose normalizer is NFC,
white space runs to one space, lower case, and whose decoder is unset (tokens
joined by one space).

Rows map one to one with no shuffle.  Every Python worker reads the vocabulary
once and keeps caches of chunks and words, bounded in entries and in the length
of what they keep; no text is cut short.  A fragment of n symbols takes
n log n steps, so a text of one endless word costs about as much as any other.

Defined cases: a null text is empty; an empty text has no ids and decodes to
the empty string; special tokens written in a text become their ids.  Repeated
rows and null ids of any type give a row each; other columns, of any name, are
not used.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

CACHE_CHUNKS = 300_000
CACHE_WORDS = 200_000
#: Longer chunks and words are not kept.
CACHED_LETTERS = 64
#: Fragments up to here are merged by scanning, longer ones by a heap.
SHORT_FRAGMENT = 48
ROUND_TRIP_ROWS = 500
#: Up to here all Unicode versions agree on classes and case; beyond it the library is asked.
LAST_LATIN = "\u024f"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Cache(dict):
    """A dict that makes missing values, keeps those of short keys and forgets all when full."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(key) > CACHED_LETTERS:
            return self.make(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value = self.make(key)
        return value


class ForcedBoundaryBPE:
    """Encoder for one tokenizers BPE file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.ranks = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        library = Tokenizer.from_file(path)  # its Unicode tables decide what a letter, a digit and lower case is
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.inside = {pair for token in self.vocab for s in [self.symbols(token)] for pair in zip(s, s[1:])}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.simple = regex.compile(pattern)
        self.letters = {b: letter for b, letter in enumerate(byte_letters())}
        self.words = _Cache(self.encode_word, CACHE_WORDS)
        self.chunks = _Cache(self.encode_chunk, CACHE_CHUNKS)
        del spec, model

    def symbols(self, token: str) -> list[str]:
        """The base symbols of a token; the word end belongs to the last letter."""
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merge(self, parts: list[str]) -> list[int]:
        """Ids of one fragment: the pair of lowest rank is joined first, leftmost among equals."""
        if len(parts) > SHORT_FRAGMENT:
            return self.merge_long(parts)
        rank, none = self.ranks.get, len(self.ranks)
        scores = [rank(p, none) for p in zip(parts, parts[1:])]
        while scores and (best := min(scores)) < none:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(scores):
                scores[i] = rank((parts[i], parts[i + 1]), none)
        return [self.vocab[p] for p in parts]

    def merge_long(self, parts: list[str]) -> list[int]:
        """The same in n log n steps: pairs wait in a heap by rank and place, symbols are linked to their neighbours."""
        rank, n = self.ranks.get, len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting = [(r, i, p) for i, p in enumerate(zip(parts, parts[1:])) if (r := rank(p)) is not None]
        heapq.heapify(waiting)
        while waiting:
            _, i, pair = heapq.heappop(waiting)
            j = after[i] if parts[i] else n
            if j >= n or (parts[i], parts[j]) != pair:
                continue  # one of the two has been joined to another since
            parts[i], parts[j] = parts[i] + parts[j], ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(waiting, (r, i, (parts[i], parts[k])))
            h = before[i]
            if h >= 0 and (r := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(waiting, (r, h, (parts[h], parts[i])))
        return [self.vocab[p] for p in parts if p]

    def encode_word(self, letters: str) -> bytes:
        """Ids of one pre-token in byte letters: cut it at pairs that no token has inside, encode the fragments, concatenate."""
        symbols = list(letters)
        symbols[-1] += self.end
        if self.inside.issuperset(zip(symbols, symbols[1:])):
            ids = self.merge(symbols)
            return struct.pack(f"<{len(ids)}I", *ids)
        inside, start, ids = self.inside, 0, []
        for i, pair in enumerate(zip(symbols, symbols[1:]), 1):
            if pair not in inside:
                ids += self.merge(symbols[start:i])
                start = i
        ids += self.merge(symbols[start:])
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a run between white space, as little-endian 32-bit integers."""
        words = self.words
        if chunk.isascii() and chunk.isprintable():
            return b"".join([words[w] for w in self.simple.findall(chunk.lower())])
        if max(chunk) <= LAST_LATIN:
            chunk = unicodedata.normalize("NFC", chunk).lower()
            return b"".join([words[w.encode("utf-8").decode("latin-1").translate(self.letters)] for w in self.simple.findall(chunk)])
        parts = self.normalizer.normalize_str(chunk).split(" ")
        return b"".join([words[w] for part in parts for w, _ in self.pre_tokenizer.pre_tokenize_str(part)])

    def encode_bytes(self, text: str) -> bytes:
        pieces = self.special_split.split(text) if self.special_split else [text]
        out, chunks = [], self.chunks
        for piece in pieces:
            if piece in self.special:
                out.append(np.array([self.special[piece]], "<u4").tobytes())
            else:
                # lower case early lets more ASCII chunks share a cache entry
                piece = piece.lower() if piece.isascii() else piece
                out += [chunks[w] for w in (_SPACES.split(piece) if _ODD.search(piece) else piece.split())]
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()


def decode(tokens: list[str], ids: list[int]) -> str:
    return " ".join([tokens[i] for i in ids])


#: split() also breaks at these, which the file's pattern takes for text.
_ODD = re.compile("[\x1c-\x1f]")
_SPACES = re.compile(r"[ \t-\r]+")


@lru_cache(maxsize=2)
def coder(path: str) -> ForcedBoundaryBPE:
    """One coder per Python worker."""
    return ForcedBoundaryBPE(path)


@lru_cache(maxsize=2)
def token_table(path: str) -> list[str]:
    """Tokens by id, which is all that decoding needs."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [tokens.get(i, "") for i in range(max(tokens) + 1)]


def bpe_encode(df: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, ids): token ids as little-endian 32-bit integers in one binary column."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            ids = [own.encode_bytes(v.as_py() or "") for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    source = df.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(encode, f"id {kind}, ids binary").withColumnRenamed("id", id_column)


def bpe_decode(df: DataFrame, path: str, ids: str = "ids", id_column: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the text of a column of packed ids; null ids decode to the empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_table(path)
        for batch in batches:
            texts = [decode(tokens, np.frombuffer(v.as_py() or b"", "<u4").tolist()) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    source = df.select(F.col(id_column).alias("id"), F.col(ids).alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids binary, decoded string").withColumnRenamed("id", id_column)


def bpe_round_trip(df: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): encode each text, then decode its packed ids, in one pass of one worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tokens = coder(path), token_table(path)
        for batch in batches:
            for start in range(0, batch.num_rows, ROUND_TRIP_ROWS):
                part = batch.slice(start, ROUND_TRIP_ROWS)
                ids = [own.encode_bytes(v.as_py() or "") for v in part.column(1)]
                texts = [decode(tokens, np.frombuffer(i, "<u4").tolist()) for i in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    source = df.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids binary, decoded string").withColumnRenamed("id", id_column)


def bpe_digests(df: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Encode, decode, and reduce both to digests; one row per document."""
    coded = bpe_round_trip(df, path, text, id_column)
    return coded.select(
        id_column, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
