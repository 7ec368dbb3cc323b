"""Scanning texts for the terms of a large dictionary, by an Aho-Corasick automaton.

The dictionary is a table.  It is cut in parts of at most about ``PART_CHARS``
characters; each part is sent to the workers, which build its automaton once: goto,
failure and output links in numpy arrays, level by level.  Texts are cut in windows
that overlap by the longest term, and many windows are walked at once, a character of
each at a time, so the time grows with the text, not with the terms.  A dictionary of
many parts is as many walks over the texts.

All occurrences are found, also those inside others; a term is matched as it is,
letter by letter (code points).  Null texts and null or blank terms match nothing;
repeated terms count once.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import written

PART_CHARS = 1 << 22
#: Characters of a window, and windows that are walked together.
WINDOW, TOGETHER = 1024, 2048
_CHARS = 0x110001
_END = _CHARS - 1


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class Automaton:
    """Goto, failure and output links of a set of terms; state 0 is the root."""

    def __init__(self, terms: Sequence[str]):
        self.terms = sorted(set(terms))
        lengths = np.array([len(t) for t in self.terms], np.int64)
        self.longest = int(lengths.max(initial=0))
        letters = np.concatenate([_points(t) for t in self.terms]) if self.terms else np.zeros(0, np.int64)
        first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        state, total = np.zeros(len(self.terms), np.int64), 1
        levels, ends = [], []
        for depth in range(self.longest):
            active = np.flatnonzero(lengths > depth)
            keys, place = np.unique(state[active] * _CHARS + letters[first[active] + depth], return_inverse=True)
            state[active] = total + place
            levels.append(keys)
            ends.append(active[lengths[active] == depth + 1])
            total += len(keys)
        self.keys = np.concatenate(levels) if levels else np.zeros(0, np.int64)
        # a level's states are numbered in the order of its keys, and its parents lie in the level before
        self.term = np.full(total, -1, np.int64)
        for done in ends:
            self.term[state[done]] = done
        self.fail, self.output = np.zeros(total, np.int64), np.zeros(total, np.int64)
        known = 0
        for keys in levels:
            states = 1 + known + np.arange(len(keys))
            if known:
                self.fail[states] = self._step(self.fail[keys // _CHARS], keys % _CHARS)
            known += len(keys)
            suffix = self.fail[states]
            self.output[states] = np.where(self.term[suffix] >= 0, suffix, self.output[suffix])

    def _goto(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is none."""
        keys = states * _CHARS + letters
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at + 1, 0)

    def _step(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        out = self._goto(states, letters)
        open_ = np.flatnonzero((out == 0) & (states != 0))
        states = states.copy()
        while len(open_):
            states[open_] = self.fail[states[open_]]
            out[open_] = self._goto(states[open_], letters[open_])
            open_ = open_[(out[open_] == 0) & (states[open_] != 0)]
        return out

    def scan(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, term) numbers of all occurrences."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if not self.terms:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        lead, size = self.longest - 1, max(WINDOW, 2 * self.longest)
        rows: list[tuple[int, int, np.ndarray, int]] = []
        for i, text in enumerate(texts):
            if text:
                points = _points(text)
                for start in range(0, len(points), size):
                    lead_in = max(0, start - lead)
                    rows.append((i, lead_in, points[lead_in : start + size], start - lead_in))
                    if len(rows) == TOGETHER:
                        found.append(self._walk(rows))
                        rows = []
        if rows:
            found.append(self._walk(rows))
        return tuple(np.concatenate(c) for c in zip(*found)) if found else tuple(np.zeros(0, np.int64) for _ in range(3))

    def _walk(self, rows: list[tuple[int, int, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # longest first, so those that have ended are at the end
        rows = sorted(rows, key=lambda r: -len(r[2]))
        widths = np.array([len(r[2]) for r in rows])
        grid = np.full((int(widths[0]), len(rows)), _END, np.int64)
        for n, (_, _, points, _) in enumerate(rows):
            grid[: len(points), n] = points
        text, begin = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        # an occurrence counts in the window in which it ends; what comes before is there for terms that began earlier
        owned = np.array([r[3] for r in rows])
        states, out = np.zeros(len(rows), np.int64), []
        for j in range(len(grid)):
            live = int(np.searchsorted(-widths, -j))
            states = self._step(states[:live], grid[j, :live])
            hit = np.flatnonzero(((self.term[states] >= 0) | (self.output[states] > 0)) & (owned[:live] <= j))
            at = states[hit]
            at = np.where(self.term[at] >= 0, at, self.output[at])
            while len(hit):
                out.append((hit, np.full(len(hit), j), self.term[at]))
                at = self.output[at]
                hit, at = hit[at > 0], at[at > 0]
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        row, j, term = (np.concatenate(c) for c in zip(*out))
        lengths = np.array([len(t) for t in self.terms])
        return text[row], begin[row] + j - lengths[term] + 1, term


@functools.lru_cache(2)
def _built(terms: tuple[str, ...]) -> Automaton:
    return Automaton(terms)


def scan_dictionary(df: DataFrame, text: str, key: Sequence[str], dictionary: DataFrame, term: str, part_chars: int = PART_CHARS) -> DataFrame:
    """(key, term, place): every occurrence of every term; places count from 0."""
    spark = df.sparkSession
    terms = dictionary.select(F.col(term).cast("string").alias("term")).filter(F.trim("term") != "").distinct()
    terms = written(terms, "dictionary")
    size = terms.agg(F.sum(F.length("term"))).first()[0] or 0
    parts = max(1, -(-size // part_chars))
    schema = ", ".join(f"`{k}` {dict(df.dtypes)[k]}" for k in key) + ", term string, place long"
    own = df.select(*key, F.col(text).cast("string").alias("__text"))
    scans = []
    for part in range(parts):
        # about part_chars characters reach the driver at once
        some = tuple(r[0] for r in terms.filter(F.pmod(F.xxhash64("term"), F.lit(parts)) == part).collect())
        shared = spark.sparkContext.broadcast(some)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = _built(shared.value)
            names = pa.array(automaton.terms, pa.string())
            for whole in batches:
                for start in range(0, whole.num_rows, TOGETHER):
                    batch = whole.slice(start, TOGETHER)
                    i, place, found = automaton.scan(batch.column(len(key)).to_pylist())
                    for a in range(0, len(i), 1 << 16):
                        rows = pa.array(i[a : a + (1 << 16)], pa.int64())
                        columns = [batch.column(k).take(rows) for k in range(len(key))]
                        yield pa.RecordBatch.from_arrays([*columns, names.take(pa.array(found[a : a + (1 << 16)], pa.int64())), pa.array(place[a : a + (1 << 16)], pa.int64())], [*key, "term", "place"])

        scans.append(own.mapInArrow(run, schema))
    return functools.reduce(DataFrame.union, scans)
