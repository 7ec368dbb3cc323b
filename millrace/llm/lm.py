"""Language-model scoring with a weighted backoff automaton.

N-grams of the training texts become states: one for each context that was
seen, plus the root for no context.  An arc leads from a context over a word
to the longest known context of what follows; a failure arc leads to the next
shorter context.  Weights are log10 probabilities of an interpolated model::

    P(w | h) = a * c(hw) / c(h) + (1 - a) * P(w | h')      for c(h) > 0
    P(w)     = (c(w) - D) / N,   P(any unknown word) = D * V / N

where h' drops the first word of h, a = ``MIX[order]``, and D is the
Good-Turing discount n1 / (n1 + 2 n2 + 1).  So all unknown words are one class;
with ``spread_unseen`` each is one of V + 1 unknown words, of probability
D * V / (N * (V + 1)), and junk scores low.  Contexts of two and more words
become states from ``min_context`` sightings on.  A failure arc costs
log10(1 - a).  One pass from left to right over a text carries the state, takes
arcs and failure arcs, and adds up weights.

Counts cover all training texts and never meet in one place:

1. Neighbouring texts are packed in blocks of word numbers, written once.
2. A block sends its distinct n-grams (64-bit hashes, sorted, cut into ranges)
   with their training counts, packed in arrays, to the range that owns them.
3. A range adds the counts of all blocks up and returns to each block the
   totals of that block's n-grams, in the order in which they were sent.
4. Steps 2 and 3 are done for words and pairs, then for each longer n-gram
   whose context has become a state.
5. A block takes its totals, builds the automaton of its own n-grams (no other
   can be met in its texts), and walks every text.

Every range and every block holds a bounded share of the data; their number
follows the input's bytes.  From more than ``FAN`` blocks on, groups of at most
about ``FAN`` blocks add up between themselves first, so a range hears from
groups, not blocks: messages stay long, and an n-gram that all texts have
reaches its range once for each group.  Two n-grams whose hashes agree count
as one (about one pair in 1e19).

Defined cases: a null text is empty, an empty text has only the end token; with
no training text every count is 0, the unknown word has probability 1 and
``base_score`` is 0.  Rows are scored one by one: repeated rows and repeated or
null ids give a row each; ids keep their type.  A text longer than a block is a
block of its own.  An empty table gives an empty result; other columns, of any
name, are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

ORDER = 2
#: Weight of the seen n-gram against the shorter context, by order.
MIX = {2: 0.5, 3: 0.5, 4: 0.5}
#: Bytes of text in a block, and of text for each range of n-grams.
BLOCK_BYTES = 6 << 20
RANGE_BYTES = 12 << 20
#: Blocks from which a range hears directly.
FAN = 16_384
#: Ranges up to which each is a partition of its own; more are dealt by Spark's hash.
OWN_PARTITIONS = 20_000
#: Tokens for which arcs are held at once.
WALK_TOKENS = 8_000
#: Keys of the end of a text and of its start; words hash to other values in all likelihood.
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_MULTIPLIER = np.uint64(0x2545F4914F6CDD1D)


def tokens(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text in ASCII lower case; bytes split at space and tab to carriage return only."""
    return (text or b"").lower().split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _pack(x: np.ndarray) -> bytes:
    """The least width of 1, 2, 4 or 8 bytes that holds all numbers, then their bytes by place, which Spark's codec squeezes better."""
    top = int(x.max()) if len(x) else 0
    width = next(w for w in (1, 2, 4, 8) if top >> (8 * w) == 0)
    return bytes([width]) + np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    width = raw[0]
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, offset=1).reshape(width, -1).T).view(f"<u{width}").ravel()


def _expanded(raw: bytes) -> bytes:
    with pa.input_stream(pa.py_buffer(raw), compression="zstd") as stream:
        return stream.read()


class Block:
    """The tokens of some texts as one sequence of ids, and their n-grams."""

    def __init__(self, texts: list[bytes | None]):
        place = _Numbers({b"": 0})  # no word is empty; it stands for the end
        ids, ends = [], []
        for t in texts:
            ids += map(place.__getitem__, tokens(t))
            ids.append(0)
            ends.append(len(ids))
        self._set(np.array(ids, np.int64), np.array(ends, np.int64), np.array([END, *map(xxhash.xxh64_intdigest, list(place)[1:])], np.uint64))

    def _set(self, ids: np.ndarray, ends: np.ndarray, word_hash: np.ndarray) -> None:
        self.ids, self.ends, self.word_hash = ids, ends, word_hash
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        #: Each token's place in its text.
        self.at = np.arange(len(ids)) - np.repeat(self.starts, ends - self.starts)

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return pa.compress(_pack(self.ids), "zstd", asbytes=True), _pack(self.ends), _pack(self.word_hash)

    @classmethod
    def unpacked(cls, ids: bytes, ends: bytes, words: bytes) -> Block:
        block, stops = cls.__new__(cls), _unpack(ends).astype(np.int64)
        block._set(_unpack(_expanded(ids)).astype(np.int64), stops, _unpack(words))
        return block

    def grams(self, order: int) -> list[np.ndarray]:
        """For n = 1..order, the hash of the n-gram that ends at each token.

        Contexts that reach before the start of a text hold the start mark once
        and have no longer form: their hash is 0.
        """
        own = self.word_hash[self.ids]
        out = [own]
        for n in range(2, order + 1):
            before = np.zeros_like(own)
            before[1:] = out[-1][:-1]
            with np.errstate(over="ignore"):
                before = np.where(self.at == 0, START if n == 2 else np.uint64(0), before)
                chained = _mix(before * _MULTIPLIER + own)
            # the n-gram before must not cross the start of the text
            chained[(self.at < n - 2) | (before == 0)] = 0
            out.append(chained)
        return out

    def in_training(self, training: np.ndarray) -> np.ndarray:
        """1 for each token of a training text, else 0."""
        return np.repeat(training, self.ends - self.starts)


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places that hold an n-gram, the sorted distinct hashes, the first place of each, and the hash's number at each such place."""
    at = np.flatnonzero(h)
    keys, where = np.unique(h[at], return_inverse=True)
    first = np.empty(len(keys), np.int64)
    first[where[::-1]] = at[::-1]
    return at, keys, first, where


def _counts(block: Block, training: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, sorted distinct hashes and their number in training texts."""
    use = block.in_training(training)
    of_word = np.bincount(block.ids, weights=use, minlength=len(block.word_hash)).astype(np.int64)
    by_hash = np.argsort(block.word_hash)
    out = [(block.word_hash[by_hash], of_word[by_hash])]
    for h in block.grams(order)[1:]:
        out.append(_counted(h, use))
    return out


def _counted(h: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, keys, _, where = _distinct(h)
    return keys, np.bincount(where, weights=use[at], minlength=len(keys)).astype(np.int64)


# --- counting over all blocks ----------------------------------------------

BLOCKS = "block long, bytes long, row array<{kind}>, training binary, ids binary, ends binary, words binary"
SENT = "order int, range int, block long, keys binary, counts binary"
TOTALS = "block long, order int, range int, totals binary, stats array<long>"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns)})


def pack_blocks(own: DataFrame) -> DataFrame:
    """(row, text, training) rows as packed blocks of neighbouring rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, texts, training, held, made, pid = [], [], [], 0, 0, 0

        def block() -> pa.RecordBatch:
            values = pa.concat_arrays(rows)
            ids, ends, words = Block(texts).packed()
            one = [[(pid << 32) + made], [held], pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), [_pack(np.array(training, np.int64))], [ids], [ends], [words]]
            kinds = [pa.int64(), pa.int64(), None, *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([c if k is None else pa.array(c, k) for c, k in zip(one, kinds)], ["block", "bytes", "row", "training", "ids", "ends", "words"])

        for batch in batches:
            start = 0
            if batch.num_rows:
                pid = batch.column(3)[0].as_py()
            for i, text in enumerate(batch.column(1)):
                texts.append(text.as_py())
                held += len(texts[-1]) + 64
                if held >= BLOCK:
                    rows.append(batch.column(0).slice(start, i + 1 - start))
                    training += batch.column(2).slice(start, i + 1 - start).to_pylist()
                    start = i + 1
                    yield block()
                    rows, texts, training, held, made = [], [], [], 0, made + 1
            rows.append(batch.column(0).slice(start))
            training += batch.column(2).slice(start).to_pylist()
        if texts:
            yield block()

    BLOCK = BLOCK_BYTES
    return own.withColumn("pid", F.spark_partition_id()).mapInArrow(run, BLOCKS.format(kind=own.schema["row"].dataType.simpleString()))


def _restored(row: dict) -> tuple[Block, np.ndarray]:
    """A block, and for each of its texts 1 if it is a training text."""
    return Block.unpacked(row["ids"], row["ends"], row["words"]), _unpack(row["training"]).astype(float)


def _send(keys: np.ndarray, counts: np.ndarray, ranges: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(range, packed gaps of keys, packed counts) for each range that has keys."""
    owner = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1, [len(keys)]]) if len(keys) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(owner[a]), _pack(np.diff(keys[a:b], prepend=np.uint64(0))), _pack(counts[a:b])


def first_counts(blocks: DataFrame, order: int, ranges: int) -> DataFrame:
    """The messages of each block about its words and, from order 2 on, its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block, training = _restored(row)
                rows = [(n, r, row["block"], k, c) for n, (keys, counts) in enumerate(_counts(block, training, min(order, 2)), 1) for r, k, c in _send(keys, counts, ranges)]
                yield from _table(rows, SENT).to_batches()

    return blocks.select("block", "training", "ids", "ends", "words").mapInArrow(run, SENT)


def _totals_of(own: pa.Table) -> dict[int, np.ndarray]:
    """By order, the totals that came back to a block, from all ranges in turn."""
    parts: dict[int, list[tuple[int, bytes]]] = {}
    for n, r, t in zip(own.column("order").to_pylist(), own.column("range").to_pylist(), own.column("totals").to_pylist()):
        parts.setdefault(n, []).append((r, t))
    return {n: np.concatenate([_unpack(t).astype(np.int64) for _, t in sorted(p)]) for n, p in parts.items()}


def next_counts(blocks: DataFrame, totals: DataFrame, n: int, ranges: int, n_training: int, order: int, min_context: int) -> DataFrame:
    """The messages of each block about its n-grams of order ``n``, whose context is a state."""

    def run(group: pa.Table, own: pa.Table) -> pa.Table:
        rows = []
        for row in group.to_pylist():
            block, training = _restored(row)
            by_order = _totals_of(own)
            states = States(block, n_training, order, min_context)
            for k in range(1, n):
                states.add(by_order.get(k, np.zeros(0, np.int64)))
            keys, counts = _counted(states.hashes(n), block.in_training(training))
            rows += [(n, r, row["block"], k, c) for r, k, c in _send(keys, counts, ranges)]
        return _table(rows, SENT)

    own = blocks.select("block", "training", "ids", "ends", "words")
    return own.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(run, SENT)


def _merged(group: pa.Table) -> Iterator[tuple[int, list[int], list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """For each order in a group of messages: (order, senders, numbers of keys, distinct keys, each key's place in these, summed counts)."""
    orders = np.array(group.column("order").to_pylist(), np.int64)
    senders, keys, counts = (group.column(c) for c in ("block", "keys", "counts"))
    for n in np.unique(orders).tolist():
        of_order = np.flatnonzero(orders == n).tolist()
        own = [np.cumsum(_unpack(keys[i].as_py()), dtype=np.uint64) for i in of_order]
        every, where = np.unique(np.concatenate(own), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, where, np.concatenate([_unpack(counts[i].as_py()).astype(np.int64) for i in of_order]))
        yield n, [senders[i].as_py() for i in of_order], [len(k) for k in own], every, where, total


def _returned(senders: list[int], sizes: list[int], n: int, part: int, of_key: np.ndarray) -> list[tuple]:
    """A row of totals for each message, ``of_key`` holding those of all messages in turn."""
    ends = np.cumsum(sizes).tolist()
    return [(b, n, part, _pack(of_key[end - size : end]), None) for b, size, end in zip(senders, sizes, ends)]


def _by_range(messages: DataFrame, ranges: int) -> DataFrame:
    return messages.repartitionById(ranges, "range") if ranges <= OWN_PARTITIONS else messages


def add_up(messages: DataFrame, ranges: int) -> DataFrame:
    """Totals for each sender in the order of its keys, and a row of statistics (block -1) for each range and order.

    Statistics: the sum of counts, keys in training texts, keys seen once, keys seen twice.
    """

    def run(key: tuple, group: pa.Table) -> pa.Table:
        part, rows = key[0].as_py(), []
        for n, senders, sizes, _, where, total in _merged(group):
            rows += _returned(senders, sizes, n, part, total[where])
            rows.append((-1, n, part, b"", [int(total.sum()), int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum())]))
        return _table(rows, TOTALS)

    return _by_range(messages, ranges).groupBy("range").applyInArrow(run, TOTALS)


def exchange(send, n_blocks: int, bytes_: int, label: str) -> DataFrame:
    """Totals of the messages that ``send(ranges)`` makes, written; over ``FAN`` blocks by way of groups of blocks."""
    ranges, groups = max(1, -(-bytes_ // RANGE_BYTES)), -(-n_blocks // FAN)
    if groups <= 1:
        return written(add_up(send(ranges), ranges), label)
    slices = max(1, ranges // groups)
    ranges = slices * -(-ranges // slices)  # each range lies in one slice
    group = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
    messages = written(send(slices), f"{label}-messages").withColumn("group", group)

    def merge(key: tuple, part: pa.Table) -> pa.Table:
        own = (key[0].as_py() << 32) + key[1].as_py()
        return _table([(n, r, own, k, c) for n, _, _, every, _, total in _merged(part) for r, k, c in _send(every, total, ranges)], SENT)

    merged = messages.groupBy("group", "range").applyInArrow(merge, SENT)
    totals = written(add_up(merged, ranges), f"{label}-groups")
    of_group = totals.filter("block >= 0").select(F.shiftright("block", 32).cast("int").alias("group"), F.col("block").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("slice"), "order", "range", "totals")

    def spread(key: tuple, part: pa.Table, own: pa.Table) -> pa.Table:
        by_order = _totals_of(own)
        return _table([row for n, senders, sizes, _, where, _ in _merged(part) for row in _returned(senders, sizes, n, key[1].as_py(), by_order[n][where])], TOTALS)

    back = messages.groupBy("group", "range").cogroup(of_group.groupBy("group", "slice")).applyInArrow(spread, TOTALS)
    return written(back.unionByName(totals.filter("block < 0")), label)


# --- the automaton ---------------------------------------------------------


class States:
    """The states of a block's automaton, as the totals of one order after another come in.

    State 0 is the root, 1 the start of a text (if the order and the training texts allow it).
    """

    def __init__(self, block: Block, n_training: int, order: int, min_context: int = 1):
        self.block, self.order, self.min_context = block, order, min_context
        self.grams = block.grams(order)
        self.n_training, self.start = n_training, 1 if order > 1 and n_training else 0
        self.number = 1 + self.start
        #: By length, the state of the context that ends at each token, 0 for none.
        self.ending = [np.zeros(len(block.ids), np.int64)]
        self.fail, self.length = [np.zeros(1 + self.start, np.int64)], [np.minimum(np.arange(1 + self.start), 1)]
        self.of_word = np.zeros(len(block.word_hash), np.int64)
        #: By order, each token's n-gram's count, and a first place of each n-gram.
        self.count: list[np.ndarray] = []
        self.first: list[np.ndarray] = []

    def context(self, n: int) -> np.ndarray:
        """The state of the n - 1 words before each token; the start mark stands for all that is before a text."""
        out = np.zeros(len(self.block.ids), np.int64)
        out[1:] = self.ending[n - 1][:-1]
        out[self.block.at < max(1, n - 2)] = 0
        if n == 2:
            out[self.block.at == 0] = self.start
        return out

    def hashes(self, n: int) -> np.ndarray:
        """The n-gram that ends at each token; from order 3 on 0 where its context is no state."""
        return self.grams[n - 1] if n < 3 else np.where(self.context(n) > 0, self.grams[n - 1], np.uint64(0))

    def add(self, total: np.ndarray) -> None:
        """Take the totals of the next order, in the order of its sorted distinct hashes."""
        block, n = self.block, len(self.count) + 1
        if n == 1:
            self.of_word[np.argsort(block.word_hash)] = total
            at, where, first = np.arange(len(block.ids)), block.ids, None
            total, known = self.of_word, self.of_word > 0
            known[0] = False  # nothing follows the end
            ends = np.zeros(len(known), np.int64)
            ends[block.ids] = at
        else:
            at, _, first, where = _distinct(self.hashes(n))
            known, ends = (total >= self.min_context) & (total > 0) & (block.ids[first] != 0), first
        count = np.zeros(len(block.ids), np.int64)
        count[at] = total[where]
        self.count.append(count)
        self.first.append(first)
        if n < self.order:
            number = np.where(known, self.number + np.cumsum(known) - 1, 0)
            ending = np.zeros(len(block.ids), np.int64)
            ending[at] = number[where]
            self.fail.append(self.ending[n - 1][ends[known]])
            self.length.append(np.full(int(known.sum()), n))
            self.number += int(known.sum())
            self.ending.append(ending)


class Automaton:
    """States are contexts by number, 0 the root, which has an arc for every word.

    The arc over each token, from each context that ends before it, is kept by
    the token's place: ``code`` (state << 32 | word, -1 for no arc), weight and
    target.  ``load`` makes a table of the arcs that some tokens can ask for.
    """

    def __init__(self, code: list[np.ndarray], weight: list[np.ndarray], target: list[np.ndarray], fail_state: np.ndarray, fail_weight: np.ndarray, root: np.ndarray, root_target: np.ndarray):
        self.code, self.weight, self.target = code, weight, target
        self.root, self._root, self._root_target = root, root.tolist(), root_target.tolist()
        self._fail_state, self._fail_weight = fail_state.tolist(), fail_weight.tolist()

    def load(self, a: int, b: int) -> dict[int, tuple[float, int]]:
        """Arcs over the tokens from a to b."""
        arcs: dict[int, tuple[float, int]] = {}
        for code, weight, target in zip(self.code, self.weight, self.target):
            at = np.flatnonzero(code[a:b] >= 0) + a
            arcs.update(zip(code[at].tolist(), zip(weight[at].tolist(), target[at].tolist())))
        return arcs

    def walk(self, words: list[int], state: int, arcs: dict[int, tuple[float, int]]) -> float:
        """The summed weight of a sequence from ``state`` on, step by step."""
        total, find = 0.0, arcs.get
        fail_state, fail_weight, root, root_target = self._fail_state, self._fail_weight, self._root, self._root_target
        for w in words:
            while state:
                arc = find(state << 32 | w)
                if arc:
                    total += arc[0]
                    state = arc[1]
                    break
                total += fail_weight[state]
                state = fail_state[state]
            else:
                total += root[w]
                state = root_target[w]
        return total


def build(block: Block, totals: list[np.ndarray], stats: list[int], n_training: int, order: int, mix: dict[int, float] = MIX, spread_unseen: bool = False, min_context: int = 1) -> tuple[Automaton, int, np.ndarray]:
    """The automaton of a block's n-grams, its start state, and each token's training count.

    ``totals[n-1]`` belongs to the sorted distinct n-gram hashes of the block
    (from order 3 on, to those whose context is a state).
    """
    n_tokens, n_known, once, twice = stats
    discount = once / (once + 2 * twice + 1) if once else 0.5
    states, ids = States(block, n_training, order, min_context), block.ids
    for total in totals:
        states.add(total)
    unseen = discount * n_known / n_tokens / (n_known + 1 if spread_unseen else 1) if n_tokens else 1.0
    p_word = np.where(states.of_word > 0, (states.of_word - discount) / max(n_tokens, 1), unseen)
    p = p_word[ids]
    longest = np.zeros(len(ids), np.int64)
    for s in states.ending[1:]:
        longest = np.where(s > 0, s, longest)
    root_target = np.zeros(len(block.word_hash), np.int64)
    if order > 1:
        root_target[ids] = states.ending[1]

    codes, weights, targets = [], [], []
    for n in range(2, order + 1):
        context, count, c_context = states.context(n), states.count[n - 1], np.ones(len(ids), np.int64)
        c_context[1:] = states.count[n - 2][:-1]
        if n == 2:
            c_context[block.at == 0] = n_training
        p = np.where(context > 0, mix[n] * count / np.maximum(c_context, 1) + (1 - mix[n]) * p, p)
        codes.append(np.where((context > 0) & (count > 0), context << 32 | ids, -1))
        weights.append(np.log10(p))
        targets.append(longest if n == order else np.where(states.ending[n] > 0, states.ending[n], longest))
    length = np.concatenate(states.length)
    fail_weight = np.array([0.0, *(math.log10(1 - mix[n]) for n in range(2, order + 1))])[length]
    machine = Automaton(codes, weights, targets, np.concatenate(states.fail), fail_weight, np.log10(np.maximum(p_word, 1e-300)), root_target)
    return machine, states.start, states.count[0]


def walk_block(block: Block, machine: Automaton, start: int) -> list[float]:
    """The score of each text; arcs are loaded for about ``WALK_TOKENS`` tokens at a time."""
    scores, starts, ends, i = [], block.starts.tolist(), block.ends.tolist(), 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(block.ends, starts[i] + WALK_TOKENS, "right")))
        arcs = machine.load(starts[i], ends[j - 1])
        scores += [machine.walk(block.ids[a:b].tolist(), start, arcs) for a, b in zip(starts[i:j], ends[i:j])]
        i = j
    return scores


SCORES = "row {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_blocks(blocks: DataFrame, totals: DataFrame, stats: list[int], n_training: int, order: int, spread_unseen: bool = False, min_context: int = 1) -> DataFrame:
    """Take each block's totals and walk every text."""
    n_tokens, n_known = stats[:2]
    names = [f.split()[0] for f in SCORES.split(", ")]

    def run(group: pa.Table, own: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        block, _ = _restored(group.drop_columns("row").to_pylist()[0])
        by_order = _totals_of(own)
        machine, start, uni = build(block, [by_order.get(n, np.zeros(0, np.int64)) for n in range(1, order + 1)], stats, n_training, order, spread_unseen=spread_unseen, min_context=min_context)
        base = np.log10((uni + 1) / (n_tokens + n_known + 1))
        sums = np.add.reduceat(base, block.starts)
        known = np.add.reduceat((uni > 0).astype(np.int64), block.starts)
        scores = walk_block(block, machine, start)
        return pa.table([group.column("row").chunk(0).flatten(), pa.array(block.ends - block.starts), pa.array(known), pa.array([n_tokens] * len(scores), pa.int64()), pa.array(sums), pa.array(scores, pa.float64())], names)

    kind = blocks.schema["row"].dataType.elementType.simpleString()
    own = blocks.select("block", "row", "training", "ids", "ends", "words")
    return own.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(run, SCORES.format(kind=kind))


def score_texts(df: DataFrame, training: str, text: str = "text", id_column: str = "doc_id", order: int = ORDER, spread_unseen: bool = False, min_context: int = 1) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``df``.

    ``training`` is the name of a boolean column that marks the rows to learn
    from; nulls there count as false.  ``spread_unseen`` shares the unseen mass out
    over V + 1 unknown words; otherwise all unknown words are one class.
    ``min_context`` is the count from which a context of two or more words is a state.
    """
    own = df.select(F.col(id_column).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"), F.coalesce(F.col(training).cast("boolean"), F.lit(False)).cast("int").alias("training"))
    blocks = written(pack_blocks(own), "lm-blocks")
    n_blocks, size = blocks.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    n_training = own.agg(F.coalesce(F.sum("training"), F.lit(0))).first()[0]
    totals = exchange(lambda ranges: first_counts(blocks, order, ranges), n_blocks, size, "lm-totals")
    found = totals.filter("block < 0 AND order = 1").select(*(F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(4))).first()
    stats = [int(x or 0) for x in found]
    totals = totals.filter("block >= 0").select("block", "order", "range", "totals")
    for n in range(3, order + 1):
        longer = exchange(lambda ranges, n=n, known=totals: next_counts(blocks, known, n, ranges, n_training, order, min_context), n_blocks, size, f"lm-totals-{n}")
        totals = totals.unionByName(longer.filter("block >= 0").select(*totals.columns))
    return score_blocks(blocks, totals, stats, int(n_training), order, spread_unseen, min_context).withColumnRenamed("row", id_column)
