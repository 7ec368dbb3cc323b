"""Language identification with a byte convolutional network in numpy.

Filters of widths 2, 3 and 4 over bytes, max pooling over a fixed-length
window and a softmax.  Training takes one window from each of a bounded sample
of labelled documents (``TRAIN_DOCS``, a parameter); prediction cuts every
whole text into overlapping fixed-length windows, runs them in batches and averages
the class probabilities, weighted by the bytes of each window and by how far its
best class stands above chance.

Prediction maps rows one to one; the model is a few hundred kilobytes.
Defined cases: a null text, or one with no letter, is ``und`` with score 0;
rows with null labels are not learned from; with no labelled row at all every
text is ``und``; of languages with equal probabilities the first in order of
their codes is taken; repeated rows are learned from as often as they occur and
predicted alike; very long texts have more windows, run in the same batches; an
empty table gives an empty result.  The operator is a column, so columns of any
name stand beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTHS = (2, 3, 4)
FILTERS = 16
WINDOW = 256
#: Neighbouring windows share so many bytes that no filter position is lost.
STRIDE = WINDOW - max(WIDTHS) + 1
TRAIN_DOCS = 6000
EPOCHS = 12
BATCH_WINDOWS = 256
#: How much less a window counts that says little about the language.
WINDOW_POWER = 2
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass
class ByteCNN:
    """``filters[k]`` has shape (width, 256, filters); byte 0 is padding and weighs nothing."""

    classes: list[str]
    filters: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    def pair_tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width, (offset, table) whose rows add up to the convolution; pairs of bytes share a table."""
        out = []
        for w in self.filters:
            parts = [(j, (w[j][:, None, :] + w[j + 1][None, :, :]).reshape(65536, -1)) for j in range(0, len(w) - 1, 2)]
            out.append(parts + ([(len(w) - 1, w[-1])] if len(w) % 2 else []))
        return out

    def pooled(self, windows: np.ndarray, tables=None) -> np.ndarray:
        """Max over positions, and 0, of each filter: (windows, widths * filters)."""
        x = windows.astype(np.int32)
        pairs = (x[:, :-1] << 8) | x[:, 1:]
        out = []
        for w, parts in zip(self.filters, tables or self.pair_tables()):
            n = x.shape[1] - len(w) + 1
            total = None
            for offset, table in parts:
                index = pairs[:, offset : offset + n] if len(table) > 256 else x[:, offset : offset + n]
                got = table.take(index, axis=0)
                total = got if total is None else np.add(total, got, out=total)
            out.append(np.maximum(total.max(axis=1), 0))
        return np.concatenate(out, axis=1)

    def probabilities(self, windows: np.ndarray, tables=None) -> np.ndarray:
        z = self.pooled(windows, tables) @ self.dense + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, classes: list[str], epochs: int = EPOCHS, seed: int = 7) -> ByteCNN:
    """Adam on the class-balanced cross-entropy; max pooling sends each gradient to one position."""
    rng = np.random.default_rng(seed)
    n_classes = len(classes)
    net = ByteCNN(classes, [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS], rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, n_classes)).astype(np.float32), np.zeros(n_classes, np.float32))
    for w in net.filters:
        w[:, 0, :] = 0
    weight = (1.0 / np.maximum(np.bincount(labels, minlength=n_classes), 1)) ** 0.5
    weight = weight / weight[labels].mean()
    params = [*net.filters, net.dense, net.bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), 64):
            pick = order[start : start + 64]
            x, y = windows[pick], labels[pick]
            rows = np.arange(len(pick))
            values, places = [], []
            for w in net.filters:
                n = x.shape[1] - len(w) + 1
                conv = sum(w[j].take(x[:, j : j + n], axis=0) for j in range(len(w)))
                at = conv.argmax(axis=1)
                places.append(at)
                values.append(np.take_along_axis(conv, at[:, None, :], axis=1)[:, 0])
            raw = np.concatenate(values, axis=1)
            h = np.maximum(raw, 0)
            z = h @ net.dense + net.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[rows, y] -= 1
            p *= weight[y][:, None] / len(pick)
            back = (p @ net.dense.T) * (raw > 0)
            grads = []
            for k, w in enumerate(net.filters):
                g = np.zeros_like(w)
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(len(w)):
                    np.add.at(g[j], (x[rows[:, None], places[k] + j], np.arange(FILTERS)[None, :]), own)
                    g[j, 0] = 0
                grads.append(g)
            grads += [h.T @ p, p.sum(axis=0)]
            step += 1
            for (m, v), param, g in zip(moments, params, grads):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                param -= (0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def cut_windows(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, zero-padded, and the bytes that each holds."""
    n = max(1, -(-max(0, len(raw) - WINDOW) // STRIDE) + 1)
    padded = np.zeros((n - 1) * STRIDE + WINDOW, np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, np.uint8)
    sizes = np.minimum(WINDOW, len(raw) - np.arange(n) * STRIDE)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE], sizes


def fit(df: DataFrame, text: str = "text", label: str = "lang", id_column: str = "doc_id", train_docs: int = TRAIN_DOCS) -> ByteCNN | None:
    """Learn from one window of each of about ``train_docs`` labelled rows, chosen and placed by a hash."""
    labelled = df.filter(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    share = min(1.0, train_docs / max(labelled.count(), 1))
    draw = F.pmod(F.xxhash64(id_column, F.lit("language")), F.lit(1 << 30))
    raw = F.lower(F.col(text)).cast("binary")
    start = 1 + F.pmod(F.xxhash64(id_column, F.lit("window")), F.greatest(F.lit(1), F.octet_length(raw) - WINDOW + 1)).cast("int")
    rows = labelled.filter(draw < share * (1 << 30)).select(F.substring(raw, start, F.lit(WINDOW)).alias("w"), F.col(label).cast("string").alias("y")).limit(2 * train_docs).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.y, bytes(r.w)))
    classes = sorted({r.y for r in rows})
    windows = np.stack([np.frombuffer(bytes(r.w).ljust(WINDOW, b"\0"), np.uint8) for r in rows])
    return train(windows, np.array([classes.index(r.y) for r in rows]), classes)


def predict(net: ByteCNN, texts, tables=None) -> tuple[list[str], list[float]]:
    """Class and its mean probability for each text, over all its windows."""
    tables = tables or net.pair_tables()
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    sums = np.zeros((len(texts), len(net.classes)))
    weights = np.zeros(len(texts))
    waiting, owners, held, count = [], [], [], 0

    def flush():
        nonlocal count
        if waiting:
            x, who, size = np.concatenate(waiting), np.concatenate(owners), np.concatenate(held)
            for i in range(0, len(x), BATCH_WINDOWS):
                part = slice(i, i + BATCH_WINDOWS)
                p = net.probabilities(x[part], tables)
                # a window that says little about the language counts little
                weight = size[part] * (p.max(axis=1) - 1 / len(net.classes) + 1e-3) ** WINDOW_POWER
                np.add.at(sums, who[part], p * weight[:, None])
                np.add.at(weights, who[part], weight)
            waiting.clear(), owners.clear(), held.clear()
            count = 0

    for i, text in enumerate(texts):
        if text is not None and _LETTER.search(text):
            windows, sizes = cut_windows(text.lower().encode("utf-8"))
            waiting.append(windows)
            owners.append(np.full(len(windows), i))
            held.append(sizes)
            count += len(windows)
            if count >= 8 * BATCH_WINDOWS:
                flush()
    flush()
    for i in np.flatnonzero(weights):
        best = int(sums[i].argmax())
        labels[i], scores[i] = net.classes[best], float(min(1.0, sums[i, best] / weights[i]))
    return labels, scores


def language(net: ByteCNN | None, text: Column) -> Column:
    """A struct (lang_pred, score) for a text column."""
    if net is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = net.pair_tables()
        for texts in parts:
            labels, scores = predict(net, list(texts), tables)
            yield pd.DataFrame({"lang_pred": labels, "score": scores})

    return F.pandas_udf(run, "lang_pred string, score double")(text.cast("string"))
