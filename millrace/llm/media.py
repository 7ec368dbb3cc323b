"""Media columns: text bytes as 8-bit WAV, spectra, and peak-pair fingerprints.

``wav_column`` stores bytes losslessly as unsigned 8-bit mono samples with the
``wave`` module; ``wav_features`` reads the stored form back and computes
short-time Fourier transforms whose spectral peaks, taken in pairs, give an
array of time-coded fingerprints.  Both map rows one to one without a shuffle;
spectra are made ``FRAMES`` frames at a time, so besides the Arrow batch a text
takes a few times its own size.

Defined cases: a null text counts as empty, an empty text gives 64 zero
samples; silence has no peaks and so an empty fingerprint array; of equal bins
of a band the lowest is its peak, of equal neighbouring frames the first.  Equal
bytes always give equal features.  Repeated rows and null ids, of any type,
give a row each; a column of the name of a new one gets along with it, as the
new one gets an underscore; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name

SAMPLE_RATE = 8000
BLOCK = 64
FRAME = 256
HOP = 128
FRAMES = 2048
#: First bins of the bands in which each frame has one peak candidate, and the end.
BANDS = (2, 8, 20, 48, 129)
FAN_OUT = 3
MAX_GAP = 31


def wav_bytes(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(SAMPLE_RATE)
        w.writeframes(payload)
    return out.getvalue()


def wav_samples(stored: bytes) -> bytes:
    with wave.open(io.BytesIO(stored), "rb") as r:
        if (r.getnchannels(), r.getsampwidth()) != (1, 1):
            raise ValueError("expected 8-bit mono samples")
        return r.readframes(r.getnframes())


_WINDOW = np.hanning(FRAME).astype(np.float32)


def spectrogram(samples: np.ndarray) -> np.ndarray:
    """Power by frame and bin of the Hann-windowed, hopped signal, which holds whole frames."""
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float32) - 128.0, FRAME)[::HOP]
    spectrum = np.fft.rfft(frames * _WINDOW, axis=1)
    return (spectrum.real**2 + spectrum.imag**2).astype(np.float32)


def band_peaks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """By band and frame, the strongest bin and its power; the last frame is filled up with silence."""
    x = np.frombuffer(samples, np.uint8)
    n = max(1, -(-max(0, len(x) - FRAME) // HOP) + 1)
    best, level = np.empty((len(BANDS) - 1, n), np.uint8), np.empty((len(BANDS) - 1, n), np.float32)
    for start in range(0, n, FRAMES):
        stop = min(n, start + FRAMES)
        part = x[start * HOP : (stop - 1) * HOP + FRAME]
        power = spectrogram(np.pad(part, (0, (stop - start - 1) * HOP + FRAME - len(part)), constant_values=128))
        for band, (low, high) in enumerate(zip(BANDS, BANDS[1:])):
            at = power[:, low:high].argmax(axis=1) + low
            best[band, start:stop], level[band, start:stop] = at, power[np.arange(len(power)), at]
    return best, level


def peak_pairs(samples: bytes) -> np.ndarray:
    """Fingerprints in time order: anchor frame << 32 | bin 1 << 16 | bin 2 << 8 | gap.

    A peak is the strongest bin of its band and stronger than that band's
    strongest bin in the frames before and after.  Each peak is paired with the
    next ``FAN_OUT`` peaks that lie at most ``MAX_GAP`` frames later.
    """
    found_t, found_f = [], []
    for best, level in zip(*band_peaks(samples)):
        around = np.pad(level, 1)
        keep = np.flatnonzero((level > around[:-2]) & (level >= around[2:]) & (level > 1e-3))
        found_t.append(keep)
        found_f.append(best[keep])
    t, f = np.concatenate(found_t), np.concatenate(found_f)
    order = np.lexsort((f, t))
    t, f = t[order].astype(np.int64), f[order].astype(np.int64)
    out = []
    for step in range(1, FAN_OUT + 1):
        gap = t[step:] - t[:-step]
        near = gap <= MAX_GAP
        out.append(((t[:-step] << 32) | (f[:-step] << 16) | (f[step:] << 8) | gap)[near])
    return np.sort(np.concatenate(out))


def wav_column(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n_bytes, media): the padded UTF-8 bytes of ``text`` as a WAV file."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, media = [], []
            for value in batch.column(1):
                raw = value.as_py() or b""
                sizes.append(len(raw))
                media.append(wav_bytes(raw + bytes(-len(raw) % BLOCK if raw else BLOCK)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    source = df.select(F.col(id_column).alias("id"), F.col(text).cast("string").cast("binary").alias("raw"))
    out = source.mapInArrow(store, f"id {source.schema['id'].dataType.simpleString()}, n_bytes long, media binary")
    return out.toDF(id_column, *("n_bytes" if id_column.lower() != "n_bytes" else "n_bytes_", "media" if id_column.lower() != "media" else "media_"))


#: What ``wav_features`` adds, and the types.
FEATURES = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "fingerprints": "array<long>"}


def wav_features(df: DataFrame, media: str = "media") -> DataFrame:
    """Digests of the samples read back and the ``fingerprints`` array, after all other columns; ``media`` goes.

    A null ``media`` gives nulls.
    """
    at = df.columns.index(media)
    kept = [i for i in range(len(df.columns)) if i != at]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]

    def features(stored: bytes | None) -> tuple:
        if stored is None:
            return (None,) * len(kinds)
        samples = wav_samples(stored)
        return len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-BLOCK:]), len(stored), hashlib.sha256(stored).hexdigest(), peak_pairs(samples)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(value.as_py()) for value in batch.column(at)]
            new = [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *new], [*(f"c{i}" for i in kept), *FEATURES])

    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    fields = [f"c{i} {plain.schema[i].dataType.simpleString()}" for i in kept] + [f"{c} {t}" for c, t in FEATURES.items()]
    rest = df.select(*(f"`{df.columns[i]}`" for i in kept))
    return plain.mapInArrow(read, ", ".join(fields)).toDF(*rest.columns, *(free_name(rest, c) for c in FEATURES))


def media_digests(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Store, read back and digest: one row per document, the fingerprints as one hex digest."""
    out = wav_features(wav_column(df, text, id_column)).toDF("id", "n_bytes", *FEATURES)
    digests = out.select(
        "id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256",
        F.sha2(F.concat_ws(",", F.transform("fingerprints", lambda x: x.cast("string"))), 256).alias("feature"),
        F.size("fingerprints").cast("long").alias("n_fingerprints"),
    )
    return digests.withColumnRenamed("id", id_column)
