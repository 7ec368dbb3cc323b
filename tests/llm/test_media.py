import hashlib
import zlib

import numpy as np
import pytest
from millrace.llm import media


def test_round_trip_and_digests(spark):
    texts = {1: "hello", 2: None, 3: "", 4: "é" * 32, 5: "word and word " * 3000, 6: "hello", 7: "\x00" * 70}
    df = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id long, text string, media string")
    rows = {r.doc_id: r for r in media.media_digests(df).collect()}
    for k, t in texts.items():
        raw = (t or "").encode()
        padded = raw + bytes(64 if not raw else -len(raw) % 64)
        r = rows[k]
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(padded))
        assert r.payload_sha256 == hashlib.sha256(padded).hexdigest()
        assert r.tail_crc32 == zlib.crc32(padded[-64:])
        assert r.media_bytes == len(padded) + 44
        assert r.media_sha256 == hashlib.sha256(media.wav_bytes(padded)).hexdigest()
    assert rows[1].feature == rows[6].feature != rows[5].feature
    assert rows[2].feature == rows[3].feature


def test_peaks_find_a_tone_in_time():
    t = np.arange(8000)
    tone = np.where((t > 2000) & (t < 5000), 100 * np.sin(2 * np.pi * t * 32 / 256), 0) + 128
    found = media.peak_pairs(tone.astype(np.uint8).tobytes())
    assert len(found) and set((found >> 16 & 0xFF).tolist()) & {31, 32, 33}
    assert media.peak_pairs(bytes([128]) * 4000).size == 0
    assert (np.diff(found >> 32) >= 0).all()


def test_empty_table(spark):
    assert media.media_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_pairs(samples):
    """Fingerprints frame by frame, with the Fourier sum written out."""
    x = [b - 128.0 for b in samples]
    n = max(1, -(-max(0, len(x) - 256) // 128) + 1)
    x += [0.0] * ((n - 1) * 128 + 256 - len(x))
    turn = np.exp(-2j * np.pi * np.outer(np.arange(129), np.arange(256)) / 256)
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(256) / 255)
    power = [np.abs(turn @ (hann * x[t * 128 : t * 128 + 256])) ** 2 for t in range(n)]
    peaks = []
    for low, high in ((2, 8), (8, 20), (20, 48), (48, 129)):
        best = [max(range(low, high), key=lambda f: (p[f], -f)) for p in power]
        level = [p[f] for p, f in zip(power, best)]
        for t in range(n):
            before, after = level[t - 1] if t else 0, level[t + 1] if t + 1 < n else 0
            if level[t] > before and level[t] >= after and level[t] > 1e-3:
                peaks.append((t, best[t]))
    peaks.sort()
    return sorted(t << 32 | f << 16 | g << 8 | u - t for i, (t, f) in enumerate(peaks) for u, g in peaks[i + 1 : i + 4] if u - t <= 31)


@pytest.mark.parametrize("frames", [2048, 3, 1])
def test_fingerprints_equal_brute_force(frames, monkeypatch):
    monkeypatch.setattr(media, "FRAMES", frames)
    rng = np.random.default_rng(8)
    for n in (64, 256, 320, 5000):
        samples = rng.integers(32, 127, n).astype(np.uint8).tobytes()
        assert media.peak_pairs(samples).tolist() == brute_pairs(samples)


def test_any_ids_and_names(spark):
    rows = [(None, "a", 1, None), (None, "a", 2, b"x"), ("k", None, 3, b"y")]
    df = spark.createDataFrame(rows, "payload_bytes string, text string, fingerprints int, media binary")
    got = media.media_digests(df, id_column="payload_bytes")
    assert got.count() == 3 and got.columns[0] == "payload_bytes"
    stored = spark.createDataFrame([(1, media.wav_bytes(b"abcd" * 16), "p"), (2, None, "q")], "payload_bytes int, media binary, fingerprints string")
    out = media.wav_features(stored)
    assert out.columns[:4] == ["payload_bytes", "fingerprints", "payload_bytes_", "payload_sha256"] and out.columns[-1] == "fingerprints_"
    assert sorted((r.payload_bytes, r.fingerprints, r.payload_bytes_) for r in out.collect()) == [(1, "p", 64), (2, "q", None)]
