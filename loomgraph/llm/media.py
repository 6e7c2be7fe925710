"""Operator 10, media columns: text payloads as WAV samples with spectral-peak fingerprints.

A payload is stored as 8-bit mono PCM through the standard wave module, read back from the stored bytes, cut
into frames of 192 samples that advance by 96, and transformed (Hann window, real FFT). In each of two bands the
strongest bin of a frame is a peak when no neighbouring frame has a stronger one in that band. Each peak is paired
with the next FAN_OUT peaks at most FAR frames later; a pair is stored as time << 32 | bin1 << 16 | bin2 << 4 | gap.

Defined results: a null or empty text gives 192 spaces; texts of any length are processed whole, in blocks of
frames; repeated rows give repeated rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import ship

UNIT = 192
FRAME, HOP = 192, 96
BANDS = ((1, 33), (33, 97))
FAN_OUT, FAR = 2, 15
BLOCK = 8192
RATE = 8000
SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
    "media_bytes long, media_sha256 string, feature string"
)


def payload_of(raw: bytes) -> bytes:
    """raw followed by spaces up to a positive multiple of UNIT."""
    size = max(UNIT, -(-len(raw) // UNIT) * UNIT)
    return raw.ljust(size, b" ")


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


_WINDOW = np.hanning(FRAME).astype(np.float32)


def band_peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each frame and band, the strongest bin and its magnitude; frames go through the transform in blocks."""
    n = max(1, (len(samples) - FRAME) // HOP + 1)
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    bins = np.empty((n, len(BANDS)), np.int64)
    size = np.empty((n, len(BANDS)), np.float32)
    for a in range(0, n, BLOCK):
        block = (frames[a : a + BLOCK].astype(np.float32) - 128.0) * _WINDOW
        mag = np.abs(np.fft.rfft(block, axis=1)).astype(np.float32)
        for k, (lo, hi) in enumerate(BANDS):
            best = mag[:, lo:hi].argmax(axis=1)
            bins[a : a + BLOCK, k] = best + lo
            size[a : a + BLOCK, k] = mag[np.arange(len(best)), best + lo]
    return bins, size


def fingerprints(samples: np.ndarray) -> np.ndarray:
    """Sorted time-coded pair hashes of 8-bit samples (uint8 array of at least FRAME samples)."""
    bins, size = band_peaks(samples)
    before = np.vstack([np.full((1, len(BANDS)), -1, np.float32), size[:-1]])
    after = np.vstack([size[1:], np.full((1, len(BANDS)), -1, np.float32)])
    t, band = np.nonzero((size > 0) & (size >= before) & (size > after))
    f = bins[t, band]
    out = []
    for step in range(1, FAN_OUT + 1):
        gap = t[step:] - t[:-step]
        near = gap <= FAR
        out.append((t[:-step] << 32 | f[:-step] << 16 | f[step:] << 4 | gap)[near])
    return np.sort(np.concatenate(out)) if len(t) > 1 else np.empty(0, np.int64)


def media_row(text: str | None) -> tuple:
    raw = (text or "").encode("utf-8")
    media = to_wav(payload_of(raw))
    back = from_wav(media)
    marks = fingerprints(np.frombuffer(back, np.uint8))
    return (
        len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]),
        len(media), hashlib.sha256(media).hexdigest(), media, marks,
    )


def with_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the stored WAV file and its fingerprint array of every row."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            rows = [media_row(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[6] for r in rows], pa.binary()), pa.array([r[7] for r in rows], pa.list_(pa.int64()))],
                names=["doc_id", "media", "fingerprint"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, media binary, fingerprint array<long>"
    )


def digest(docs: DataFrame) -> DataFrame:
    """The stored form of every text and what is read back from it, as digest columns."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            rows = [media_row(x.as_py()) for x in b.column(1)]
            cols = list(zip(*[(*r[:6], r[7].astype(">i8").tobytes().hex()) for r in rows])) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
