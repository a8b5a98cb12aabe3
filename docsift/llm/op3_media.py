"""Operator 3: media columns, WAV bytes with spectral-peak pair fingerprints.

A text's UTF-8 bytes, padded with zeros to a positive multiple of 64, become the
8-bit samples of a WAV held in a binary column.  Features are computed from the
samples that the wave module reads back: short-time Fourier transforms, the
strongest bin of each band where it is also a peak in time, and pairs of near peaks.
A pair is one 64-bit number: the time of its first peak in the upper 32 bits, and
both bins and the time between them below.

Everything happens row by row within one scan, without a shuffle.  The last frame is
padded with silence, so every sample lies in a frame.  Long signals are transformed in
blocks of frames, so a row's memory is a few times its own bytes.  The query stores the
media table (WAV and fingerprint columns) and derives its digests from what it reads back.

Defined cases: null text counts as empty (64 zero bytes, no peak); a very long text is
one WAV of its own length (below the format's 4 GB); equal texts and repeated rows have
equal values; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import blocks, encoded, map_arrow, per_batch, stored, table

UNIT, RATE, FRAME, HOP, FAN, REACH = 64, 8000, 256, 128, 3, 63
BANDS = (1, 6, 12, 24, 48, 129)
_BLOCK_FRAMES = 2048
#: Text that one batch of media rows holds at about.
MEDIA_BYTES = 4 << 20
_WINDOW = np.hanning(FRAME).astype(np.float32)


def payload(text: bytes) -> bytes:
    return text + bytes(-len(text) % UNIT if text else UNIT)


def to_wav(samples: bytes) -> bytes:
    with wave.open(out := io.BytesIO(), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(samples)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        return r.readframes(r.getnframes())


def peaks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Times and bins of spectral peaks: the strongest bin of each band, where no neighbouring frame is stronger in that band."""
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    x = np.concatenate([x, np.zeros(max(FRAME - len(x), (FRAME - len(x)) % HOP), np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    n, width = len(frames), len(BANDS) - 1
    power, bins = np.empty((n + 2, width), np.float32), np.empty((n, width), np.int64)
    power[0] = power[-1] = -1
    for at in range(0, n, _BLOCK_FRAMES):
        part = frames[at : at + _BLOCK_FRAMES]
        spectrum = np.fft.rfft((part - part.mean(axis=1, keepdims=True)) * _WINDOW, axis=1)
        level = spectrum.real**2 + spectrum.imag**2
        for k, (lo, hi) in enumerate(zip(BANDS, BANDS[1:])):
            best = level[:, lo:hi].argmax(axis=1) + lo
            bins[at : at + len(part), k] = best
            power[at + 1 : at + 1 + len(part), k] = level[np.arange(len(part)), best]
    own = power[1:-1]
    time, band = np.nonzero((own > 1e-6) & (own >= power[:-2]) & (own > power[2:]))
    return time, bins[time, band]


def pair_codes(time: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Time-coded pairs: each peak with the FAN peaks that follow it, up to REACH frames apart."""
    out = []
    for step in range(1, FAN + 1):
        apart = time[step:] - time[:-step]
        near = apart <= REACH
        out.append((time[:-step] << 32 | bins[:-step] << 20 | bins[step:] << 8 | apart)[near])
    return np.sort(np.concatenate(out)) if out else np.empty(0, np.int64)


def fingerprint(media: bytes) -> np.ndarray:
    return pair_codes(*peaks(from_wav(media)))


def media_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: its id, the bytes of the text, the WAV and the fingerprint array."""

    def run(batch):
        texts = encoded(batch.column(1))
        for lo, hi in blocks(texts, MEDIA_BYTES):
            media = [to_wav(payload(t)) for t in texts[lo:hi]]
            prints = pa.array([fingerprint(m) for m in media], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([len(t) for t in texts[lo:hi]], pa.int64()), pa.array(media, pa.binary()), prints], names=["doc_id", "n_bytes", "media", "fingerprint"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, lambda batches: (out for batch in batches for out in run(batch)), "doc_id long, n_bytes long, media binary, fingerprint array<long>")


def _digest(batch):
    rows = []
    offsets, codes = batch.column("fingerprint").offsets.to_numpy(), batch.column("fingerprint").values.to_numpy().astype("<i8")
    for media, lo, hi in zip(batch.column("media").to_pylist(), offsets[:-1], offsets[1:]):
        back = from_wav(media)
        feature = f"{hi - lo}:{hashlib.sha256(codes[lo:hi].tobytes()).hexdigest()}"
        rows.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature))
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]], names=["doc_id", "n_bytes", *names])


def media_digests(media: DataFrame) -> DataFrame:
    """Sizes and checksums of a media table's columns, read back: the payload by the wave module, the feature from the stored array."""
    return map_arrow(media, per_batch(_digest), "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(stored(media_columns(table(spark, sf_dir, "documents")), "media", "zstd"))


QUERIES = {"op3_media": op3_media}
