"""Media columns: 8-bit WAV payloads, short-time Fourier transforms and spectral-peak pair fingerprints.

A text's UTF-8 bytes, padded with 255 to a positive multiple of 576, become the samples of a mono 8-bit WAV file. The file is
read back by the wave module; the samples read are cut into half-overlapping frames, and each frame's spectrum gives the
strongest bin of each band. A bin that is also a maximum in time is a peak. Each peak is paired with the next peaks, and every
pair is stored as its time code (frame) and a hash code (both bins and the distance in frames).
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

from quillgrid.llm.common import small_batches
from quillgrid.llm.scan import parts

UNIT, PAD, RATE = 576, 255, 8000
HOP = UNIT // 2
#: Edges of the frequency bands, in bins of the 576-point transform.
BANDS = (1, 9, 18, 36, 72, 144, 289)
FAN, REACH, FRAMES_AT_ONCE = 3, 63, 2048
WINDOW = np.hanning(UNIT).astype(np.float32)

SCHEMA = (
    "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media binary, "
    "fp_time array<int>, fp_code array<int>"
)


def to_wav(data: bytes) -> bytes:
    payload = data + bytes([PAD]) * (-len(data) % UNIT if data else UNIT)
    with wave.open(out := io.BytesIO(), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def fingerprint(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Time codes and hash codes of all peak pairs, in time order. Frames are transformed in blocks, so memory is bounded for any length."""
    x = np.frombuffer(samples, np.uint8)
    frames = np.lib.stride_tricks.sliding_window_view(x, UNIT)[::HOP]
    bins, tops = [], []
    for at in range(0, len(frames), FRAMES_AT_ONCE):
        part = (frames[at : at + FRAMES_AT_ONCE].astype(np.float32) - np.float32(128)) * WINDOW
        power = np.fft.rfft(part, axis=1)
        power = power.real**2 + power.imag**2
        found = np.stack([a + power[:, a:b].argmax(axis=1) for a, b in zip(BANDS, BANDS[1:])], axis=1)
        bins.append(found)
        tops.append(np.take_along_axis(power, found, axis=1))
    found, top = np.concatenate(bins), np.concatenate(tops)
    edge = np.full((1, top.shape[1]), -1, top.dtype)
    peak = (top >= np.concatenate([edge, top[:-1]])) & (top > np.concatenate([top[1:], edge]))
    t, band = np.nonzero(peak)
    f = found[t, band]
    times, codes = [], []
    for k in range(1, FAN + 1):
        gap = t[k:] - t[:-k]
        near = gap <= REACH
        times.append(t[:-k][near])
        codes.append(((f[:-k] << 15) | (f[k:] << 6) | gap)[near])
    times, codes = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((codes, times))
    return times[order].astype(np.int32), codes[order].astype(np.int32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media", "fp_time", "fp_code"]
    for part, texts in parts(batches, rows=128):
        out: list[list] = [[] for _ in names]
        for doc_id, data in zip(part.column(0).to_pylist(), texts):
            media = to_wav(data)
            back = from_wav(media)
            times, codes = fingerprint(back)
            for column, value in zip(out, (doc_id, len(data), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), media, times, codes)):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)


def media_columns(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the stored WAV bytes, what reading them back gave, and the fingerprint's time-coded arrays.

    Null and empty texts give one unit of padding; very long texts are stored whole, and transformed in blocks of frames. Peaks that tie go to the lower bin and the
    later frame; equal texts have equal values. Rows are independent of each other: repeated rows and null ids are kept, an empty table
    gives an empty result, other columns are ignored.
    """
    small_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_rows, SCHEMA)


def media_digest(docs: DataFrame) -> DataFrame:
    """The digest columns of media_columns(), one row per row of docs. Odd rows as there."""
    return media_columns(docs).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32",
        F.length("media").cast("bigint").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", F.size("fp_time"), F.hex(F.xxhash64("fp_time", "fp_code"))).alias("feature"),
    )
