"""Words and their hashes for a batch of texts, found by whole-array operations on the batch's bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE_CODES = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 63, 256, dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes between words: white space only, or all ASCII but letters and digits.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_WORD = np.ones(256, bool)
NOT_WORD[128:] = False
NOT_WORD[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """starts and ends in `data`; doc: the text of each word; first: the first word of each text, and the number of words at the end."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    prefix: np.ndarray

    def hashes(self, ends: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the words, or of what lies between their starts and `ends`."""
        ends = self.ends if ends is None else ends
        return mix(self.prefix[ends] - self.prefix[self.starts] + (ends - self.starts).astype(np.uint64))


def scan(texts: list[bytes], gaps: np.ndarray = SPACES, lower: bool = True) -> Words:
    """texts are joined by a space, so no word crosses from one to the next."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    if lower:
        data = LOWER[data]
    gap = gaps[data]
    edge = np.diff(np.concatenate([[True], gap, [True]]).view(np.int8))
    starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, begin)
    # each byte counts by its code times a power of its place in its word
    prefix = np.zeros(data.size + 1, np.uint64)
    if starts.size:
        head = int(starts[0])
        place = np.arange(data.size - head, dtype=np.int64)
        place -= np.repeat(starts - head, np.diff(np.append(starts, data.size)))
        steps = np.full(int((ends - starts).max()), _BASE, np.uint64)
        steps[0] = 1
        np.minimum(place, steps.size - 1, out=place)
        value = _BYTE_CODES[data[head:]]
        value *= np.cumprod(steps)[place]
        value[gap[head:]] = 0
        np.cumsum(value, out=prefix[head + 1 :])
    return Words(data, starts, ends, np.repeat(np.arange(len(texts)), np.diff(first)), first, prefix)


def parts(batches: Iterator[pa.RecordBatch], column: int = 1, rows: int = 256, size: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the bytes of a text column (null: empty), of at most `rows` rows and about `size` bytes (one text at least)."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
        at = 0
        while at < len(texts):
            end, total = at + 1, len(texts[at])
            while end < len(texts) and end - at < rows and total + len(texts[end]) <= size:
                total += len(texts[end])
                end += 1
            yield batch.slice(at, end - at), texts[at:end]
            at = end
