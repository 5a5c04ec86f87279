"""Texts of an Arrow batch as one byte buffer: words, hashes and batches of bounded size, without a loop per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 20
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.Generator(np.random.PCG64(20240)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batches(stream: Iterator[pa.RecordBatch], text: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches into slices of about ``most`` bytes of text, one row at least."""
    for batch in stream:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def buffer(column: pa.Array, separator: str = "") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one row of bytes and where each starts (and the last ends). Null counts as empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    column = pc.fill_null(column.cast(kind), b"" if kind == pa.large_binary() else "")
    if separator:
        column = pc.binary_join_element_wise(column, pa.scalar("", pa.large_string()), pa.scalar(separator, pa.large_string()))
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = is_word[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def prefix(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``cut`` takes the hash of any range from it."""
    n = len(data)
    if not _powers or len(_powers[0]) < n:
        inverse = pow(int(_PRIME), -1, 1 << 64)
        size = max(n, BATCH_BYTES + (1 << 16))
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size, f, np.uint64)]) for f in (_PRIME, np.uint64(inverse))]
    out = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers[0][:n], out=out[1:])
    return out


def cut(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges; equal for equal bytes."""
    return mix((running[ends] - running[starts]) * _powers[1][starts])


def hashes(strings: list[str]) -> np.ndarray:
    """The hash that ``cut`` gives each of these strings."""
    data, offsets = buffer(pa.array(strings, pa.large_string()))
    return cut(prefix(data), offsets[:-1], offsets[1:])


def lowered_words(column: pa.Array, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, A-Z lower-cased, and the number of words before each text (and in all)."""
    data, offsets = buffer(column, " ")
    data = LOWER[data]
    starts, ends = words(data, is_word)
    return cut(prefix(data), starts, ends), np.searchsorted(starts, offsets)


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length n, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
