"""Vectorised hashing of words and shingles over Arrow text columns (helpers inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

CHUNK_BYTES = 4 << 20
SHINGLE = 5

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Odd multipliers of the polynomial and of the places in a shingle, drawn once from a fixed seed.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) * 2 + 1


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about `limit` bytes of text, one row at least."""
    offsets = text_bytes(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column (null: empty) and the offset of each row, with the end."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first, last = int(offsets[0]), int(offsets[-1])
    return flat[first:last], offsets.astype(np.int64) - first


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words, A-Z lower-cased, in order, and the first word of each row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SEPARATOR[data]
    fresh = np.empty(n, bool)
    fresh[0] = True
    fresh[1:] = ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    fresh[edges] = True
    starts = np.flatnonzero(inside & fresh)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    flat = _LOWER[data[inside]].astype(np.uint64) + np.uint64(1)
    firsts = np.flatnonzero(fresh[inside])
    lengths = np.diff(firsts, append=len(flat))
    place = np.arange(len(flat)) - np.repeat(firsts, lengths)
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    hashes = np.add.reduceat(flat * powers[place], firsts)
    return mix(hashes ^ lengths.astype(np.uint64)), np.searchsorted(starts, offsets).astype(np.int64)


def shingles(hashes: np.ndarray, firsts: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, and the first one of each row. A row with fewer words has its
    whole sequence as one shingle, a row without words none."""
    counts = np.diff(firsts)
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(len(firsts), np.int64)
    sums = np.zeros(len(hashes), np.uint64)
    for j in range(min(k, len(hashes))):
        sums[: len(hashes) - j] += hashes[j:] * _PLACES[j]
    sums = mix(sums)
    # The few rows with fewer words: the sum over their own words, and their number.
    for size in range(1, k):
        at = firsts[:-1][counts == size]
        whole = np.full(len(at), size, np.uint64) * _PLACES[63]
        for j in range(size):
            whole += hashes[at + j] * _PLACES[j]
        sums[at] = mix(whole)
    made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(made)])
    index = np.arange(begins[-1]) + np.repeat(firsts[:-1] - begins[:-1], made)
    return sums[index], begins


def of_rows(values: np.ndarray, begins: np.ndarray, reduce: np.ufunc, empty) -> np.ndarray:
    """`reduce` over each row's values; rows without any get `empty`."""
    out = np.full(len(begins) - 1, empty, values.dtype)
    some = np.flatnonzero(np.diff(begins) > 0)
    if len(some):
        out[some] = reduce.reduceat(values, begins[some])
    return out


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of an array of 64-bit numbers; byte planes, so that small numbers cost little."""
    planes = np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64)


def counted(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and the total weight of each."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
    return ordered[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]
