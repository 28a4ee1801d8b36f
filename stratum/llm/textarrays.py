"""Array arithmetic on the UTF-8 buffers of Arrow string columns.

The operators that read whole texts inside Spark tasks share these helpers:
a batch of texts is one byte array with row offsets, tokens are ranges of it,
and every token gets a 64-bit hash from one running sum over the bytes.  No
function here loops over characters or words in Python, and every batch is
cut into blocks of bounded size first, so that memory does not grow with the
partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once (a longer text is a block alone).
BLOCK_BYTES = 2_000_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=_U)
        steps[0] = 1
        table = np.multiply.accumulate(steps)
        if n <= 4 * BLOCK_BYTES:  # the rare huge text does not stay in memory
            _powers[base] = table
    return table


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z and nothing else."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def separator_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of the bytes that separate tokens (inclusive ranges)."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: `[^\x20\x09-\x0D]+`
SPACES = separator_table((0x20, 0x20), (0x09, 0x0D))

_LOWER = lower_table()
_BYTE_VALUE = mix(_LOWER.astype(_U) + _U(1))
_RAW_BYTE_VALUE = mix(np.arange(256, dtype=_U) + _U(1))


def text_blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into (first row, end row, bytes, offsets) blocks.

    Nulls become empty texts.  Offsets are int64, start at 0 and have one more
    entry than the block has rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def token_ranges(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row offsets into them) of the maximal runs of non-separators; rows break runs."""
    n = len(data)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~separators[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    breaks = offsets[(offsets > 0) & (offsets < n)]
    first[breaks] |= inside[1:-1][breaks]
    last[breaks - 1] |= inside[1:-1][breaks - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def token_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of every byte range; `lower` reads A-Z as a-z."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, dtype=_U)
    sums = np.zeros(n + 1, dtype=_U)
    np.multiply((_BYTE_VALUE if lower else _RAW_BYTE_VALUE)[data], _power_table(_BASE, n)[:n], out=sums[1:])
    np.add.accumulate(sums, out=sums)
    value = (sums[ends] - sums[starts]) * _power_table(_INVERSE, n + 1)[starts]
    return mix(value ^ mix((ends - starts).astype(_U)))


def shingle_hashes(tokens: np.ndarray, row_offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k tokens inside a row, and row offsets into them.

    A row with 1 to k-1 tokens gives one hash, of its whole sequence.
    """
    n = len(tokens)
    counts = np.diff(row_offsets)
    out_counts = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_offsets = np.concatenate(([0], np.cumsum(out_counts)))
    if not n:
        return np.zeros(0, dtype=_U), out_offsets
    padded = np.concatenate((tokens, np.zeros(k - 1, dtype=_U)))
    full = np.zeros(n, dtype=_U)
    for i in range(k):
        full = full * _U(_BASE) + padded[i : i + n]
    full = mix(full + _U(k))
    position = np.arange(n) - np.repeat(row_offsets[:-1], counts)
    keep = position < np.repeat(out_counts, counts)
    out = full[keep]
    for row in np.flatnonzero((counts > 0) & (counts < k)):
        value = _U(0)
        with np.errstate(over="ignore"):
            for token in tokens[row_offsets[row] : row_offsets[row + 1]]:
                value = value * _U(_BASE) + token
        out[out_offsets[row]] = mix(np.array([value + _U(counts[row])], dtype=_U))[0]
    return out, out_offsets


def byte_ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices starts[i] ... starts[i] + sizes[i] - 1 for all i, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def distinct_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(example, inverse) of the distinct byte ranges: range i has the bytes (and the kind) of range example[inverse[i]].

    Ranges are told apart by hash; the bytes are compared then, and if two of
    one hash differ, all are compared as bytes.
    """
    hashes = token_hashes(data, starts, ends, lower=False)
    if kinds is not None:
        hashes = mix(hashes + kinds.astype(_U) * _U(_BASE))
    _, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    twin, sizes = example[inverse], ends - starts
    same = np.array_equal(sizes, sizes[twin]) and (kinds is None or np.array_equal(kinds, kinds[twin]))
    if not (same and np.array_equal(data[byte_ranges(starts, sizes)], data[byte_ranges(starts[twin], sizes)])):
        raw, numbers = data.tobytes(), {}
        keys = [(raw[a:b], k) for a, b, k in zip(starts.tolist(), ends.tolist(), kinds.tolist() if kinds is not None else [0] * len(starts), strict=True)]
        inverse = np.array([numbers.setdefault(key, len(numbers)) for key in keys], dtype=np.int64)
        _, example = np.unique(inverse, return_index=True)
    return example, inverse


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeStringArray:
    """Byte ranges as an Arrow array of strings."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[byte_ranges(starts, sizes)])))
