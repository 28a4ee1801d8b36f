"""CRC-32C (Castagnoli) of many byte ranges at once, and its masked form.

A checksum is linear in the message bits, if the start value is put into the
first four bytes.  So each range is cut into chunks of CHUNK bytes (zeros before
it change nothing), all chunks advance together by tables, and neighbouring
chunks are put together in rounds, the left one shifted by the length of the
right one.
"""

from __future__ import annotations

import numpy as np

from .textarrays import byte_ranges

#: The reflected polynomial, and the constant of masked checksums.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
CHUNK = 64

_LOW = 0xFFFF


def _byte_table() -> np.ndarray:
    table = np.arange(256)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ POLYNOMIAL, table >> 1)
    return table


_BYTES = _byte_table()


def _apply(tables: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by the images of the lower and the upper half of its argument.

    Values are 64-bit numbers, by which numpy indexes without a conversion.
    """
    return tables[0].take(value & _LOW) ^ tables[1].take(value >> 16)


def _advance(value: np.ndarray, zeros: int) -> np.ndarray:
    for _ in range(zeros):
        value = _BYTES.take(value & 255) ^ (value >> 8)
    return value


_HALVES = np.arange(1 << 16) << np.array([[0], [16]])
#: The map that advances a checksum by four zero bytes; with a word added before, by that word.
_WORD = _advance(_HALVES, 4)
_shifts = [_advance(_HALVES, CHUNK)]  # the map that advances by CHUNK * 2**i zero bytes


def _shift(i: int) -> np.ndarray:
    while len(_shifts) <= i:
        _shifts.append(_apply(_shifts[-1], _shifts[-1]))
    return _shifts[i]


def crc32c(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Checksum (uint32) of each range data[starts[i] : starts[i] + sizes[i]]."""
    sizes = np.asarray(sizes, dtype=np.int64)
    starts = np.asarray(starts, dtype=np.int64)
    # Ranges below four bytes can't hold the start value: they go byte by byte.
    out = np.zeros(len(sizes), dtype=np.int64)
    for i in np.flatnonzero(sizes < 4):
        value = 0xFFFFFFFF
        for b in data[starts[i] : starts[i] + sizes[i]].tolist():
            value = int(_BYTES[(value ^ b) & 255]) ^ (value >> 8)
        out[i] = value ^ 0xFFFFFFFF
    long = np.flatnonzero(sizes >= 4)
    if not len(long):
        return out
    starts, sizes = starts[long], sizes[long]
    chunks = -(-sizes // CHUNK)
    ends = np.cumsum(chunks) * CHUNK
    padded = np.zeros(int(ends[-1]), dtype=np.uint8)
    padded[byte_ranges(ends - sizes, sizes)] = data[byte_ranges(starts, sizes)]
    for i in range(4):
        padded[ends - sizes + i] ^= 255
    words = padded.view("<u4").reshape(-1, CHUNK // 4)
    value = np.zeros(len(words), dtype=np.int64)
    for column in words.T:
        value = _apply(_WORD, value ^ column)
    level = 0
    while len(value) > len(chunks):
        # Pairs are counted from the right end of a range; a chunk without a left neighbour stays.
        offsets = np.cumsum(chunks)
        halves = -(-chunks // 2)
        right = np.repeat(offsets - 1, halves) - 2 * (np.repeat(np.cumsum(halves), halves) - 1 - np.arange(int(halves.sum())))
        paired = right - 1 >= np.repeat(offsets - chunks, halves)
        left = np.where(paired, value[np.maximum(right - 1, 0)], 0)
        value = value[right] ^ _apply(_shift(level), left)
        chunks, level = halves, level + 1
    out[long] = value ^ 0xFFFFFFFF
    return out.astype(np.uint32)


def masked(checksums: np.ndarray) -> np.ndarray:
    """Checksums rotated by 15 bits, plus MASK, so that a checksum of checksums is no trivial one."""
    return ((checksums >> np.uint32(15)) | (checksums << np.uint32(17))) + np.uint32(MASK)
