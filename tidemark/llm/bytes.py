"""Numpy helpers over the raw UTF-8 buffers of Arrow string columns.

``chunks`` cuts an Arrow batch into runs of whole rows of about ``CHUNK`` bytes
and at most ``MOST_ROWS`` rows (a longer text is a run of its own), so that temporaries stay small whatever
the batch size; ``words`` finds the words of a run and hashes them to 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
#: Rows in a run at most, so that a row's place in it has 16 bits.
MOST_ROWS = 1 << 15
U = np.uint64

#: Space and \\x09-\\x0D part words.
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0x80:] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK * 2)
        for i, x in enumerate((_R, _R_INVERSE)):
            p = np.full(size, U(x))
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in bytes and their end) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), first + MOST_ROWS, len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(buf: np.ndarray, offsets: np.ndarray, word: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word (and the number of words at the end)."""
    new = np.zeros(len(buf) + 1, bool)  # a row begins here
    new[offsets] = True
    return runs(word[buf], new, offsets)


def runs(inside: np.ndarray, new: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``spans`` by whether each byte is in a word and whether each place, the end too, parts words."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts = np.flatnonzero(inside & (~before | new[:-1]))
    ends = np.flatnonzero(inside & (~after | new[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of buf[start:end]."""
    if not len(starts):
        return np.zeros(0, U)
    up, down = powers(len(buf) + 1)
    sums = np.concatenate((np.zeros(1, U), np.cumsum(_BYTE[buf] * up[: len(buf)])))
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def shingles(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every window of n words within a row; a row with fewer words has its whole sequence as one."""
    count = np.diff(first)
    row_of = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(h)) - np.repeat(first[:-1], count)
    total = np.repeat(count, count)
    width = np.minimum(total, n)
    out = np.zeros(len(h), U)
    for k in range(n):
        shifted = np.zeros(len(h), U)
        if k < len(h):
            shifted[: len(h) - k] = h[k:]
        out = np.where(k < width, mix(out * U(0xD1342543DE82EF95) + shifted + U(1)), out)
    use = (place + n <= total) | ((place == 0) & (total < n))
    return row_of[use], mix(out[use] + width[use].astype(U))


def lowered(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in lower case (A-Z and the Latin-1 letters), and which were upper case."""
    upper = (buf >= 0x41) & (buf <= 0x5A)
    if len(buf):
        after = np.concatenate(([False], buf[:-1] == 0xC3))
        upper |= after & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)
    return buf + upper.astype(np.uint8) * np.uint8(0x20), upper


def word_bytes(buf: np.ndarray) -> np.ndarray:
    """Letters, digits, and points or commas between digits; Latin-1 and general punctuation are none."""
    inside = LETTER[buf] | DIGIT[buf]
    n = len(buf)
    if n > 2:
        digit = DIGIT[buf]
        mark = (buf == 0x2E) | (buf == 0x2C)
        inside[1:-1] |= mark[1:-1] & digit[:-2] & digit[2:]
        for lead in np.flatnonzero(buf == 0xC2):
            inside[lead : lead + 2] = False
        for lead in np.flatnonzero((buf[:-2] == 0xE2) & ((buf[1:-1] == 0x80) | (buf[1:-1] == 0x81))):
            inside[lead : lead + 3] = False
    return inside
