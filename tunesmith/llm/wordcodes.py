"""Vectorised word hashing of Arrow string arrays.

Texts are handled as UTF-8 bytes.  The word patterns of the operators separate at ASCII
characters only, so a byte table decides exactly, and every byte of a longer character
belongs to a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: list[np.ndarray] = []

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE + (1 << 16))
        _powers[:] = []
        for base in (BASE, INVERSE):
            table = np.full(size, np.uint64(base), dtype=np.uint64)
            table[0] = 1
            _powers.append(np.cumprod(table, dtype=np.uint64))
    return _powers


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, start and end offsets of each text; a null text has none."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    starts, ends = offsets[:-1].copy(), offsets[1:].copy()
    if column.null_count:
        ends = np.where(np.asarray(column.is_valid()), ends, starts)
    return data, starts, ends


def words_of(data: np.ndarray, start: int, end: int, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of the words of one stretch of bytes."""
    out: list[tuple] = []
    while start < end:
        stop = min(end, start + SLICE)
        if stop < end:  # not inside a word
            gaps = np.flatnonzero(~is_word[data[start:stop]])
            while not len(gaps) and stop < end:
                stop = min(end, stop + SLICE)
                gaps = np.flatnonzero(~is_word[data[start:stop]])
            if stop < end:
                stop = start + int(gaps[-1]) + 1
        out.append(_slice_words(data, start, stop, is_word, np.zeros(0, np.int64)))
        start = stop
    if not out:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*out)) if len(out) > 1 else out[0]


def _slice_words(data, start, stop, is_word, borders):
    """``borders``: offsets at which a text begins, which therefore end a word."""
    chars = LOWER[data[start:stop]]
    inside = is_word[chars]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    if len(borders):
        at = borders[(borders > start) & (borders < stop)] - start
        first[at] = inside[at]
        last[at - 1] = inside[at - 1]
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power_tables(len(chars) + 1)
    sums = np.zeros(len(chars) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[chars] * up[: len(chars)], out=sums[1:])
    codes = mix((sums[ends] - sums[begins]) * down[begins])
    return codes, begins + start, ends + start


def batch_words(column: pa.Array, is_word: np.ndarray):
    """Words of a batch: ``(data, codes, first byte, end byte, first word of each text)``.

    ``first word`` has one entry more than there are texts.  Neighbouring short texts
    share a numpy call; a long text is cut at separators.
    """
    data, starts, ends = utf8_parts(column)
    n = len(starts)
    pieces, counts = [], np.zeros(n + 1, np.int64)
    i = 0
    while i < n:
        j = i + 1
        if ends[i] - starts[i] < SLICE:
            while j < n and ends[j] - starts[i] <= SLICE and starts[j] == ends[j - 1]:
                j += 1
        if j > i + 1:
            piece = _slice_words(data, int(starts[i]), int(ends[j - 1]), is_word, starts[i + 1 : j])
            at = np.searchsorted(piece[1], np.append(starts[i:j], ends[j - 1]))
            counts[i + 1 : j + 1] = np.diff(at)
        else:
            piece = words_of(data, int(starts[i]), int(ends[i]), is_word)
            counts[i + 1] = len(piece[0])
        pieces.append(piece)
        i = j
    if pieces:
        codes, first, last = (np.concatenate(x) for x in zip(*pieces))
    else:
        codes, first, last = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return data, codes, first, last, np.cumsum(counts)


def gram_codes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive codes (across texts, too)."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(codes) - n + 1, np.uint64)
    factor = 1
    for k in range(n):
        total += codes[k : k + len(total)] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 & (1 << 64) - 1
    return mix(total + np.uint64(n))


def table_of(excluded: str) -> np.ndarray:
    """Byte table of a word class that leaves out the given ASCII characters."""
    table = np.ones(256, dtype=bool)
    table[[ord(c) for c in excluded]] = False
    return table


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = table_of(" \t\n\x0b\x0c\r")
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
LETTERS_DIGITS = table_of("".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])))
