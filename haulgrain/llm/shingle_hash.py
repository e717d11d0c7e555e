"""Sets of hashed word shingles, computed for whole Arrow batches at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(20_240_229))
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=U64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Texts are taken together up to so many bytes; a longer text is taken alone.
CHUNK_BYTES = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """Powers of ``base``; those of a chunk's length are kept, longer ones, for a longer word, are not."""
    known = _powers.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, dtype=U64)
        steps[0] = U64(1)
        known = np.multiply.accumulate(steps)
        if n <= CHUNK_BYTES + 1:
            _powers[name] = known
    return known


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, byte offsets of rows) over a column of texts; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """Stretches of a text of about a chunk each, cut behind white space only."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + CHUNK_BYTES)
        spaces = np.flatnonzero(_SPACE[data[at:end]]) if end < n else ()
        if len(spaces):
            end = at + int(spaces[-1]) + 1
        while end < n and not _SPACE[data[end - 1]]:  # a word longer than a chunk
            ahead = np.flatnonzero(_SPACE[data[end:end + CHUNK_BYTES]])
            end = end + int(ahead[0]) + 1 if len(ahead) else min(n, end + CHUNK_BYTES)
        yield data[at:end]
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the word offsets of each row."""
    if len(data) > CHUNK_BYTES and len(offsets) == 2:
        hashes = np.concatenate([_word_hashes(x, np.array([0, len(x)]))[0] for x in _pieces(data)])
        return hashes, np.array([0, len(hashes)])
    return _word_hashes(data, offsets)


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    if n == 0:
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(_BYTE_VALUE[_LOWER[data]] * _power("up", _BASE, n)[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power("down", _BASE_INVERSE, n)[starts]
    return mix(hashes), np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, offsets of rows): each row's distinct shingles, ascending.

    A text with fewer than ``size`` words is one shingle; a text without words has none.
    """
    for first, _, data, offsets in text_chunks(column):
        hashes, at = word_hashes(data, offsets)
        if len(data) > CHUNK_BYTES and len(hashes) >= size:  # a long text alone: no row numbers, one sort
            whole = hashes[:len(hashes) - size + 1] * _PLACE[0]
            for j in range(1, size):
                whole += hashes[j:len(hashes) - size + 1 + j] * _PLACE[j]
            values = np.unique(mix(whole))
            yield first, values, np.array([0, len(values)])
            continue
        counts = np.diff(at)
        rows = np.repeat(np.arange(len(counts)), counts)
        short = (counts > 0) & (counts < size)
        whole = np.zeros(0, U64)
        if len(hashes) >= size:
            whole = sum(hashes[j:len(hashes) - size + 1 + j] * _PLACE[j] for j in range(size))
        full = np.flatnonzero(rows[:len(whole)] == rows[size - 1:size - 1 + len(whole)]) if len(whole) else np.zeros(0, int)
        values, owner = mix(whole[full]), rows[full]
        if short.any():
            place = np.arange(len(hashes)) - at[rows]
            parts = np.where(short[rows], hashes * _PLACE[np.minimum(place, size) + 16], U64(0))
            sums = np.add.reduceat(parts, at[:-1][short])  # rows between hold zeros
            values = np.concatenate((values, mix(sums)))
            owner = np.concatenate((owner, np.flatnonzero(short)))
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        keep = np.ones(len(values), dtype=bool)
        keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        values, owner = values[keep], owner[keep]
        yield first, values, np.searchsorted(owner, np.arange(len(counts) + 1))


def set_keys(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set; equal sets have equal keys."""
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(values ^ _PLACE[40]))))
    n = np.diff(offsets).astype(U64)
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) + n * _PLACE[41])
