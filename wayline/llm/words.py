"""Words of many texts at once: boundaries and 64-bit hashes straight from Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: White space of a plain ASCII split: space and \\t to \\r.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Everything but ASCII letters and digits and the bytes of other scripts.
NOT_ALNUM = np.ones(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    NOT_ALNUM[_a:_b] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of texts ``first`` to ``first + texts - 1`` of a column."""

    first: int
    texts: int
    data: np.ndarray  # the bytes of these texts, end to end
    offsets: np.ndarray  # texts + 1 bounds in data
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # for each word its text, from 0
    hash: np.ndarray | None

    def bounds(self) -> np.ndarray:
        """texts + 1 bounds into the words."""
        return np.searchsorted(self.text, np.arange(self.texts + 1))

    def pieces(self) -> pa.Array:
        """The words as a binary array."""
        length = self.end - self.start
        offsets = np.concatenate(([0], np.cumsum(length)))
        place = np.arange(offsets[-1]) + np.repeat(self.start - offsets[:-1], length)
        return pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[place])])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


_tables: list[np.ndarray] = []  # powers of the base, and of its inverse, as far as any chunk has needed them


def _powers(n: int) -> list[np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        made = []
        for base in (int(_BASE), pow(int(_BASE), -1, 2**64)):
            powers = np.full(n, base, np.uint64)
            powers[0] = 1
            made.append(np.multiply.accumulate(powers))
        _tables[:] = made
    return _tables


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span data[start:end]; spans aren't empty.

    A polynomial in the span's bytes, from one running sum over all bytes: a difference of
    sums, divided by the power at its start, is the span's own.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    powers, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    own = (sums[end] - sums[start]) * inverse[start]
    return mix(own ^ ((end - start).astype(np.uint64) << np.uint64(48)))


def words_of(column: pa.Array, apart: np.ndarray = SPACES, lower: bool = True, chunk_bytes: int = CHUNK_BYTES, hashed: bool = True) -> Iterator[Words]:
    """The words of every text, in chunks of whole texts of about ``chunk_bytes``; ``hashed`` or by their bounds only."""
    data, offsets = buffers(column)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        own = data[offsets[first] : offsets[last]]
        own = _LOWER[own] if lower else own
        bounds = offsets[first : last + 1] - offsets[first]
        inside = ~apart[own]
        fresh = np.zeros(len(own) + 1, bool)
        fresh[bounds] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | fresh[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | fresh[1:-1]
        start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
        text = np.repeat(np.arange(last - first), np.diff(np.searchsorted(start, bounds)))
        yield Words(first, last - first, own, bounds, start, end, text, hash_spans(own, start, end) if hashed else None)
        first = last


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of n words; a text of fewer words gives all of them as one."""
    if not len(words.hash):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.bincount(words.text, minlength=words.texts)
    bounds = np.cumsum(count) - count
    value = words.hash.copy()
    for i in range(1, n):
        value[:-i] = mix(value[:-i] * _BASE + np.roll(words.hash, -i)[:-i]) if i < len(value) else value[:-i]
    place = np.arange(len(value)) - bounds[words.text]
    whole = place + n <= count[words.text]
    hashes, texts = value[whole], words.text[whole]
    short = np.flatnonzero((count > 0) & (count < n))
    extra = []
    for t in short:
        own = words.hash[bounds[t] : bounds[t] + count[t]]
        h = own[:1].copy()
        for w in own[1:]:
            h = mix(h * _BASE + w)
        extra.append(mix(h + np.uint64(count[t]))[0])
    return np.concatenate([hashes, np.array(extra, np.uint64)]), np.concatenate([texts, short])


def distinct(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, hash) pairs, ordered by text and then hash."""
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    return hashes[new], texts[new]
