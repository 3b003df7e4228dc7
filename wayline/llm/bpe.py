"""Byte-level BPE encoding and decoding of whole texts.

Spark's regular expressions split the texts into words. Of each batch of words the
distinct ones are encoded: the words of about one length form a matrix of tokens, and
a fold merges, in all of them at once, the leftmost of the adjacent pairs with the
lowest rank, looked up in a fixed map from pairs of tokens to the token they make.
Texts are put together from their words' ids by Arrow's take; decoding takes the byte
pieces of the ids in the same way. ``bpe_native`` has the same fold in higher-order
functions of Spark; the README says what either costs.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe_native import PATTERN, load_ranks, pair_table
from .common import free_name, giving_back, text_or_empty

NONE = np.int64(1 << 20)
LONG_WORD = 128  # bytes; longer ones are merged one by one
KEPT_WORDS = 100_000  # that a task remembers, and as many of those before
ROWS_AT_ONCE = 1_000
__all__ = ["Codec", "decode", "encode", "fingerprints", "load_ranks"]


class Codec:
    """The constants of a rank file: the pair map in two hashed arrays, single bytes, byte pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        if sorted(ranks.values()) != list(range(len(ranks))) or len(ranks) > 65536 or any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("ranks must be 0 to n - 1, n at most 65,536, and include every single byte")
        self.factors, tables = pair_table(ranks)
        self.tables = [np.array(t, np.int64) for t in tables]
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.pieces = [token for token, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.whole = ranks

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 16 | right
        found = np.full(key.shape, NONE)
        for (a, b), t in zip(self.factors, self.tables):
            entry = t[(left * a + right * b) % len(t)]
            found = np.where(entry >> 16 == key, entry & 65535, found)
        return found

    def fold(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of words of at most LONG_WORD bytes, all merged in step."""
        width = max(map(len, words))
        length = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        ids = self.single[raw]
        ranks = np.full((len(words), width), NONE)
        if width > 1:
            ranks[:, :-1] = np.where(np.arange(1, width) < length[:, None], self.rank(ids[:, :-1], ids[:, 1:]), NONE)
        out: list[np.ndarray] = [ids[:0, 0]] * len(words)
        at = np.arange(len(words))
        while len(at):
            j = ranks.argmin(axis=1)
            rows = np.arange(len(at))
            merged = ranks[rows, j]
            done = merged >= NONE
            for i in np.flatnonzero(done):
                out[at[i]] = ids[i, : length[i]].copy()
            ids, ranks, length, at, j, merged = (x[~done] for x in (ids, ranks, length, at, j, merged))
            if not len(at):
                break
            # Everything after the pair moves one place to the left.
            rows, places = np.arange(len(at)), np.arange(ids.shape[1])
            source = np.minimum(places + (places > j[:, None]), ids.shape[1] - 1)
            ids, ranks = np.take_along_axis(ids, source, 1), np.take_along_axis(ranks, source, 1)
            ids[rows, j] = merged
            length = length - 1
            ranks[rows, length - 1] = NONE
            inner = j + 1 < length
            ranks[rows[inner], j[inner]] = self.rank(merged[inner], ids[rows[inner], j[inner] + 1])
            later = j > 0
            ranks[rows[later], j[later] - 1] = self.rank(ids[rows[later], j[later] - 1], merged[later])
            top = int(length.max())
            ids, ranks = ids[:, :top], ranks[:, :top]
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        """The ids of one long word: a heap of pairs over a linked list of tokens."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        first = self.rank(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first.tolist()) if r < NONE]
        heapq.heapify(heap)
        gone = [False] * size

        def push(i: int) -> None:
            if i >= 0 and after[i] < size:
                r = int(self.rank(np.array([ids[i]]), np.array([ids[after[i]]]))[0])
                if r < NONE:
                    heapq.heappush(heap, (r, i, ids[i], ids[after[i]]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= size or ids[i] != left or ids[j] != right:
                continue
            ids[i], gone[j], after[i] = rank, True, after[j]
            if after[j] < size:
                before[after[j]] = i
            push(before[i])
            push(i)
        return np.array([x for x, g in zip(ids, gone) if not g], np.int64)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        groups: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            token = self.whole.get(word)
            if token is not None:
                out[i] = np.array([token], np.int64)
            elif len(word) > LONG_WORD:
                out[i] = self.merge_long(word)
            else:
                groups.setdefault(len(word), []).append(i)
        for places in groups.values():
            for at in range(0, len(places), 20_000):
                part = places[at : at + 20_000]
                for i, ids in zip(part, self.fold([words[i] for i in part])):
                    out[i] = ids
        return out


class _Batches:
    """Encodes batches of lists of words; remembers the words it has encoded of late."""

    def __init__(self, codec: Codec):
        self.codec, self.known, self.before = codec, {}, {}

    def ids(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all lists end to end, and the lists' bounds in them."""
        words = lists.flatten().cast(pa.binary()).dictionary_encode()
        texts = words.dictionary.to_pylist()
        if len(self.known) > KEPT_WORDS:
            self.known, self.before = {}, self.known
        self.known.update((w, self.before[w]) for w in texts if w in self.before and w not in self.known)
        fresh = [w for w in texts if w not in self.known]
        self.known.update(zip(fresh, self.codec.encode_words(fresh)))
        encoded = [self.known[w] for w in texts]
        count = np.array([len(x) for x in encoded], np.int64)
        flat = np.concatenate(encoded) if encoded else np.zeros(0, np.int64)
        start = np.cumsum(count) - count
        of = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        each = count[of]
        ends = np.cumsum(each)
        ids = flat[np.arange(int(each.sum())) - np.repeat(ends - each, each) + np.repeat(start[of], each)]
        words_each = lists.value_lengths().to_numpy(zero_copy_only=False)
        return ids, np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(words_each)))]


def _parts(batches):
    """The batches in slices of a bounded number of rows."""
    for batch in batches:
        yield from (batch.slice(low, ROWS_AT_ONCE) for low in range(0, batch.num_rows, ROWS_AT_ONCE))


def _words(docs: DataFrame, text_column: str):
    return F.regexp_extract_all(text_or_empty(text_column), F.lit(PATTERN), F.lit(0))


def encode(docs: DataFrame, ranks: dict[bytes, int], keep: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """The ``keep`` columns of every row and ``ids``, an array of ints, of its whole text.

    Null and empty texts have no ids; repeated rows each give a row.
    """
    source = docs.select(*keep, _words(docs, text_column).alias(free_name(keep, "__words")))

    def run(batches):
        coder = _Batches(Codec(ranks))
        for batch in _parts(batches):
            ids, bounds = coder.ids(batch.column(batch.num_columns - 1))
            arrays = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], arrays], names=[*batch.schema.names[:-1], "ids"])

    return source.mapInArrow(giving_back(run), T.StructType([*source.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def _joined(pieces: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each list its pieces, end to end."""
    taken = pieces.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    data = memoryview(taken.buffers()[2]) if len(ids) else memoryview(b"")
    at = offsets[bounds]
    return [bytes(data[a:b]) for a, b in zip(at, at[1:])]


def decode(rows: DataFrame, ranks: dict[bytes, int], keep: tuple[str, ...] = ("doc_id",), ids_column: str = "ids") -> DataFrame:
    """The ``keep`` columns and ``bytes``, the pieces of the ids end to end; none for null or no ids."""
    source = rows.select(*keep, F.coalesce(F.col(ids_column), F.array().cast("array<int>")).alias("__ids"))

    def run(batches):
        pieces = pa.array(Codec(ranks).pieces, pa.large_binary())
        for batch in _parts(batches):
            lists = batch.column(batch.num_columns - 1)
            bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            texts = _joined(pieces, lists.flatten().to_numpy(zero_copy_only=False), bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())], names=[*batch.schema.names[:-1], "bytes"])

    return source.mapInArrow(giving_back(run), T.StructType([*source.schema.fields[:-1], T.StructField("bytes", T.BinaryType())]))


def fingerprints(docs: DataFrame, ranks: dict[bytes, int], keep: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """The ``keep`` columns of every row and, of its whole text: ``n_tokens``, ``ids_sha256`` (of the
    decimal ids joined by commas), ``decoded_sha256`` (of the bytes that the ids decode to)."""
    source = docs.select(*keep, _words(docs, text_column).alias(free_name(keep, "__words")))
    made = T._parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string").fields

    def run(batches):
        coder = _Batches(Codec(ranks))
        pieces = pa.array(coder.codec.pieces, pa.large_binary())
        written = pa.array([b"%d," % i for i in range(len(pieces))], pa.large_binary())
        digest = lambda x: hashlib.sha256(x).hexdigest()
        for batch in _parts(batches):
            ids, bounds = coder.ids(batch.column(batch.num_columns - 1))
            named = [digest(x[:-1]) for x in _joined(written, ids, bounds)]
            decoded = [digest(x) for x in _joined(pieces, ids, bounds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.diff(bounds)), pa.array(named), pa.array(decoded)], names=[*batch.schema.names[:-1], *(f.name for f in made)])

    return source.mapInArrow(giving_back(run), T.StructType([*source.schema.fields[:-1], *made]))
