"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each in the context of the bits before it in this byte
and of the last 0 to ``DEPTH`` bytes. Every such context holds a Krichevsky-Trofimov
estimate of its training counts; the estimate of a context and the one weighted over its
longer contexts are mixed, half and half a priori, at every depth. A text is its bytes
with A-Z in lower case, after ``DEPTH`` start signs, and one end sign.

A score needs nothing of a text but its (DEPTH + 1)-grams. One pass counts words and grams
of all texts, Spark jobs make a table of each gram's log-probability, and a second pass adds
them up. The most frequent entries, bounded in rows and bytes, go to every task; a text's
other words and grams are joined by shuffle, so nothing is left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import giving_back, scaled_partitions, stored
from .words import words_of

DEPTH = 4
SIGN = 0xFF  # start and end: no byte of UTF-8
CHUNK_BYTES = 1 << 20  # with 4 MB the first pass took 334 MB in a test, mostly for grams
HELD_ENTRIES = 1 << 19  # of a task's counts, before they are handed on
FREQUENT_ROWS, FREQUENT_BYTES = 1 << 18, 1 << 24
BUCKET_GRAMS = 1 << 17
WORD, GRAM, TEXT = 0, 1, 2
_TERM = "kind tinyint, key binary, n_train long, n_all long"
_FOUND = "row long, kind tinyint, key binary, n long, known long, base double, score double, n_bytes long"

_SMALL = 64
_HALF = np.array([math.lgamma(n + 0.5) for n in range(_SMALL)])
_WHOLE = np.array([math.lgamma(n + 1.0) for n in range(_SMALL)])


def _log_gamma(n: np.ndarray, shift: float, table: np.ndarray) -> np.ndarray:
    """log Gamma(n + shift) for whole n: a table for small ones, Stirling's series beyond."""
    x = np.maximum(n, _SMALL) + shift
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < _SMALL, table[np.minimum(n, _SMALL - 1)], series)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log-probability of a sequence of so many zeros and ones under the Krichevsky-Trofimov estimate."""
    return _log_gamma(zeros, 0.5, _HALF) + _log_gamma(ones, 0.5, _HALF) - _log_gamma(zeros + ones, 1.0, _WHOLE) - math.log(math.pi)


def grams_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each byte and at the end sign of each text, and the text's number."""
    texts, length = len(bounds) - 1, np.diff(bounds)
    of_byte = np.repeat(np.arange(texts), length)
    signs = np.full(len(data) + texts * (DEPTH + 1), SIGN, np.int64)
    signs[np.arange(len(data)) + of_byte * (DEPTH + 1) + DEPTH] = data
    gram = signs[DEPTH:].copy()
    for i in range(1, DEPTH + 1):
        gram |= signs[DEPTH - i : len(signs) - i] << (8 * i)
    text = np.repeat(np.arange(texts), length + 1)
    # Of every text the grams before its first byte stand between it and the text before.
    return gram[np.arange(len(text)) + text * DEPTH], text


def gram_keys(grams: np.ndarray) -> pa.Array:
    """Grams as binary, the oldest byte first."""
    width = DEPTH + 1
    signs = np.ascontiguousarray(grams.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 8 - width :])
    return pa.Array.from_buffers(pa.binary(width), len(grams), [None, pa.py_buffer(signs)]).cast(pa.binary())


def gram_numbers(keys: pa.Array) -> np.ndarray:
    """The inverse of ``gram_keys``."""
    keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
    signs = np.frombuffer(b"".join(keys.to_pylist()), np.uint8).reshape(-1, DEPTH + 1).astype(np.int64)
    return sum(signs[:, i] << (8 * (DEPTH - i)) for i in range(DEPTH + 1)) if len(keys) else np.zeros(0, np.int64)


class Held:
    """Counts of one kind that a task has gathered since it last handed them on."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, keys, train: np.ndarray, every: np.ndarray):
        self.parts.append((keys, train, every))
        self.size += len(every)

    def merged(self):
        keys = [p[0] for p in self.parts]
        if self.kind == GRAM:
            keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        else:
            coded = pa.concat_arrays(keys).dictionary_encode()
            keys, at = coded.dictionary, coded.indices.to_numpy()
        train, every = (np.bincount(at, np.concatenate([p[i] for p in self.parts]), len(keys)).astype(np.int64) for i in (1, 2))
        self.parts, self.size = [(keys, train, every)], len(keys)

    def batches(self, last: bool):
        if self.size > HELD_ENTRIES or (last and self.size):
            self.merged()
        if self.size > HELD_ENTRIES // 2 or (last and self.size):
            keys, train, every = self.parts[0]
            keys = gram_keys(keys) if self.kind == GRAM else keys.cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(every), self.kind, np.int8)), keys, pa.array(train), pa.array(every)], names=["kind", "key", "n_train", "n_all"])
            self.parts, self.size = [], 0


def count_terms(batches):
    """Rows of ``_TERM`` from batches of (text, learn): words, the end sign as an empty one, and grams."""
    words_held, grams_held = Held(WORD), Held(GRAM)
    for batch in batches:
        learn = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for words in words_of(batch.column(0), chunk_bytes=CHUNK_BYTES, hashed=False):
            own = learn[words.first : words.first + words.texts]
            coded = words.pieces().dictionary_encode()
            at = coded.indices.to_numpy()
            words_held.add(coded.dictionary, np.bincount(at, own[words.text], len(coded.dictionary)).astype(np.int64), np.bincount(at, minlength=len(coded.dictionary)))
            words_held.add(pa.array([b""], pa.large_binary()), np.array([own.sum()]), np.array([words.texts]))
            grams, text = grams_of(words.data, words.offsets)
            # The lowest bit tells training texts, so that one sort counts both.
            marked = (grams << 1) | own[text]
            marked.sort()
            new = np.flatnonzero(np.diff(marked, prepend=-1))
            n, marked = np.diff(new, append=len(marked)), marked[new]
            grams_held.add(marked >> 1, n * (marked & 1), n)
            yield from words_held.batches(False)
            yield from grams_held.batches(False)
    yield from words_held.batches(True)
    yield from grams_held.batches(True)


@dataclass
class Level:
    """The contexts of one depth: counts, log-probability weighted over this and longer contexts, and the
    log of the own estimate's odds against the longer ones."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray
    odds: np.ndarray | None  # none at the full depth
    above: np.ndarray | None = None  # the place of each context's parent

    @classmethod
    def of(cls, key, zeros, ones, longer=None) -> Level:
        own = log_kt(zeros, ones)
        if longer is None:
            return cls(key, zeros, ones, own, None)
        return cls(key, zeros, ones, np.logaddexp(own, longer) - math.log(2), own - longer)

    def mixed(self, at: np.ndarray, bit: np.ndarray, longer: np.ndarray | None) -> np.ndarray:
        """The probability of ``bit`` in the contexts ``at``, given that of their longer contexts."""
        own = (np.where(bit, self.ones[at], self.zeros[at]) + 0.5) / (self.zeros[at] + self.ones[at] + 1.0)
        if longer is None:
            return own
        share = 1 / (1 + np.exp(-np.clip(self.odds[at], -700, 700)))
        return share * own + (1 - share) * longer


def _decisions(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each gram and bit of its last byte the key of the longest context, (bytes before, bits before), and the bit."""
    last = grams & 0xFF
    k = np.arange(8)[:, None]
    return ((grams >> 8) << 8) | (1 << k) | (last >> (8 - k)), (last >> (7 - k)) & 1


def _shorter(key: np.ndarray, depth: int) -> np.ndarray:
    """Keys of contexts with all but the last ``depth`` bytes taken off."""
    return key & ((1 << 8 * (depth + 1)) - 1)


def levels(grams: np.ndarray, n: np.ndarray, shortest: int) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """The contexts of ``grams`` from the full depth to ``shortest``, the place of each decision's longest context, and its bit."""
    key, bit = _decisions(grams)
    key, at = np.unique(key.ravel(), return_inverse=True)
    total = lambda wanted: np.bincount(at, (np.broadcast_to(n, bit.shape) * wanted).ravel(), len(key)).astype(np.int64)
    made = [Level.of(key, total(bit == 0), total(bit == 1))]
    for depth in range(DEPTH - 1, shortest - 1, -1):
        low = made[-1]
        key, low.above = np.unique(_shorter(low.key, depth), return_inverse=True)
        up = lambda v: np.bincount(low.above, v, len(key))  # noqa: B023,E731
        made.append(Level.of(key, up(low.zeros).astype(np.int64), up(low.ones).astype(np.int64), up(low.weighted)))
    return made, at, bit.ravel()


def _shares(group: pa.Table) -> pa.Table:
    """What a bucket's contexts of two bytes add to those of one byte."""
    made, _, _ = levels(gram_numbers(group["key"]), group["n_train"].to_numpy(), 2)
    key, at = np.unique(_shorter(made[-1].key, 1), return_inverse=True)
    sums = {name: np.bincount(at, getattr(made[-1], name), len(key)) for name in ("zeros", "ones", "weighted")}
    return pa.table({"context": key, "zeros": sums["zeros"].astype(np.int64), "ones": sums["ones"].astype(np.int64), "weighted": sums["weighted"]})


def _valued(top):
    def value(group: pa.Table) -> pa.Table:
        """log10 of the probability of each gram's last byte after the others."""
        one, none = top.value
        made, at, bit = levels(gram_numbers(group["key"]), group["n_train"].to_numpy(), 2)
        p = None
        for level in made:
            p = level.mixed(at, bit, p)
            key, at = level.key[at], level.above[at] if level.above is not None else at
        p = one.mixed(np.searchsorted(one.key, _shorter(key, 1)), bit, p)
        p = none.mixed(np.searchsorted(none.key, _shorter(key, 0)), bit, p)
        return pa.table({"kind": pa.array(np.full(group.num_rows, GRAM, np.int8)), "key": group["key"], "n_all": group["n_all"], "value": np.log10(p).reshape(8, -1).sum(axis=0)})

    return value


def gram_values(grams: DataFrame) -> DataFrame:
    """``kind, key, n_all, value`` of grams with their counts; grams that share their last two context bytes are valued
    together, at most 2**24 of them whatever the corpus."""
    spark = grams.sparkSession
    buckets = scaled_partitions(spark, grams.count(), BUCKET_GRAMS)
    dealt = grams.withColumn("bucket", F.pmod(F.xxhash64(F.expr(f"substring(key, {DEPTH - 1}, 2)")), F.lit(buckets)).cast("int"))
    shares = dealt.select("bucket", "key", "n_train").groupBy("bucket").applyInArrow(_shares, "context long, zeros long, ones long, weighted double")
    # At most 256 bytes before times 255 bits before: bounded whatever the corpus.
    rows = shares.groupBy("context").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted")).orderBy("context").toArrow()
    one = Level.of(*(rows[c].to_numpy() for c in ("context", "zeros", "ones", "weighted")))
    key, at = np.unique(_shorter(one.key, 0), return_inverse=True)
    none = Level.of(key, *(np.bincount(at, v, len(key)).astype(np.int64) for v in (one.zeros, one.ones)), np.bincount(at, one.weighted, len(key)))
    top = spark.sparkContext.broadcast((one, none))
    return dealt.groupBy("bucket").applyInArrow(_valued(top), "kind tinyint, key binary, n_all long, value double")


def _frequent(values: DataFrame) -> dict[int, tuple]:
    """Of each kind the most frequent keys with their values, bounded in rows and bytes."""
    sizes = values.groupBy("kind", F.floor(F.log2("n_all")).alias("power")).agg(F.count("*").alias("n"), F.sum(F.length("key")).alias("bytes")).collect()
    wanted = F.lit(False)
    for kind in (WORD, GRAM):
        least, n, size = 64, 0, 0
        for row in sorted((r for r in sizes if r.kind == kind), key=lambda r: -r.power):
            n, size = n + row.n, size + row.bytes
            if n > FREQUENT_ROWS or size > FREQUENT_BYTES:
                break
            least = row.power
        wanted = wanted | ((F.col("kind") == kind) & (F.floor(F.log2("n_all")) >= least))
    found = values.where(wanted).select("kind", "key", "value").toArrow()
    of = {kind: found.filter(pc.equal(found["kind"], pa.scalar(kind, pa.int8()))) for kind in (WORD, GRAM)}
    grams = gram_numbers(of[GRAM]["key"])
    order = np.argsort(grams)
    return {WORD: (of[WORD]["key"].combine_chunks().cast(pa.large_binary()), of[WORD]["value"].to_numpy()), GRAM: (grams[order], of[GRAM]["value"].to_numpy()[order])}


def _adder(frequent, floor: float):
    """The second pass: a row of kind TEXT for each text with what its frequent words and grams come to, and a row
    for each other word or gram of a text."""
    out = to_arrow_schema(T._parse_datatype_string(_FOUND))

    def rows(kind, row, keys, n):
        values = [row, np.full(len(row), kind, np.int8), keys, n]
        return pa.RecordBatch.from_arrays([*(v if isinstance(v, pa.Array) else pa.array(v) for v in values), *(pa.nulls(len(row), f.type) for f in list(out)[4:])], schema=out)

    def add(batches):
        words_known, counts = frequent.value[WORD]
        grams_known, logs = frequent.value[GRAM]
        log_words = np.log10(counts + 0.1) - floor
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for words in words_of(batch.column(1), chunk_bytes=CHUNK_BYTES, hashed=False):
                own = ids[words.first : words.first + words.texts]
                # Words; the end sign is an empty one.
                coded = pa.concat_arrays([words.pieces(), pa.array([b""] * words.texts, pa.large_binary())]).dictionary_encode()
                text = np.concatenate([words.text, np.arange(words.texts)])
                at = pc.fill_null(pc.index_in(coded.dictionary, value_set=words_known), -1).to_numpy()[coded.indices.to_numpy()]
                hit = at >= 0
                base = np.bincount(text[hit], log_words[at[hit]], words.texts)
                known = np.bincount(text[hit], counts[at[hit]] > 0, words.texts).astype(np.int64)
                rest, n = np.unique((coded.indices.to_numpy()[~hit].astype(np.int64) << 23) | text[~hit], return_counts=True)
                if len(rest):
                    yield rows(WORD, own[rest & 0x7FFFFF], coded.dictionary.take(pa.array(rest >> 23)).cast(pa.binary()), n)
                # Grams: sorted with their text, so that each distinct one is looked up once.
                grams, text = grams_of(words.data, words.offsets)
                n_bytes = np.diff(words.offsets)
                marked = (grams << 23) | text
                marked.sort()
                gram, text = marked >> 23, marked & 0x7FFFFF
                new = np.flatnonzero(np.diff(gram, prepend=-1))
                at = np.searchsorted(grams_known, gram[new])
                hit = np.append(grams_known, -1)[at] == gram[new]
                value = np.where(hit, np.append(logs, 0.0)[at], 0.0)
                times = np.diff(new, append=len(gram))
                score = np.bincount(text, np.repeat(value, times), words.texts)
                rest, n = np.unique(marked[np.repeat(~hit, times)], return_counts=True)
                if len(rest):
                    yield rows(GRAM, own[rest & 0x7FFFFF], gram_keys(rest >> 23), n)
                total = np.bincount(words.text, minlength=words.texts) + 1
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(words.texts, TEXT, np.int8)), pa.nulls(words.texts, pa.binary()), *map(pa.array, (total, known, base, score, n_bytes))], schema=out)

    return add


def score_texts(docs: DataFrame, learn: Column, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row's whole ``text``.

    The model learns from the rows where ``learn`` is true; null counts as false. Words and
    the end sign are the tokens of the base, a smoothed unigram; ``score`` is the log10
    probability of the text, end sign included, under context-tree weighting. A null text
    is an empty one: one token and the end sign's score. Repeated rows are scored and
    learned each time; an empty table gives no rows; other columns don't matter. With
    nothing to learn from all counts are zero and every bit has probability one half.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    terms = texts.mapInArrow(giving_back(count_terms), _TERM).groupBy("kind", "key").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))
    terms = stored(terms)
    is_word = F.col("kind") == WORD
    train_tokens, distinct = terms.where(is_word).agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count(F.when(F.col("n_train") > 0, 1))).first()
    floor = math.log10(train_tokens + 0.1 * (distinct + 1))
    words = terms.where(is_word).select("kind", "key", "n_all", F.col("n_train").cast("double").alias("value"))
    values = stored(words.unionByName(gram_values(terms.where(~is_word))))
    frequent = spark.sparkContext.broadcast(_frequent(values))

    names = [f"__keep_{i}" for i in range(len(keep))]
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).alias("text"), *(F.col(c).alias(n) for c, n in zip(keep, names)))
    add = _adder(frequent, floor)

    def with_kept(batches):
        """The kept columns go along on the rows of kind TEXT, which come in the order of the input."""
        for batch in batches:
            table, done = batch.select(names), 0
            for made in add([batch]):
                n = made.num_rows if made.column(1)[0].as_py() == TEXT else 0
                held = table.slice(done, n).columns if n else [pa.nulls(made.num_rows, f.type) for f in table.schema]
                done += n
                yield pa.RecordBatch.from_arrays([*made.columns, *held], names=[*made.schema.names, *names])

    schema = T.StructType([*T._parse_datatype_string(_FOUND).fields, *(T.StructField(n, docs.schema[c].dataType) for c, n in zip(keep, names))])
    found = stored(numbered.mapInArrow(giving_back(with_kept), schema))
    rest = found.where(F.col("kind") != TEXT).select("row", "kind", "key", "n").join(values.select("kind", "key", "value"), ["kind", "key"], "left")
    count = F.coalesce("value", F.lit(0.0))
    word = F.col("kind") == WORD
    rest = rest.groupBy("row").agg(
        F.sum(F.when(word & (count > 0), F.col("n"))).alias("more_known"),
        F.sum(F.when(word, F.col("n") * (F.log10(count + 0.1) - floor))).alias("more_base"),
        F.sum(F.when(~word, F.col("n") * F.col("value"))).alias("more_score"),
    )
    whole = found.where(F.col("kind") == TEXT).join(rest, "row", "left")
    both = lambda c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0))
    bits = -both("score") * math.log2(10) / (F.col("n_bytes") + 1)
    return whole.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), F.col("n").alias("n_tokens"), both("known").alias("n_known"), F.lit(train_tokens).cast("long").alias("train_tokens"), both("base").alias("base_score"), both("score").alias("score"), bits.alias("bits_per_byte"))


def in_fold(id_column: str = "doc_id", folds: int = 10) -> Column:
    """Whether a row is of fold 0; null without an id, which no fold holds."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == 0


def held_out(id_column: str = "doc_id", folds: int = 10) -> Column:
    """Rows of fold 0; those without an id, which no fold holds, aren't learned from either."""
    return F.coalesce(in_fold(id_column, folds), F.lit(True))
