"""Byte-level BPE with Spark's higher-order functions.

Texts are split by the tokenizer's pattern. A word's bytes become single-byte tokens
and a fold merges, again and again, the leftmost of the adjacent pairs with the
lowest rank. Ranks are looked up in a constant map from pairs of tokens to the token
they make: two arrays, addressed by two hashes of the pair, each pair in one of them.
The distinct words of a bounded sample are encoded first, the frequent ones kept as a
constant of their own, and texts look their words up there; any other word is folded
where it stands. The sample and the number of words kept bear on the speed only.
Decoding concatenates the byte pieces of the ids.
"""

from __future__ import annotations

import base64
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, text_or_empty

#: The tokenizer's pattern, its white space spelled out as Unicode's for Java.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"""
NONE = 1 << 20  # above every rank
SLOTS = 131_071
KEPT_WORDS = 1 << 19
BUCKETS = 1 << 18
SAMPLE_BYTES = 100_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def pair_table(ranks: dict[bytes, int], slots: int = SLOTS, seed: int = 1):
    """Hash factors and two arrays of (left << 16 | right) << 16 | merged; -1 where empty."""
    entries = []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                entries.append((left << 16 | right) << 16 | rank)
    rng = random.Random(seed)
    while True:
        factors = [(rng.randrange(1, 1 << 20) | 1, rng.randrange(1, 1 << 20) | 1) for _ in range(2)]
        tables = [[-1] * slots, [-1] * slots]
        for entry in entries:
            side = 0
            for _ in range(500):
                left, right = entry >> 32, entry >> 16 & 65535
                slot = (left * factors[side][0] + right * factors[side][1]) % slots
                entry, tables[side][slot] = tables[side][slot], entry
                if entry < 0:
                    break
                side ^= 1
            if entry >= 0:
                break
        else:
            return factors, tables


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


class Tokenizer:
    """The constants of one rank file in a session: the pair map, single-byte tokens, byte pieces, kept words."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        if sorted(ranks.values()) != list(range(len(ranks))) or len(ranks) > 65536 or any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("ranks must be 0 to n - 1, n at most 65,536, and include every single byte")
        self.factors, tables = pair_table(ranks)
        pieces = [token.hex() for token, _ in sorted(ranks.items(), key=lambda x: x[1])]
        # Literals once the optimizer has folded them.
        numbers = lambda x: F.split(F.lit(",".join(map(str, x))), ",").cast("array<bigint>")
        single = [ranks[bytes([i])] for i in range(256)]
        first = [ranks.get(bytes([i, j]), NONE) for i in range(256) for j in range(256)]
        self._map = [numbers(tables[0]).alias("t0"), numbers(tables[1]).alias("t1"), numbers(single).alias("bytes"), numbers(first).alias("first")]
        self._pieces = F.split(F.lit(",".join(pieces)), ",")
        self._kept: DataFrame | None = None

    def _rank(self, tables: Column, left: Column, right: Column) -> Column:
        """The rank of the token that two tokens make; null if none."""

        def entry(side: int) -> Column:
            a, b = self.factors[side]
            return F.get(tables[f"t{side}"], ((left * a + right * b) % SLOTS).cast("int"))

        key = left * 65536 + right
        here, there = entry(0), entry(1)
        return F.when(F.shiftright(here, 16) == key, here.bitwiseAND(65535)).when(F.shiftright(there, 16) == key, there.bitwiseAND(65535))

    @staticmethod
    def _utf8(word: Column) -> Column:
        """The UTF-8 bytes of a word, as whole numbers."""

        def of_character(code: Column) -> Column:
            tail = lambda bits: F.shiftright(code, bits).bitwiseAND(63) + 128
            return (
                F.when(code < 0x80, F.array(code))
                .when(code < 0x800, F.array(F.shiftright(code, 6) + 0xC0, tail(0)))
                .when(code < 0x10000, F.array(F.shiftright(code, 12) + 0xE0, tail(6), tail(0)))
                .otherwise(F.array(F.shiftright(code, 18) + 0xF0, tail(12), tail(6), tail(0)))
            )

        codes = F.transform(F.split(word, ""), F.ascii)
        wide = F.flatten(F.transform(F.split(word, ""), lambda c: _let(F.ascii(c), of_character)))
        return F.when(F.octet_length(word) == F.length(word), codes).otherwise(wide)

    def _fold(self, tables: Column, word: Column) -> Column:
        """The ids of one word, comma after each.

        The state is an array with a number for each token: rank of its pair with the next
        token, place of its first byte, its id. So the least number is the pair to merge.
        """
        ids, places = (1 << 17) - 1, (1 << 37) - 1

        def number(rank: Column, low: Column) -> Column:
            return F.shiftleft(F.coalesce(rank, F.lit(NONE).cast("bigint")), 37) + low

        def merge(state: Column, _: Column) -> Column:
            def at(least: Column):
                merged = F.shiftright(least, 37)

                def around(j: Column) -> Column:
                    left, next_ = F.get(state, j - 2), F.get(state, j + 1)
                    made = number(self._rank(tables, merged, next_.bitwiseAND(ids)), least.bitwiseAND(places - ids) + merged)
                    rest = F.slice(state, j + 2, F.size(state))
                    before = number(self._rank(tables, left.bitwiseAND(ids), merged), left.bitwiseAND(places))
                    return F.when(j == 1, F.concat(F.array(made), rest)).otherwise(F.concat(F.slice(state, F.lit(1), j - 2), F.array(before, made), rest))

                return F.when(least >= NONE << 37, state).otherwise(_let(F.array_position(state, least).cast("int"), around))

            return _let(F.array_min(state), at)

        def start(b: Column) -> Column:
            rank = lambda x, i: F.get(tables["first"], x * 256 + F.get(b, i + 1))
            state = F.transform(b, lambda x, i: number(rank(x, i), F.shiftleft(i.cast("bigint"), 17) + F.get(tables["bytes"], x)))
            return F.aggregate(F.sequence(F.lit(1), F.size(b)), state, merge, lambda s: F.array_join(F.transform(s, lambda x: F.concat(x.bitwiseAND(ids).cast("string"), F.lit(","))), ""))

        return _let(self._utf8(word), start)

    def keep_words(self, docs: DataFrame, text_column: str = "text", words: int = KEPT_WORDS, sample_bytes: int = SAMPLE_BYTES) -> None:
        """Encode the distinct words of a sample of the texts and keep the most frequent."""
        text = text_or_empty(text_column)
        size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        share = max(1, -(-size // sample_bytes))
        sample = docs.where(F.pmod(F.xxhash64(text_column), F.lit(share)) == 0)
        each = sample.select(F.explode(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).alias("word"))
        often = each.where(~F.col("word").contains("\n")).groupBy("word").count().orderBy(F.desc("count"), "word").limit(words).select("word")
        often = often.repartition("word")
        encoded = cut(often.select("word", _let(F.struct(*self._map), lambda tables: self._fold(tables, F.col("word"))).alias("ids")))
        bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int")
        entry = F.concat("word", F.lit("\n"), "ids", F.lit("\n"))
        filled = encoded.groupBy(bucket.alias("bucket")).agg(F.concat(F.lit("\n"), F.array_join(F.collect_list(entry), "")).alias("entries"))
        every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(filled, "bucket", "left")
        slots = F.array_sort(F.collect_list(F.struct("bucket", F.coalesce("entries", F.lit("")).alias("entries"))))
        kept = every.agg(F.transform(slots, lambda x: x["entries"]).alias("kept"))
        self._kept = cut(kept)

    def encode(self, docs: DataFrame, text_column: str = "text", into: str = "encoded") -> DataFrame:
        """``docs`` with the ids of each text as a string, comma after each; empty for an empty text."""

        def word_ids(tables: Column):
            def of(word: Column) -> Column:
                if self._kept is None:
                    return self._fold(tables, word)
                entries = F.get(tables["kept"], F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int"))
                key = F.concat(F.lit("\n"), word, F.lit("\n"))
                # Entries stand between line feeds, which no kept word has.
                rest = F.call_function("substring_index", entries, key, F.lit(-1))
                return F.when(F.contains(entries, key), F.call_function("substring_index", rest, F.lit("\n"), F.lit(1))).otherwise(self._fold(tables, word))

            return of

        constant = list(self._map)
        if self._kept is not None:
            # A scalar subquery can't stand in a lambda itself; the optimizer puts it back in place of the column.
            docs = docs.withColumn("__kept", self._kept.scalar())
            constant.append(F.col("__kept").alias("kept"))
        words = F.regexp_extract_all(text_or_empty(text_column), F.lit(PATTERN), F.lit(0))
        encoded = _let(F.struct(*constant), lambda tables: F.array_join(F.transform(words, word_ids(tables)), ""))
        return docs.withColumn(into, encoded).drop("__kept")

    def decode(self, ids: Column) -> Column:
        """The bytes of an array of ids."""
        return _let(self._pieces, lambda pieces: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "")))


def encode(docs: DataFrame, tokenizer: Tokenizer, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """All rows and columns of ``docs`` and the ids of the whole text, an array of ints.

    Null and empty texts have no ids. Rows are independent: repeated rows and clashing
    names elsewhere don't matter; an ``ids`` column of the input is replaced.
    """
    encoded = tokenizer.encode(docs, text_column, "__encoded")
    return encoded.withColumn(ids_column, ids_of(F.col("__encoded"))).drop("__encoded")


def ids_of(encoded: Column) -> Column:
    """The ids in the string that ``Tokenizer.encode`` gives."""
    split = F.split(F.rtrim(encoded, F.lit(",")), ",")
    return F.when(encoded == "", F.array().cast("array<int>")).otherwise(split.cast("array<int>"))
