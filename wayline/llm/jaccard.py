"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles. Each shingle flips one bit of a
sketch, so the Hamming distance of two sketches is at most the size of the sets'
symmetric difference. For a threshold t, linked sets of a size band differ in at
most d = (1 - t) / (1 + t) * (|A| + |B|) shingles. The sketch is cut into d + 1 + e
pieces; two linked documents share at least 1 + e of them. A piece without a bit
says nothing and is not joined on: with at most e such pieces in one of two linked
documents they still share one that has bits. A document with more of them joins under
another seed besides, and under the last one on all its pieces, so no link is lost.
Candidates whose short sketches are too far apart are dropped, the others are verified
on their whole sets.

Copies with equal sets are one class from the start. Keys go to buckets as packed
hashes. A key that many classes share is not expanded into pairs: every class is first
held against the smallest of its keys' first classes, then only pairs of classes that
are still in different components are, so a large group of near copies costs a pair or
two per member.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from .common import cut, giving_back, scaled_partitions, small
from .words import distinct, mix, shingles, words_of

SKETCH_WORDS = 16  # of 64 bits: the short sketch that candidates are filtered by
PIECE_BITS = 1 << 20  # bits of the long sketch in each piece
SEEDS = 6  # after so many a document joins on its empty pieces too
BUCKET_BYTES = 32_000_000  # of text, whose keys make a bucket
KEYS_AT_ONCE = 1_000_000  # are packed together
MEMBERS_EACH = 1000  # of a key in a row
SMALL = 160  # of a key with so many classes all pairs in different components are looked at in one round
PIVOTS = 64  # of a larger one so many classes in its first round, and PIVOT_GROWTH times as many in each later one
PIVOT_GROWTH = 4
BLOCK_CLASSES = 4_096  # of a key, which meet its pivots in one task
PIVOTS_AT_ONCE = 64
PART_CLASSES = 20_000  # of all keys to a task


def size_bands(threshold: Fraction, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The band of each size; for each band the pieces, and how many of them may be empty.

    Bands grow by 1 / threshold, so linked sizes lie in one band or in two that adjoin.
    A band's pieces serve its own sizes and those of the next band. A band in which only
    equal sets link has no pieces.
    """
    bounds = [1]
    top = int(size.max(initial=1))
    while len(bounds) < 3 or bounds[-2] <= top:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] / threshold) + 1))
    band = np.searchsorted(bounds, size, side="right") - 1
    # Of a pair that meets in band b the smaller has less than bounds[b + 1] shingles.
    smaller = [x - 1 for x in bounds[1:]]
    differ = np.array([int((s + int(s / threshold)) * (1 - threshold) / (1 + threshold)) for s in smaller])
    # Shingles for each piece in the band's smallest sets: the more, the fewer empty pieces.
    each = np.array(bounds[:-1]) / ((differ + 1) * 1.1)
    spare = np.ceil((differ + 1) * 1.8 * np.exp(-each) + 1).astype(np.int64)
    return band, np.where(differ > 0, differ + 1 + spare, 0), spare


def linked(common: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Whether |A ∩ B| reaches the threshold of |A ∪ B|, in whole numbers."""
    return common * threshold.denominator >= (a + b - common) * threshold.numerator


def _sets(column: pa.Array, n: int):
    """(first text, texts, hashes, text of each hash) of the distinct shingles, in chunks."""
    for words in words_of(column):
        hashes, texts = distinct(*shingles(words, n))
        yield words.first, words.texts, hashes, texts


def _set_hashes(hashes: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the sets, and a hash of each (0 for an empty one)."""
    size = np.bincount(text, minlength=texts)
    found = np.zeros(texts, np.uint64)
    some = size > 0
    if len(hashes):
        start = (np.cumsum(size) - size)[some]
        a, b = (np.add.reduceat(mix(hashes + np.uint64(k)), start) for k in (1, 2))
        found[some] = mix(mix(a) + mix(b ^ size[some].astype(np.uint64)))
    return size, found.view(np.int64)


def describe(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class, sketch`` of every row: ``class`` is a hash of the
    set, ``sketch`` the short sketch (null for an empty set)."""

    def run(batches):
        bits = SKETCH_WORDS * 64
        for batch in batches:
            count, classes, sketch = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            for _, texts, hashes, text in _sets(batch.column(2), n):
                size, own = _set_hashes(hashes, text, texts)
                flips = np.bincount(text * bits + (hashes % np.uint64(bits)).astype(np.int64), minlength=texts * bits)
                packed = np.packbits((flips & 1).astype(bool).reshape(texts, -1), axis=1).view(np.int64)
                count.append(size), classes.append(own)
                sketch += [x if k else None for x, k in zip(packed, size)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.concatenate(count)), pa.array(np.concatenate(classes)), pa.array(sketch, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "n_shingles", "class", "sketch"])

    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return source.mapInArrow(giving_back(run), T.StructType([*source.schema.fields[:2], *T._parse_datatype_string("n_shingles long, class long, sketch array<long>").fields]))


def piece_keys(hashes: np.ndarray, text: np.ndarray, texts: int, threshold: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, lower) for the pieces that each set joins on, in its band and, ``lower``, in the one below."""
    size = np.bincount(text, minlength=texts)
    band, pieces, spare = size_bands(threshold, size)
    owners, keys, lowers = [], [], []
    for lower in (0, 1):
        own_band = band - lower
        wanted = np.where((own_band >= 0) & (size > 0), pieces[np.maximum(own_band, 0)], 0)
        for seed in range(SEEDS):
            if not wanted.any():
                break
            offset = np.cumsum(wanted) - wanted
            use = wanted[text] > 0
            h, t = hashes[use], text[use]
            piece = offset[t] + (mix(h + np.uint64(0x51 + 16 * seed)) % wanted[t].astype(np.uint64)).astype(np.int64)
            bit = mix(h + np.uint64(0x52 + 16 * seed)) % np.uint64(PIECE_BITS)
            order = np.argsort(piece, kind="stable")
            start = np.flatnonzero(np.append(True, np.diff(piece[order]) > 0))
            # The exclusive or of the bits' hashes: a bit that is flipped twice is off again.
            bits = np.zeros(int(wanted.sum()), np.uint64)
            bits[piece[order][start]] = np.bitwise_xor.reduceat(mix(bit + np.uint64(0x53))[order], start)
            owner = np.repeat(np.arange(texts), wanted)
            empty = bits == 0
            over = np.bincount(owner[empty], minlength=texts) > spare[np.maximum(own_band, 0)]
            joins = ~empty | over[owner] if seed == SEEDS - 1 else ~empty
            place = np.arange(len(bits)) - offset[owner]
            key = mix(mix(bits + place.astype(np.uint64)) + (own_band[owner] * SEEDS + seed).astype(np.uint64))
            owners.append(owner[joins])
            keys.append(key[joins])
            lowers.append(np.full(int(joins.sum()), lower, np.uint8))
            wanted = np.where(over, wanted, 0)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    return np.concatenate(owners), np.concatenate(keys), np.concatenate(lowers)


def _packed_keys(docs: DataFrame, n: int, threshold: Fraction, buckets: int) -> DataFrame:
    """``bucket, hash, which, classes``: keys that fall into a bucket, four bytes each, with twice their
    class's place in ``classes`` and whether they are of the lower band. A task emits the keys
    of a class once, however many copies it reads."""
    schema = T._parse_datatype_string("bucket int, hash binary, which binary, classes array<long>")
    arrow = to_arrow_schema(schema)

    def packed(classes, key, lower):
        bucket = key % np.uint64(buckets)
        order = np.lexsort((classes, bucket))
        bucket, classes, lower = bucket[order], classes[order], lower[order]
        value = (key[order] // np.uint64(buckets)).astype(np.uint32)
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        out = []
        for low, high in zip(start, np.append(start[1:], len(bucket))):
            fresh = np.append(True, classes[low + 1 : high] != classes[low : high - 1])
            which = (np.cumsum(fresh) - 1) * 2 + lower[low:high]
            which = which.astype(np.uint16 if which[-1] < (1 << 16) - 1 else np.uint32)
            out.append((int(bucket[low]), value[low:high].tobytes(), which.tobytes(), classes[low:high][fresh]))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x[3]) for x in out)]), pa.int32()), pa.array(np.concatenate([x[3] for x in out])))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), *(pa.array([x[i] for x in out], pa.binary()) for i in (1, 2)), lists.cast(arrow.field("classes").type)], schema=arrow)

    def pack(batches):
        seen: set[int] = set()
        parts, held = [], 0
        for batch in batches:
            for _, texts, hashes, text in _sets(batch.column(0), n):
                _, own = _set_hashes(hashes, text, texts)
                fresh = np.zeros(texts, bool)
                for i, c in enumerate(own.tolist()):
                    if c not in seen:
                        seen.add(c)
                        fresh[i] = True
                use = fresh[text]
                owner, key, lower = piece_keys(hashes[use], text[use], texts, threshold)
                parts.append((own[owner], key, lower))
                held += len(key)
                if held >= KEYS_AT_ONCE:
                    yield packed(*map(np.concatenate, zip(*parts)))
                    parts, held = [], 0
        if held:
            yield packed(*map(np.concatenate, zip(*parts)))

    return docs.select("text").mapInArrow(giving_back(pack), schema)


def _shared_keys(packed: DataFrame) -> DataFrame:
    """Of the keys that several classes share: rows ``a, b``, each class and the smallest of its keys' first
    classes, and rows ``a, classes``, a key and (up to MEMBERS_EACH of) its classes. A task holds whole buckets."""
    schema = T._parse_datatype_string("a long, b long, classes array<long>")
    arrow = to_arrow_schema(schema)

    def meet(batches):
        values, owners, lowers, classes, at = [], [], [], [], 0
        for batch in batches:
            for bucket, value, which, own in zip(*batch.columns):
                value = np.frombuffer(value.as_buffer(), np.uint32)
                which = which.as_buffer()
                which = np.frombuffer(which, np.uint16 if which.size == 2 * len(value) else np.uint32).astype(np.int64)
                values.append(value.astype(np.uint64) | np.uint64(bucket.as_py() << 32))
                owners.append((which >> 1) + at)
                lowers.append((which & 1).astype(np.uint8))
                classes.append(own.values.to_numpy(zero_copy_only=False))
                at += len(own.values)
        if not values:
            return
        value, lower = np.concatenate(values), np.concatenate(lowers)
        own = np.concatenate(classes)[np.concatenate(owners)]
        del values, owners, lowers
        order = np.lexsort((lower, own, value))
        value, own, lower = value[order], own[order], lower[order]
        fresh = np.append(True, (value[1:] != value[:-1]) | (own[1:] != own[:-1]))
        value, own, lower = value[fresh], own[fresh], lower[fresh]
        start = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        count = np.diff(np.append(start, len(value)))
        # Two of the lower band meet in their own band as well.
        several = (count > 1) & (np.minimum.reduceat(lower, start) == 0)
        pivot = np.minimum.reduceat(np.where(lower == 0, own, np.iinfo(np.int64).max), start)
        keep = np.repeat(several, count)
        pivot = np.repeat(pivot, count)[keep]
        value, own = value[keep].view(np.int64), own[keep]
        if not len(own):
            return
        # Of each class the smallest pivot.
        away = own != pivot
        order = np.lexsort((pivot[away], own[away]))
        a, b = own[away][order], pivot[away][order]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        for low in range(0, len(first), 50_000):
            part = first[low : low + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(a[part]), pa.array(b[part]), pa.nulls(len(part), arrow.field("classes").type)], schema=arrow)
        start = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        place = np.arange(len(value)) - np.repeat(start, np.diff(np.append(start, len(value))))
        start = np.flatnonzero(place % MEMBERS_EACH == 0)
        ends = np.append(start[1:], len(value))
        for low in range(0, len(start), 20_000):
            s, e = start[low : low + 20_000], ends[low : low + 20_000]
            lists = pa.ListArray.from_arrays(pa.array(np.append(s, e[-1]) - s[0], pa.int32()), pa.array(own[s[0] : e[-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(value[s]), pa.nulls(len(s), pa.int64()), lists.cast(arrow.field("classes").type)], schema=arrow)

    return packed.mapInArrow(giving_back(meet), schema)


def _verified(pairs: DataFrame, docs: DataFrame, heads: DataFrame, unique: bool, n: int, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets are linked; ``heads`` (class, doc_id, text_hash) says where a class's text is."""

    def run(batches):
        for batch in batches:
            sides = []
            for i in (2, 3):
                sets: list[np.ndarray] = [np.zeros(0, np.uint64)] * batch.num_rows
                for first, count, hashes, text in _sets(batch.column(i), n):
                    bounds = np.searchsorted(text, np.arange(count + 1))
                    for t in range(count):
                        sets[first + t] = hashes[bounds[t] : bounds[t + 1]]
                sides.append(sets)
            common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides)], np.int64)
            size = [np.array([len(x) for x in s], np.int64) for s in sides]
            good = pa.array(linked(common, size[0], size[1], threshold) & (size[0] > 0))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    def texts_of(wanted: DataFrame, side: str) -> DataFrame:
        """``wanted`` (class as ``side``, maybe more) with the text; read where the documents are, if few are wanted."""
        where = wanted.join(heads.select(F.col("class").alias(side), F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")), side)
        rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").alias(f"text_{side}"))
        found = rows.join(small(cut(where)), (F.col("doc_id") == F.col("__id")) & (F.col("text_hash") == F.col("__hash"))).select(*wanted.columns, f"text_{side}")
        return found if unique else found.dropDuplicates(wanted.columns)

    both = texts_of(pairs.select("a", "b"), "a").join(texts_of(pairs.select("b").distinct(), "b"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(giving_back(run), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``class, component``: the smallest class reachable over the edges (a, b), for the classes on edges.

    Large-star and small-star steps in turn: every class points its larger, then its
    smaller neighbours at the smallest it knows, until only stars are left.
    """
    pairs = cut(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct())
    while True:
        ends = pairs.select(F.col("hi").alias("u"), F.lit(1).alias("hi"), F.lit(0).alias("lo")).unionByName(pairs.select(F.col("lo").alias("u"), F.lit(0).alias("hi"), F.lit(1).alias("lo")))
        if ends.groupBy("u").agg(F.sum("hi").alias("hi"), F.max("lo").alias("lo")).where("hi > 1 or hi = 1 and lo = 1").isEmpty():
            return pairs.select(F.col("hi").alias("class"), F.col("lo").alias("component"))
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.least("m", "u").alias("lo")).distinct()
        least = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = large.select(F.col("hi").alias("u"), F.col("lo").alias("v")).join(least, "u")
        pairs = small.select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionByName(least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
        pairs = cut(pairs.where("hi <> lo").distinct())


def _near(a: str, b: str, t: Fraction) -> Column:
    """Whether the sizes n<a> and n<b> and the short sketches s<a> and s<b> allow a link."""
    far = sum((F.bit_count(F.get(f"s{a}", F.lit(i)).bitwiseXOR(F.get(f"s{b}", F.lit(i)))) for i in range(SKETCH_WORDS)), F.lit(0))
    total = F.col(f"n{a}") + F.col(f"n{b}")
    sizes = F.least(f"n{a}", f"n{b}") * t.denominator >= F.greatest(f"n{a}", f"n{b}") * t.numerator
    return sizes & (far * (t.denominator + t.numerator) <= total * (t.denominator - t.numerator))


def _close_in_keys(own: DataFrame, rows: int, t: Fraction) -> DataFrame:
    """``a, b``: of each key the pivots with the classes after them (by rank) in other components, as far as sizes and short
    sketches allow a link. Pairs are looked at in blocks of classes inside a task; only those that may link leave it."""
    blocks = F.ceil(F.col("size") / BLOCK_CLASSES).cast("int")
    at = F.floor((F.col("rank") - 1) / BLOCK_CLASSES).cast("int")
    dealt = own.select("key", "class", "component", "rank", "pivot", "n", "s", at.alias("at"), F.explode(F.when(F.col("pivot"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(at))).alias("block"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("key", "block"), F.lit(scaled_partitions(own.sparkSession, rows, PART_CLASSES))).cast("int"))

    def close(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("block", "ascending"), ("rank", "ascending")])
        key, block, at, rank, component, n, name = (group[c].to_numpy() for c in ("key", "block", "at", "rank", "component", "n", "class"))
        pivot = group["pivot"].to_numpy(zero_copy_only=False).astype(bool)
        sketch = group["s"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(group.num_rows, SKETCH_WORDS)
        start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (block[1:] != block[:-1]))) if len(key) else []
        found = [np.zeros((2, 0), np.int64)]
        for low, high in zip(start, np.append(start[1:], len(key))):
            own = np.arange(low, high)
            after = own[at[own] == block[low]]
            pivots = own[pivot[own]]
            for i in range(0, len(pivots), PIVOTS_AT_ONCE):
                some = pivots[i : i + PIVOTS_AT_ONCE]
                a, b = np.nonzero((rank[some][:, None] < rank[after]) & (component[some][:, None] != component[after]))
                a, b = some[a], after[b]
                least, most = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
                sizes = least * t.denominator >= most * t.numerator
                a, b = a[sizes], b[sizes]
                far = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
                near = far * (t.denominator + t.numerator) <= (n[a] + n[b]) * (t.denominator - t.numerator)
                found.append(np.sort([name[a[near]], name[b[near]]], axis=0))
        a, b = np.concatenate(found, axis=1)
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("part").applyInArrow(close, "a long, b long")


def similarity_classes(docs: DataFrame, n: int = 5, threshold: str = "0.8") -> DataFrame:
    """``doc_id, text_hash, n_shingles, class_id, n_verified, component_id`` of every row.

    ``class_id`` is the smallest id with the same shingle set and ``component_id`` the
    smallest id reachable by links. ``n_verified`` counts the other classes that this row's
    class was verified to link with on the way: one at least if it links with any, but
    not all of a group's links, as classes that are in one component already aren't
    held against each other. Words are runs of other characters than ASCII white space,
    A-Z lower-cased; a document with fewer than n words has one shingle of all of them.
    Null and empty texts have none and link with nothing. Repeated rows are copies like
    any other; rows of a null id stand alone.
    """
    t = Fraction(threshold)
    described = cut(describe(docs, n))
    usable = described.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = usable.groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("head"), F.first("n_shingles").alias("n"), F.first("sketch").alias("s"))
    classes = cut(classes.select("class", F.col("head.doc_id").alias("doc_id"), F.col("head.text_hash").alias("text_hash"), "n", "s"))
    unique = usable.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    heads, facts = classes.select("class", "doc_id", "text_hash"), classes.select("class", "n", "s")

    def close_ones(pairs: DataFrame) -> DataFrame:
        for x in "ab":
            pairs = pairs.join(facts.select(F.col("class").alias(x), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}")), x)
        return pairs.where(_near("a", "b", t)).select("a", "b")

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = scaled_partitions(docs.sparkSession, size, BUCKET_BYTES)
    shared = cut(_shared_keys(_packed_keys(docs.where("doc_id is not null"), n, t, buckets).repartition(buckets, "bucket")))

    # One pair for each class that shares a key with another.
    stars = shared.where("classes is null").groupBy("a").agg(F.min("b").alias("b"))
    tested = cut(close_ones(stars))
    edges = cut(_verified(tested, docs, heads, unique, n, t))
    label = components(edges)

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(small(label), "class", "left").withColumn("component", F.coalesce("component", "class"))

    # Keys whose classes are in several components; a key's rows stand together, so the first sums are local.
    members = labelled(shared.where("classes is not null").select(F.col("a").alias("key"), F.explode("classes").alias("class")))
    mixed = cut(members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key"))
    keys = cut(members.join(small(mixed), "key", "left_semi").select("key", "class"))
    in_key, pivots = Window.partitionBy("key"), PIVOTS
    while not keys.isEmpty():
        own = labelled(keys)
        own = own.withColumn("size", F.count("*").over(in_key)).withColumn("peers", F.count("*").over(Window.partitionBy("key", "component"))).where("peers < size")
        own = own.withColumn("rank", F.row_number().over(in_key.orderBy("peers", "component", "class")))
        most = F.when(F.col("size") <= SMALL, F.col("size")).otherwise(pivots)
        pivots *= PIVOT_GROWTH
        own = cut(own.withColumn("pivot", F.col("rank") <= most).select("key", "class", "component", "size", "rank", "pivot"))
        known = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        close = cut(_close_in_keys(own.join(facts, "class"), own.count(), t).distinct().join(known, ["a", "b"], "left_anti"))
        # A pivot is done with its key.
        keys = cut(own.where((F.col("size") > SMALL) & ~F.col("pivot")).select("key", "class"))
        if close.isEmpty():
            continue
        tested = tested.unionByName(close)
        new = cut(_verified(close, docs, heads, unique, n, t))
        if new.isEmpty():
            continue
        edges = edges.unionByName(new)
        # The new links join whole components.
        for x in "ab":
            new = new.join(label.select(F.col("class").alias(x), F.col("component").alias(f"c{x}")), x, "left").withColumn(f"c{x}", F.coalesce(f"c{x}", x))
        new = cut(new)
        roots = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        known = label.unionByName(new.select(F.explode(F.array("ca", "cb")).alias("class")).distinct().withColumn("component", F.col("class")))
        merged = known.groupBy("class").agg(F.min("component").alias("component")).join(roots.select(F.col("class").alias("component"), F.col("component").alias("root")), "component", "left")
        label = cut(merged.select("class", F.coalesce("root", "component").alias("component")))
    ends = edges.select(F.col("a").alias("class")).unionByName(edges.select(F.col("b").alias("class")))
    degrees = ends.groupBy("class").agg(F.count("*").alias("n_verified"))
    named = labelled(classes.select("class", F.col("doc_id").alias("class_id")))
    smallest = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = named.join(smallest, "component").join(degrees, "class", "left").select("class", "class_id", F.coalesce("n_verified", F.lit(0)).alias("n_verified"), "component_id")
    takes = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    result = described.withColumn("class", F.when(takes, F.col("class"))).join(named, "class", "left")
    return result.select("doc_id", "text_hash", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_verified", F.lit(0)).alias("n_verified"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, n: int = 5, threshold: str = "0.8") -> DataFrame:
    """The rows and columns of ``docs``, of each component of links only the smallest id.

    Of one id's texts in a component the one with the smallest hash stays, and of rows
    with the same id and text any one. Rows without words or with a null id all stay.
    """
    found = cut(similarity_classes(docs, n, threshold).where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).select("doc_id", "text_hash", "component_id"))
    least = found.where("doc_id = component_id").groupBy("doc_id").agg(F.min("text_hash").alias("least"), F.max("text_hash").alias("most"))
    others = found.join(least.where("least <> most"), "doc_id").where("text_hash <> least").select("doc_id", "text_hash")
    gone = found.where("doc_id <> component_id").select("doc_id", "text_hash").unionByName(others).distinct()
    gone = small(cut(gone.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))))
    kept = docs.join(gone, (docs["doc_id"] == gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__hash"]), "left_anti")
    again = found.groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash")
    if again.isEmpty():
        return kept
    marked = kept.join(again.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.lit(True).alias("__again")), (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left").drop("__id", "__hash")
    repeated = marked.where("__again").dropDuplicates(["doc_id", "text"])
    return marked.where("__again is null").unionByName(repeated).drop("__again")
