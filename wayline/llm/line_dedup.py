"""Line dedup by pairwise alignment of passages, wherever in a line they begin or end.

The words of a text are one sequence. Runs of ``run_words - window + 1`` words are hashed,
and of every ``window`` runs in a row the one with the least hash is an anchor, so two
texts that share ``run_words`` words share an anchor, wherever it stands. Each
later document that holds an anchor is paired with the anchor's earliest holder, however
many hold it. Anchors go to buckets as packed hashes, so a hot one is some bytes a
document in one bucket. Each pair's texts are aligned by patience diff on their common
runs of ``run_words`` words; what the runs cover leaves the later document, and so do a few words that were
replaced one for one between two aligned runs. The earliest holder of a run never loses
it. A text that an earlier document has word for word loses everything and is not
paired at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import cut, free_name, giving_back, scaled_partitions, small
from .patience import align
from .words import _BASE, SPACES, mix, words_of

RUN_WORDS = 12  # least words of a common block that goes
WINDOW = 5  # of so many shorter runs in a row one is an anchor: passages of RUN_WORDS words have one
REPLACED_WORDS = 2  # so many words replaced by as many others don't part two blocks
PAIRS_EACH = 200  # of one earlier document in a join key
BUCKET_BYTES = 32_000_000  # of text, whose runs make a bucket
RUNS_AT_ONCE = 1_000_000  # are packed together
PAIRS_AT_ONCE = 100_000
ALL_WORDS = 2**31 - 1
HASH_BYTES = 6  # of a run's hash beside its bucket


def runs_of(words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of n words."""
    value, done, factor = words.hash.copy(), 1, int(_BASE)
    while done < n:
        by = min(done, n - done)
        if by < len(value):
            value[:-by] = value[:-by] * np.uint64(factor) + value[by:]
        done, factor = done + by, factor * int(_BASE) ** 2 % 2**64
    whole = np.arange(n, len(value) + n) <= words.bounds()[1:][words.text]
    return mix(value[whole]), words.text[whole]


def anchors_of(value: np.ndarray, text: np.ndarray, window: int) -> np.ndarray:
    """Places of the runs with the least hash of ``window`` in a row; all runs of a text that has fewer."""
    n = len(value)
    count = np.bincount(text, minlength=int(text[-1]) + 1 if n else 0)
    chosen = count[text] < window
    if n >= window:
        inside = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])
        least = np.lib.stride_tricks.sliding_window_view(value, window)[inside].argmin(axis=1)
        chosen[inside + least] = True
    return np.flatnonzero(chosen)


def _bucketed(rows: DataFrame, buckets: int, n: int, window: int) -> DataFrame:
    """``bucket, hash, which, docs``: of some texts the anchors that fall into a bucket, packed;
    ``which`` holds each anchor's place in ``docs``."""
    doc = T.StructType(rows.schema.fields[:2])
    schema = T.StructType([*T._parse_datatype_string("bucket int, hash binary, which binary").fields, T.StructField("docs", T.ArrayType(doc))])
    arrow = to_arrow_schema(schema)

    def packed(docs, value, text):
        bucket = (value % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
        order = np.argsort(bucket, kind="stable")
        bucket, text = bucket[order], text[order]
        value = (value[order] // np.uint64(buckets)).view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        out = []
        for low, high in zip(start, np.append(start[1:], len(bucket))):
            # The texts are in order within a bucket.
            fresh = np.append(True, text[low + 1 : high] != text[low : high - 1])
            which = np.cumsum(fresh) - 1
            which = which.astype(np.uint16 if which[-1] < 1 << 16 else np.uint32)
            out.append((int(bucket[low]), value[low:high].tobytes(), which.tobytes(), docs.take(pa.array(text[low:high][fresh]))))
        bounds = pa.array(np.cumsum([0, *(len(x[3]) for x in out)]), pa.int32())
        lists = pa.ListArray.from_arrays(bounds, pa.concat_arrays([x[3] for x in out]), type=arrow.field("docs").type)
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary()), lists], schema=arrow)

    def pack(batches):
        for batch in batches:
            docs = pa.StructArray.from_arrays(batch.columns[:2], fields=list(arrow.field("docs").type.value_type))
            values, texts, held = [], [], 0
            for words in words_of(batch.column(2), SPACES, lower=False):
                value, text = runs_of(words, n)
                at = anchors_of(value, text, window)
                value, text = value[at], text[at]
                values.append(value)
                texts.append(text + words.first)
                held += len(value)
                if held >= RUNS_AT_ONCE:
                    yield packed(docs, np.concatenate(values), np.concatenate(texts))
                    values, texts, held = [], [], 0
            if held:
                yield packed(docs, np.concatenate(values), np.concatenate(texts))

    return rows.mapInArrow(giving_back(pack), schema)


def _ranks(docs: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each document, equal for equal ones, and for each rank a place."""
    table = pa.table([docs.field(0), docs.field(1)], names=["id", "hash"])
    order = pc.sort_indices(table, sort_keys=[("id", "ascending"), ("hash", "ascending")])
    table = table.take(order)
    fresh = np.ones(len(order), bool)
    if len(order) > 1:
        a, b = table.slice(1), table.slice(0, len(order) - 1)
        fresh[1:] = pc.or_(pc.not_equal(a["id"], b["id"]), pc.not_equal(a["hash"], b["hash"])).to_numpy()
    order = order.to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(fresh) - 1
    return rank, order[fresh]


def _pairs(bucketed: DataFrame, parts: int) -> DataFrame:
    """``doc_id, text_hash, first_id, first_hash``: each document with the earliest holder of an anchor it has, once."""
    doc = bucketed.schema["docs"].dataType.elementType
    schema = T.StructType([*doc.fields, T.StructField("first_id", doc[0].dataType), T.StructField("first_hash", T.LongType())])
    arrow = to_arrow_schema(schema)
    packed = T.StructType([T.StructField("part", T.IntegerType()), *(T.StructField(f.name, T.ArrayType(f.dataType)) for f in schema)])
    packed_arrow = to_arrow_schema(packed)

    def meet(batches):
        # A task holds whole buckets.
        values, owners, docs, at = [], [], [], 0
        for batch in batches:
            for bucket, packed, which, own in zip(*batch.columns):
                packed = np.frombuffer(packed.as_buffer(), np.uint8).reshape(-1, HASH_BYTES)
                value = np.zeros((len(packed), 8), np.uint8)
                value[:, :HASH_BYTES] = packed
                which = which.as_buffer()
                which = np.frombuffer(which, np.uint16 if which.size == 2 * len(packed) else np.uint32)
                values.append(value.view(np.uint64).ravel() + (np.uint64(bucket.as_py() & 0xFFFF) << np.uint64(8 * HASH_BYTES)))
                owners.append(which.astype(np.int64) + at)
                docs.append(own.values)
                at += len(own.values)
        if not values:
            return
        docs = pa.concat_arrays(docs)
        rank, place = _ranks(docs)
        value, owner = np.concatenate(values), rank[np.concatenate(owners)]
        del values, owners
        order = np.argsort(value)
        value, owner = value[order], owner[order]
        start = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        first = np.repeat(np.minimum.reduceat(owner, start), np.diff(np.append(start, len(value))))
        later = owner > first
        met = np.unique(owner[later] * len(place) + first[later])
        if not len(met):
            return
        a, b = place[met // len(place)], place[met % len(place)]
        # Packed again by the later document, to drop what other buckets have found as well.
        part = (mix(docs.field(1).to_numpy(zero_copy_only=False)[a]) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, a, b = part[order], a[order], b[order]
        start = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        start = np.unique(np.concatenate([start, np.arange(0, len(part), PAIRS_AT_ONCE)]))
        bounds = pa.array(np.append(start, len(part)), pa.int32())
        columns = [column for side in (docs.take(pa.array(a)), docs.take(pa.array(b))) for column in (side.field(0), side.field(1))]
        lists = [pa.ListArray.from_arrays(bounds, column, type=packed_arrow.field(i + 1).type) for i, column in enumerate(columns)]
        yield pa.RecordBatch.from_arrays([pa.array(part[start]), *lists], schema=packed_arrow)

    def once(batches):
        found = [[column.flatten() for column in batch.columns[1:]] for batch in batches]
        if found:
            table = pa.table([pa.chunked_array(x) for x in zip(*found)], names=arrow.names)
            yield from table.group_by(arrow.names, use_threads=False).aggregate([]).select(arrow.names).cast(arrow).to_batches(50_000)

    return bucketed.mapInArrow(giving_back(meet), packed).repartition(parts, "part").mapInArrow(giving_back(once), schema)


def copied_texts(rows: DataFrame) -> DataFrame:
    """``hash, crc, bytes, first_id`` of each text that several ids hold, with the smallest of them."""
    texts = rows.where(F.col("doc_id").isNotNull() & (F.col("text") != "")).groupBy(*text_key()).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    return texts.where("first_id < last_id").drop("last_id")


def text_key() -> list:
    return [F.xxhash64("text").alias("hash"), F.crc32(F.col("text").cast("binary")).alias("crc"), F.octet_length("text").alias("bytes")]


def duplicate_passages(docs: DataFrame, copied: DataFrame, run_words: int = RUN_WORDS, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_hash, places``: the words (from 0) that go, as sorted spans ``first, end``,
    for documents that lose any and aren't later copies of a text in ``copied``.

    Words are runs of other characters than ASCII white space, compared as they are. What
    goes are runs of ``run_words`` words that an earlier document holds. Every passage of that
    length meets an anchor; a document is paired with the earliest holder of each of its
    anchors, so of a longer passage that this one holds in part the rest may stay. Rows with the same id and text are one
    document; the order of documents is by id and then a hash of the text. Null ids
    and null or empty texts take no part.
    """
    rows = docs.where(F.col("doc_id").isNotNull() & (F.col("text") != "")).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    rows = rows.join(copied, [a == b for a, b in zip(text_key(), (copied["hash"], copied["crc"], copied["bytes"]))] + [rows["doc_id"] > copied["first_id"]], "left_anti")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = scaled_partitions(docs.sparkSession, size, BUCKET_BYTES)
    pairs = cut(_pairs(_bucketed(rows, buckets, run_words - window + 1, window).repartition(buckets, "bucket"), buckets))

    # Texts are read where the documents are, if the pairs are few, and meet at the earlier one's; one
    # that many later documents follow goes out in copies, so its pairs fall to many tasks.
    followed = cut(pairs.groupBy("first_id", "first_hash").agg(F.ceil(F.count("*") / PAIRS_EACH).cast("int").alias("copies")))
    hot = small(followed.where("copies > 1"))
    dealt = pairs.join(hot, ["first_id", "first_hash"], "left").withColumn("copy", F.pmod(F.xxhash64("doc_id", "text_hash"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
    later = rows.join(small(cut(dealt)), ["doc_id", "text_hash"]).select(F.struct("doc_id", "text_hash").alias("doc"), "first_id", "first_hash", "copy", F.col("text").alias("own"))
    earlier = rows.withColumnsRenamed({"doc_id": "first_id", "text_hash": "first_hash", "text": "earlier"}).join(small(followed), ["first_id", "first_hash"])
    earlier = earlier.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    both = later.join(earlier, ["first_id", "first_hash", "copy"])

    def blocks(batches):
        for batch in batches:
            # A few pairs at a time, as texts may be long.
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                # One earlier document's pairs stand together.
                other = part.column(2).dictionary_encode()
                own, runs = _runs_of_each(part.column(1), run_words), _runs_of_each(other.dictionary, run_words)
                other = [runs[k] for k in other.indices.to_pylist()]
                gone = [[{"first": a, "end": b} for a, b in common_blocks(x, y, run_words)] for x, y in zip(own, other)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(gone, spans)], names=["doc", "places"])

    span = T._parse_datatype_string("array<struct<first:int,end:int>>")
    found_type = T.StructType([T.StructField("doc", later.schema["doc"].dataType), T.StructField("places", span)])
    spans = to_arrow_schema(found_type).field("places").type
    found = both.select("doc", "own", "earlier").mapInArrow(giving_back(blocks), found_type)
    places = found.groupBy("doc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))
    return places.select("doc.doc_id", "doc.text_hash", "places").where(F.size("places") > 0)


def _runs_of_each(column: pa.Array, n: int) -> list[np.ndarray]:
    """The hashes of each text's runs, in order."""
    found = [np.zeros(0, np.uint64)] * len(column)
    for words in words_of(column, SPACES, lower=False):
        value, text = runs_of(words, n)
        bounds = np.searchsorted(text, np.arange(words.texts + 1))
        for t in range(words.texts):
            found[words.first + t] = value[bounds[t] : bounds[t + 1]]
    return found


def common_blocks(own: np.ndarray, earlier: np.ndarray, n: int, replaced: int = REPLACED_WORDS) -> list[tuple[int, int]]:
    """Spans of words of ``own``, given by its runs of n words, that runs of ``earlier`` cover,
    with the words replaced between two runs that are aligned at the same distance."""
    at, there = np.flatnonzero(np.isin(own, earlier)), np.flatnonzero(np.isin(earlier, own))
    spans = [(i, i + n) for i in at.tolist()]
    # Aligned runs say what was replaced; runs in another order are covered all the same.
    pairs = [(int(at[i]), int(there[j])) for i, j in align(own[at].tolist(), earlier[there].tolist())]
    for (i, j), (k, m) in zip(pairs, pairs[1:]):
        if k - i == m - j and n < k - i <= n + replaced:
            spans.append((i, k))
    return merged(spans)


def merged(spans) -> list[tuple[int, int]]:
    """The union of spans, as sorted spans apart from each other."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def without(data: bytes, start: np.ndarray, end: np.ndarray, spans) -> bytes:
    """A text without spans of its words, which start and end at these bytes. A line that loses all
    its words goes, with its line feed; inside a line the blanks on one side stay."""
    out, at, n = [], 0, len(start)
    for a, b in spans:
        before = int(end[a - 1]) if a else 0
        after = int(start[b]) if b < n else len(data)
        feed, next_feed = data.rfind(b"\n", before, int(start[a])), data.find(b"\n", int(end[b - 1]), after)
        opens, closes = a == 0 or feed >= 0, b == n or next_feed >= 0
        low, high = int(start[a]), after
        if opens and closes:
            low = feed + 1 if feed >= 0 else 0
            high = next_feed + 1 if next_feed >= 0 else len(data)
            if next_feed < 0 and low:
                low -= 1
        elif closes:
            low, high = before, next_feed if next_feed >= 0 else len(data)
        out.append(data[at : max(at, low)])
        at = max(at, high)
    return b"".join([*out, data[at:]])


def dedup_lines(docs: DataFrame, run_words: int = RUN_WORDS, window: int = WINDOW, removed: str = "removed") -> DataFrame:
    """All rows and columns of ``docs``, with ``text`` without its duplicate passages, and as ``removed``
    the spans ``first, end`` of the words that went (empty if none). A text that lost all its words is
    empty, as is a later copy of a whole text of ``run_words`` words or more. Rows with a null id or
    text stay as they are, and so do rows that repeat one id and text."""
    copied = small(cut(copied_texts(docs)))
    gone = duplicate_passages(docs, copied, run_words, window).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("places").alias("__places"))
    firsts = copied.select(*(F.col(c).alias(f"__copy_{c}") for c in copied.columns))
    marked = docs.join(firsts, [a == b for a, b in zip(text_key(), (F.col("__copy_hash"), F.col("__copy_crc"), F.col("__copy_bytes")))] + [docs["doc_id"] > F.col("__copy_first_id")], "left")
    joined = marked.join(small(cut(gone)), (docs["doc_id"] == F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash")), "left")
    others = [docs[c] for c in docs.columns if c != "text"]
    everything = F.when(F.col("__copy_hash").isNotNull(), F.array(F.struct(F.lit(0).alias("first"), F.lit(ALL_WORDS).alias("end"))))
    source = joined.select(*others, docs["text"].alias(free_name(docs.columns, "__text")), F.coalesce(everything, "__places").alias(free_name(docs.columns, "__places")))
    schema = T.StructType([*(docs.schema[c] for c in docs.columns if c != "text"), T.StructField("text", docs.schema["text"].dataType), T.StructField(removed, gone.schema["__places"].dataType)])
    arrow = to_arrow_schema(schema)

    def strip(batches):
        for batch in batches:
            texts, places = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            hit = np.flatnonzero(places.is_valid().to_numpy(zero_copy_only=False))
            kept: dict[int, str] = {}
            went: list[list] = [[] for _ in range(batch.num_rows)]
            chosen = texts.take(pa.array(hit, pa.int64()))
            for words in words_of(chosen, SPACES, lower=False):
                bounds = words.bounds()
                for t in range(words.texts):
                    row = int(hit[words.first + t])
                    low, high, begin = int(bounds[t]), int(bounds[t + 1]), int(words.offsets[t])
                    spans = merged((x["first"], min(x["end"], high - low)) for x in places[row].as_py())
                    if places[row][0]["end"].as_py() == ALL_WORDS and high - low < run_words:
                        spans = []
                    data = words.data[begin : int(words.offsets[t + 1])].tobytes()
                    kept[row] = without(data, words.start[low:high] - begin, words.end[low:high] - begin, spans).decode()
                    went[row] = [{"first": a, "end": b} for a, b in spans]
            if kept:
                flat = texts.to_pylist()
                for row, text in kept.items():
                    flat[row] = text
                texts = pa.array(flat, arrow.field("text").type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], texts.cast(arrow.field("text").type), pa.array(went, arrow.field(removed).type)], schema=arrow)

    return source.mapInArrow(giving_back(strip), schema).select(*docs.columns, removed)
