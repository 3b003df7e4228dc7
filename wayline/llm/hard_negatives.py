"""Hard-negative mining over one-bit codes of rotated vectors.

Every vector is rotated by one fixed orthogonal matrix and keeps the signs of its components
as a code of as many bits, its length, and its alignment: its product with the unit vector
that the signs stand for. An anchor's rotated components are cut to ``PLANES`` bits, so that
bit counts of code and planes give its product with that unit vector up to a known error. What
of a vector its code does not hold is at right angles to the code vector; by Cauchy-Schwarz it
adds at most its length times the rest of the anchor's. So every score lies in an interval that
holds always, not only likely. Rows whose interval cannot matter are dropped and the others
scored in whole numbers, the most promising first, until nothing left can matter.

Rows are dealt into shards and anchors into blocks; a task holds one of each.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import finite, floors, giving_back, stored

SHARD_ROWS, LEAST_SHARD_ROWS, BLOCK_ANCHORS = 65_536, 2_048, 16_384
PLANES = 6
STEP = 256  # rows scored at once
_EXACT = 2.0**53
_ROW = "vec_id long, label long, width int, copies long, embedding array<{kind}>, code binary, alignment double, length double"


@lru_cache(maxsize=4)
def rotation(width: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(width).standard_normal((width, width)))[0]


def bits_of(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words, the last filled up with zeros."""
    packed = np.packbits(flags, axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view("<u8")


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, alignment and length of each vector."""
    turned = vectors @ rotation(vectors.shape[1])
    return bits_of(turned >= 0), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1]), np.sqrt((vectors**2).sum(axis=1))


class Anchor:
    """One anchor's intervals for its scores with coded rows."""

    def __init__(self, vector: np.ndarray):
        self.width = len(vector)
        turned = vector @ rotation(self.width)
        self.low = turned.min()
        self.step = (turned.max() - self.low) / (2**PLANES - 1) or 1.0
        level = np.rint((turned - self.low) / self.step).astype(np.int64)
        self.planes = [bits_of((level >> j & 1).astype(bool)[None])[0] for j in range(PLANES)]
        cut = self.low + self.step * level
        self.total, self.error = cut.sum(), np.sqrt(((turned - cut) ** 2).sum())
        self.square = (vector**2).sum()

    def intervals(self, codes: np.ndarray, alignment: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = lambda x: np.bitwise_count(x).sum(axis=1, dtype=np.int64)
        ones = self.low * count(codes) + self.step * sum(count(codes & plane) << j for j, plane in enumerate(self.planes))
        along = (2 * ones - self.total) / np.sqrt(self.width)
        beside = np.sqrt(np.maximum(self.square - np.maximum(np.abs(along) - self.error, 0.0) ** 2, 0.0))
        rest = np.sqrt(np.maximum(length**2 - alignment**2, 0.0) + 1e-12 * length**2)
        # Rounding is far below a billionth of the product of both lengths.
        half = alignment * self.error + rest * beside + 1e-9 * (np.sqrt(self.square) * length + 1.0)
        return alignment * along - half, alignment * along + half


def exact_scores(points: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as float64; one that doesn't fit 64 bits is an error."""
    if np.abs(points).max(initial=0.0) * np.abs(vector).max(initial=0.0) * len(vector) < _EXACT:
        return (points @ vector).astype(np.int64)
    whole = [int(x) for x in vector]
    found = [sum(int(x) * y for x, y in zip(row, whole)) for row in points]
    if any(not -(2**63) <= v < 2**63 for v in found):
        raise ValueError("an inner product does not fit 64 bits")
    return np.array(found, np.int64)


def best_in_bands(low, high, score, bands: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores among which are the k best, ties included, of every band (least, most) of whole scores.

    ``low`` and ``high`` bound each row's score; ``score`` gives the exact ones of some rows.
    Rows come in the order of their upper bound until the next one is under what every band needs.
    """
    bands = [band for band in bands if band[0] <= band[1]]
    able = np.zeros(len(low), bool)
    for least, most in bands:
        able |= ~((high < least) | (low > most))
    rows = np.flatnonzero(able)
    rows = rows[np.argsort(-high[rows], kind="stable")]
    taken, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    best = [np.zeros(0, np.int64) for _ in bands]
    for at in range(0, len(rows), STEP):
        # A band with k rows needs their worst score, any other its least.
        needed = min(int(own[-1]) if len(own) >= k else least for own, (least, _) in zip(best, bands))
        if high[rows[at]] < needed:
            break
        some = rows[at : at + STEP]
        found = score(some)
        fits = np.zeros(len(found), bool)
        for i, (least, most) in enumerate(bands):
            within = (found >= least) & (found <= most)
            fits |= within
            best[i] = -np.sort(-np.concatenate([best[i], found[within]]))[:k]
        taken.append(some[fits])
        scores.append(found[fits])
    return np.concatenate(taken), np.concatenate(scores)


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k first by falling score, ties by rising id."""
    return np.lexsort((ids, ~scores))[:k]


class Shard:
    """A task's rows, those of one label side by side."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("label")
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.points = floors(rows["embedding"])
        self.codes = np.frombuffer(b"".join(rows["code"].to_pylist()), "<u8").reshape(len(rows), -1)
        self.alignment, self.length = rows["alignment"].to_numpy(), rows["length"].to_numpy()

    def of_label(self, label: int) -> slice:
        return slice(*(int(np.searchsorted(self.labels, label, side)) for side in ("left", "right")))

    def intervals(self, anchor: Anchor, part: slice = slice(None)):
        return anchor.intervals(self.codes[part], self.alignment[part], self.length[part])


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            shard, vectors = Shard(rows), floors(anchors["a_embedding"])
            for vector, own, label in zip(vectors, anchors["a_vec_id"].to_pylist(), anchors["a_label"].to_pylist()):
                part = shard.of_label(label)
                low, high = shard.intervals(Anchor(vector), part)
                high[shard.ids[part] == own] = -np.inf
                points, ids = shard.points[part], shard.ids[part]
                at, scores = best_in_bands(low, high, lambda some: exact_scores(points[some], vector), [(-(2**63), 2**63 - 1)], k)  # noqa: B023
                first = _first(ids[at], scores, k)
                found.append((np.full(len(first), own), ids[at[first]], scores[first]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score"), columns)))

    return run


def bands_of(scores: list[int], least: int, most: int) -> list[tuple[int, int]]:
    """Whole scores n with least * score <= 100 * n <= most * score, for each score."""
    return [(-(-least * s // 100), most * s // 100) for s in scores]


def _negatives(k: int, least: int, most: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            shard, vectors = Shard(rows), floors(anchors["a_embedding"])
            for vector, own, label, positives in zip(vectors, anchors["a_vec_id"].to_pylist(), anchors["a_label"].to_pylist(), anchors["a_positives"].to_pylist()):
                bands = bands_of([p["positive_score"] for p in positives], least, most)
                low, high = shard.intervals(Anchor(vector))
                high[shard.of_label(label)] = -np.inf
                at, scores = best_in_bands(low, high, lambda some: exact_scores(shard.points[some], vector), bands, k)  # noqa: B023
                for place, (low_score, high_score) in enumerate(bands):
                    own_at = np.flatnonzero((scores >= low_score) & (scores <= high_score))
                    own_at = own_at[_first(shard.ids[at[own_at]], scores[own_at], k)]
                    found.append((np.full(len(own_at), own), np.full(len(own_at), place), shard.ids[at[own_at]], scores[own_at]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table(dict(zip(("anchor_id", "place", "negative_id", "negative_score"), columns)))

    return run


def coded_rows(vectors: DataFrame, most_copies: int) -> DataFrame:
    """Usable rows with code, alignment and length; of a row that is repeated no more copies than an answer can hold."""
    usable = vectors.where(finite() & F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0))
    usable = usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.size("embedding").alias("width"), "embedding")
    once = usable.groupBy("vec_id", "label", "width", "embedding").agg(F.least(F.count("*"), F.lit(most_copies)).alias("copies")).select("vec_id", "label", "width", "copies", "embedding")

    def run(batches):
        for batch in batches:
            widths = batch.column(2).to_numpy()
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                code, alignment, length = encode(floors(part.column(4)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([row.tobytes() for row in code], pa.binary()), pa.array(alignment), pa.array(length)], names=[*part.schema.names, "code", "alignment", "length"])

    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    return once.mapInArrow(giving_back(run), _ROW.format(kind=kind))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank``.

    ``vectors`` has vec_id, label (a whole number) and embedding; ``is_anchor`` is a condition
    on vec_id. An anchor's positives are its ``positives`` best rows of the same label under
    another vec_id; for each the ``negatives`` best rows of another label whose score is
    between ``least`` and ``most`` per cent of the positive's. Ties go to the smaller vec_id.
    Rows without an id, a label or a usable vector take no part, nor do vectors of another
    width with an anchor. A repeated row is a candidate each time; an anchor's id is asked
    once, with its smallest label and vector. Other columns don't matter; an empty table
    gives no rows. Scores are exact; one that doesn't fit 64 bits fails the job.
    """
    spark = vectors.sparkSession
    rows = stored(coded_rows(vectors, max(positives, negatives)))
    n = rows.count()
    shards = max(1, -(-n // SHARD_ROWS), min(2 * spark.sparkContext.defaultParallelism, -(-n // LEAST_SHARD_ROWS)))
    asked = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "width", "embedding")).alias("row")).select("vec_id", "row.*")
    blocks = max(1, -(-rows.where(is_anchor).count() // BLOCK_ANCHORS))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    dealt = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(shards)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["shard", "block", "width"]

    def searched(anchors: DataFrame, run, schema: str) -> DataFrame:
        spread = anchors.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        spread = spread.select(*(F.col(c).alias(f"a_{c}") for c in spread.columns))
        return dealt.groupBy(*keys).cogroup(spread.groupBy(*(f"a_{c}" for c in keys))).applyInArrow(lambda a, b: run(a, b), schema)

    found = searched(asked, _positives(positives), "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives)
    lists = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    asked = stored(asked.join(lists, "vec_id"))
    found = searched(asked, _negatives(negatives, least, most), "anchor_id long, place long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = asked.select(F.col("vec_id").alias("anchor_id"), F.inline("positives")).withColumn("place", F.col("place").cast("long"))
    return ranked.join(named, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", (F.col("place") + 1).cast("int").alias("positive_rank"))
