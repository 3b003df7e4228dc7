"""Vector code compression: product codes whose nearest entries a GNAT over each codebook finds.

A vector is cut into equal consecutive parts, each part has a codebook of at most ``ENTRIES``
entries, and a code names the nearest entry of each part. Codebooks are fitted in rounds over
all rows: tasks add up the parts that fall to each entry, and the sums of all tasks, at most
parts times entries rows, give the next codebooks.

The nearest entry comes from a geometric near-neighbour access tree over the entries: a node
has split points, every other entry goes to its nearest one, and for each split point the
range of its distances to each child's entries is stored. A query's distance to a split
point and its best distance so far rule out whole children by the triangle inequality,
strictly and with bounds rounded outwards, so that ties survive; what is left is compared by
whole squared distances, ties to the lower index.
"""

from __future__ import annotations

import binascii
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import finite, floors, giving_back

PARTS, ENTRIES, ROUNDS = 16, 64, 2
DEGREE = 6
_SLACK = 1e-9  # relative, on distances: far above the error of a square root


class Gnat:
    """A tree over whole-number points; ``nearest`` answers many queries at once."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE):
        self.points, self.degree = points, degree
        self.root = self._grow(np.arange(len(points)))

    def _grow(self, own: np.ndarray) -> tuple:
        """(split points, children, low, high); a node of few points has split points only."""
        if len(own) <= self.degree:
            return own, [], None, None
        # Split points far from each other, from the lowest index on.
        split = [0]
        near = squares(self.points[own], self.points[own[:1]])[:, 0]
        while len(split) < self.degree:
            split.append(int(near.argmax()))
            near = np.minimum(near, squares(self.points[own], self.points[own[split[-1:]]])[:, 0])
        split = np.unique(split)  # copies of one point leave fewer
        heads, rest = own[split], np.delete(own, split)
        goes = squares(self.points[rest], self.points[heads]).argmin(axis=1)
        children, low, high = [], [], []
        for j in range(len(heads)):
            below = rest[goes == j]
            if not len(below):
                continue
            away = np.sqrt(squares(self.points[heads], self.points[below]).astype(np.float64))
            children.append(self._grow(below))
            low.append(away.min(axis=1) * (1 - _SLACK))
            high.append(away.max(axis=1) * (1 + _SLACK))
        return heads, children, np.array(low), np.array(high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest point."""
        index = np.zeros(len(queries), np.int64)
        square = np.full(len(queries), np.iinfo(np.int64).max)
        if len(queries) and len(self.points):
            self._visit(self.root, np.arange(len(queries)), queries, index, square)
        return index, square

    def _visit(self, node, active, queries, index, square) -> None:
        heads, children, low, high = node
        found = squares(queries[active], self.points[heads])
        for j, head in enumerate(heads):
            better = (found[:, j] < square[active]) | ((found[:, j] == square[active]) & (head < index[active]))
            square[active[better]], index[active[better]] = found[better, j], head
        away = np.sqrt(found.astype(np.float64))
        for j, child in enumerate(children):
            reach = np.sqrt(square[active].astype(np.float64)) * (1 + _SLACK)
            out = ((away * (1 - _SLACK) - reach[:, None] > high[j]) | (away * (1 + _SLACK) + reach[:, None] < low[j])).any(axis=1)
            if not out.all():
                self._visit(child, active[~out], queries, index, square)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``a`` to every row of ``b``, as integers."""
    total = np.zeros((len(a), len(b)), np.int64)
    for i in range(a.shape[1]):
        total += (a[:, i, None] - b[None, :, i]) ** 2
    return total


def _parts(column, parts: int) -> np.ndarray:
    """The whole components of vectors as (rows, parts, width of a part)."""
    whole = floors(column)
    width = whole.shape[1] // parts
    if np.abs(whole).max(initial=0.0) >= 2.0**30 / max(width, 1) ** 0.5:
        raise ValueError("a squared distance may not fit 64 bits")
    return whole.astype(np.int64).reshape(len(whole), parts, width)


def _sums(books: list[np.ndarray]):
    """A task's rows and component sums by part and entry, handed on once at its end."""
    parts, width = len(books), books[0].shape[1]

    def run(batches):
        trees = [Gnat(book) for book in books]
        total = np.zeros((parts, max(map(len, books)), width + 1), np.int64)
        for batch in batches:
            rows = _parts(batch.column(0), parts)
            for p, tree in enumerate(trees):
                entry, _ = tree.nearest(rows[:, p])
                np.add.at(total[p], entry, np.concatenate([np.ones((len(rows), 1), np.int64), rows[:, p]], axis=1))
        part, entry = np.nonzero(total[:, :, 0])
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), *map(pa.array, total[part, entry].T)], names=["part", "entry", "n", *(f"s{i}" for i in range(width))])

    return run


def _coded(books: list[np.ndarray], names: list[str]):
    def run(batches):
        trees = [Gnat(book) for book in books]
        for batch in batches:
            rows = _parts(batch.column(batch.num_columns - 1), len(books))
            found = [tree.nearest(rows[:, p]) for p, tree in enumerate(trees)]
            digits = binascii.hexlify(np.stack([i for i, _ in found], axis=1).astype(np.uint8).tobytes()).decode()
            step = 2 * len(books)
            code = [digits[i : i + step] for i in range(0, len(digits), step)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(code, pa.string()), pa.array(sum(d for _, d in found))], names=names)

    return run


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part from usable ``vec_id, embedding`` rows of one width; [] of no rows."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").select("embedding").limit(entries).toArrow()
    if not first.num_rows:
        return []
    low, high = vectors.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if low != high or not low or low % parts:
        raise ValueError(f"vectors must have one width that {parts} parts divide; these have {low} to {high}")
    whole = _parts(first["embedding"], parts)
    books = [whole[:, p] for p in range(parts)]
    width = low // parts
    for _ in range(rounds):
        schema = "part int, entry int, n long, " + ", ".join(f"s{i} long" for i in range(width))
        sums = vectors.select("embedding").mapInArrow(giving_back(_sums(books)), schema)
        # At most parts times entries rows, whatever the table.
        for row in sums.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in sums.columns[2:])).collect():
            books[row.part] = books[row.part].copy()
            books[row.part][row.entry] = [row[f"s{i}"] // row.n for i in range(width)]
    return books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every row with a usable vector.

    Rows whose vector is null or holds null or non-finite components go. A null ``vec_id``
    sorts last among the rows that start the codebooks, a repeated one by its vectors;
    repeated rows count each time; fewer rows than ``entries`` give smaller codebooks, and
    an empty table gives no rows. Null labels are one label. Vectors of several widths, or
    of one that ``parts`` doesn't divide, are an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits for each part: 1 to 256 entries")
    usable = vectors.where(finite()).select("vec_id", "label", "embedding")
    books = fit_codebooks(usable, parts, entries, rounds)
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, label {vectors.schema['label'].dataType.simpleString()}, code string, error long"
    if not books:
        coded = usable.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = usable.mapInArrow(giving_back(_coded(books, ["vec_id", "label", "code", "error"])), schema)
    digest = hashlib.sha256(",".join(str(x) for book in books for x in book.ravel()).encode()).hexdigest()
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    # Spark broadcasts the sums where they are small; labels without number are joined by shuffle.
    found = coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")))
    return found.select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
