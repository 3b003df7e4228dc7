"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Indicators are hashed word n-grams and n-grams of word shapes (case, digits, closing
signs, length, repetition). Their class log-count ratios are counted over every
labelled training row by a Spark job; the linear hinge-loss model on the scaled
indicators is fitted by dual coordinate descent on a bounded sample of those rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, giving_back
from .words import SPACES, mix, words_of

BITS = 18
FIT_ROWS = 4_000  # of each class
EPOCHS = 12
COST = 1.0
SMOOTHING = 1.0
BROADCAST_LABELS = 2_000_000

_CLASS = np.full(256, 3, np.uint8)  # other signs
_CLASS[48:58] = 2
_CLASS[65:91] = 1
_CLASS[97:123] = 0
_CLASS[128:] = 0
_CLASS[[33, 44, 46, 58, 59, 63]] = 4  # sentence signs


def shapes(words) -> np.ndarray:
    """A small code for each word's looks, and whether it repeats the word before it."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    kinds = _CLASS[words.data]
    upper, lower, digit = (np.concatenate(([0], np.cumsum(kinds == k))) for k in (1, 0, 2))
    within = lambda sums: sums[words.end] - sums[words.start]
    n_upper, n_lower, n_digit = within(upper), within(lower), within(digit)
    length = words.end - words.start
    last, second = kinds[words.end - 1], kinds[np.maximum(words.end - 2, words.start)]
    signs = (last >= 3).astype(np.int64) * np.where(last == 4, 1, 2) + 2 * ((last >= 3) & (second >= 3))
    repeats = np.zeros(len(length), np.int64)
    repeats[1:] = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    size = np.searchsorted([4, 9, 15, 30], length, side="right")
    code = size
    for part, base in (((kinds[words.start] == 1), 2), ((n_upper > 1) & (n_lower == 0), 2), (n_digit > 0, 2), (n_upper + n_lower + n_digit == 0, 2), (signs, 5), (repeats, 2)):
        code = code * base + part
    return code.astype(np.uint64)


def indicators(column: pa.Array):
    """(first text, number of texts, text, feature) of the distinct features, in chunks."""
    for words in words_of(column, SPACES, lower=False):
        shape = shapes(words)
        streams = [(words.hash, 1, 1), (words.hash, 2, 2), (shape, 1, 3), (shape, 2, 4), (shape, 3, 5)]
        text, feature = [], []
        for stream, n, kind in streams:
            if len(stream) < n:
                continue
            value = np.full(len(stream) - n + 1, kind, np.uint64)
            for i in range(n):
                value = mix(value * np.uint64(0x9E3779B97F4A7C15) + stream[i : i + len(value)])
            own = words.text[: len(value)]
            whole = own == words.text[n - 1 :]
            text.append(own[whole])
            feature.append(value[whole] >> np.uint64(64 - BITS))
        key = np.unique((np.concatenate(text).astype(np.uint64) << np.uint64(BITS)) | np.concatenate(feature)) if text else np.zeros(0, np.uint64)
        yield words.first, words.texts, (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray  # on plain indicators: the ratios are multiplied in
    bias: float
    slope: float
    offset: float

    def score(self, column: pa.Array) -> np.ndarray:
        margin = np.full(len(column), self.bias)
        for first, texts, text, feature in indicators(column):
            total = np.bincount(text, self.weights[feature], texts)
            count = np.bincount(text, minlength=texts)
            margin[first : first + texts] += total / np.sqrt(np.maximum(count, 1))
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, cost: float = COST, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights on the scaled indicators and bias of an L1-loss support vector machine."""
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    norms = np.array([v @ v + 1.0 for v in values])
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost * weight[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return w, bias


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the margins, by Newton steps."""
    good, bad = weight[y > 0].sum(), weight[y < 0].sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = weight * (p - target)
        h = np.maximum(weight * p * (1 - p), 1e-12)
        hess = np.array([[h @ margin**2 + 1e-6, h @ margin], [h @ margin, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, [g @ margin, g.sum()])
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def held_out(id_column: str | Column = "doc_id") -> Column:
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(column.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """A model from the labelled rows that aren't held out.

    Ids may be of any type that both tables share. An id with several labels counts as 1 if at least half of them are. With no
    labelled rows, or rows of one class, every score is that class's share (0.5 if none).
    """
    given = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id"))
    given = given.groupBy("doc_id").agg((F.avg(label) >= 0.5).alias("y"))
    n, n_good = given.agg(F.count("*"), F.count(F.when(F.col("y"), 1))).first()
    if n_good in (0, n):
        return Model(np.zeros(1 << BITS), 0.0, 1.0, 0.0 if not n else (30.0 if n_good else -30.0))
    texts = docs.select("doc_id", "text")
    side = F.broadcast(given) if n <= BROADCAST_LABELS else given

    def count(batches):
        found = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, _, text, feature in indicators(batch.column(0)):
                good = y[first + text]
                found[1] += np.bincount(feature[good], minlength=1 << BITS)
                found[0] += np.bincount(feature[~good], minlength=1 << BITS)
        some = np.flatnonzero(found.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[0][some]), pa.array(found[1][some])], names=["feature", "bad", "good"])

    counts = texts.join(side, "doc_id").select("text", "y").mapInArrow(giving_back(count), "feature long, bad long, good long")
    counts = counts.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()
    good, bad = np.full(1 << BITS, SMOOTHING), np.full(1 << BITS, SMOOTHING)
    np.add.at(good, counts["feature"].to_numpy(), counts["good"].to_numpy())
    np.add.at(bad, counts["feature"].to_numpy(), counts["bad"].to_numpy())
    ratio = np.log(good / good.sum()) - np.log(bad / bad.sum())

    # At most fit_rows ids of each class, the first by a hash of the id.
    order = F.xxhash64("doc_id")
    chosen = given.where("y").orderBy(order, "doc_id").limit(fit_rows).unionByName(given.where("not y").orderBy(order, "doc_id").limit(fit_rows))

    def featurise(batches):
        for batch in batches:
            lists: list[np.ndarray] = [np.zeros(0, np.int32)] * batch.num_rows
            for first, n_texts, text, feature in indicators(batch.column(0)):
                bounds = np.searchsorted(text, np.arange(n_texts + 1))
                for i in range(n_texts):
                    lists[first + i] = feature[bounds[i] : bounds[i + 1]].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([x.tobytes() for x in lists], pa.binary())], names=["doc_id", "y", "features"])

    sample = texts.join(F.broadcast(chosen), "doc_id").select("text", "doc_id", "y").mapInArrow(giving_back(featurise), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, y boolean, features binary")
    sample = sample.orderBy("doc_id", "features").toPandas()
    if sample["y"].nunique() < 2:
        return Model(np.zeros(1 << BITS), 0.0, 1.0, 30.0 if n_good * 2 >= n else -30.0)
    rows = [np.frombuffer(x, np.int32) for x in sample["features"]]
    y = np.where(sample["y"].to_numpy(bool), 1.0, -1.0)
    # Each class weighs as much as it does among all labelled rows.
    share = np.where(y > 0, n_good / n / (y > 0).mean(), (n - n_good) / n / (y < 0).mean())
    fold = np.arange(len(y)) % 4 == 0
    part = [r for r, out in zip(rows, fold) if not out]
    even = np.ones(len(y))
    w, bias = dual_descent(part, y[~fold], ratio, even[~fold])
    margin = np.array([w[r] @ ratio[r] / np.sqrt(max(len(r), 1)) + bias for r, out in zip(rows, fold) if out])
    slope, offset = platt(margin, y[fold], share[fold]) if len(set(y[fold])) == 2 else (1.0, 0.0)
    return Model(w * ratio, bias, slope, offset)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The ``keep`` columns of every row and its score as ``name``; a null text counts as empty."""

    def run(batches):
        for batch in batches:
            values = model.score(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values)], names=[*batch.schema.names[:-1], name])

    source = docs.select(*keep, F.col("text").alias(free_name(keep, "__text")))
    return source.mapInArrow(giving_back(run), T.StructType([*source.schema.fields[:-1], T.StructField(name, T.DoubleType())]))
