"""Vector codes and hard negatives against plain versions, bounds that must always hold, and edge cases."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp
from pyspark.sql import functions as F

from wayline.llm import hard_negatives
from wayline.llm.hard_negatives import Anchor, bands_of, best_in_bands, encode, exact_scores, mine
from wayline.llm.vector_codes import Gnat, compress, squares

VECTORS = "vec_id long, embedding array<float>, label int"
EXTRA = VECTORS + ", error int, code string, shard int, score double"


@settings(deadline=None, max_examples=60)
@given(hnp.arrays(np.int64, st.tuples(st.integers(1, 64), st.just(3)), elements=st.integers(-9, 9)), hnp.arrays(np.int64, st.tuples(st.integers(0, 40), st.just(3)), elements=st.integers(-12, 12)))
def test_tree_finds_the_nearest_and_its_lowest_index(points, queries):
    index, square = Gnat(points).nearest(queries)
    want = squares(queries, points)
    assert (index == want.argmin(axis=1)).all() and (square == want.min(axis=1)).all()


def test_tree_rules_children_out(monkeypatch):
    rng = np.random.default_rng(1)
    points = np.concatenate([c + rng.integers(-5, 6, (8, 4)) for c in rng.integers(-4000, 4000, (8, 4))])
    seen = []
    tree = Gnat(points)
    monkeypatch.setattr("wayline.llm.vector_codes.squares", lambda a, b: seen.append(len(a) * len(b)) or squares(a, b))
    tree.nearest(points)
    assert sum(seen) < 0.5 * len(points) ** 2


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = sorted(((i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    step = len(kept[0][1]) // parts
    cut = [[v[p * step : (p + 1) * step] for p in range(parts)] for _, v, _ in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [nearest(row[p], book)[1] for row in cut]
            books[p] = [[sum(c) // len(c) for c in zip(*(row[p] for row, j in zip(cut, own) if j == i))] or e for i, e in enumerate(book)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    found = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {label: sum(e for e, (_, _, own) in zip(errors, kept) if own == label) for _, _, label in kept}
    return sorted((str(i), "".join(f"{j:02x}" for _, j in f), e, by_label[label], digest) for (i, _, label), f, e in zip(kept, found, errors))


def some_vectors(n=150, width=32, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in np.round(rng.normal(0, 0.1, width), 2)], int(rng.integers(4))) for i in rng.permutation(n)]
    rows += [(900 + i, rows[i][1], rows[i][2]) for i in range(min(n, 20))]  # equal vectors under other ids
    rows += [rows[0], rows[0], rows[1]]  # repeated rows
    return [*rows, (5000, None, 1), (5001, [None] * width, 1), (5002, [float("nan")] * width, 2), (5003, [float("inf")] + [0.0] * (width - 1), 2)]


def test_codes_equal_a_plain_version(spark):
    rows = [*some_vectors(), (None, [0.5] * 32, None), (7000, [-0.5] * 32, None)]
    docs = spark.createDataFrame([(*r, 1, "c", 2, 0.5) for r in rows], EXTRA).repartition(5)
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in compress(docs).collect())
    assert got == plain_codes(rows)


def test_codes_of_few_rows_of_none_and_of_wrong_widths(spark):
    few = some_vectors(9, 16)[:9]
    got = [(str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in compress(spark.createDataFrame(few, VECTORS)).collect()]
    assert sorted(got) == plain_codes(few)
    empty = compress(spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and empty.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError):
        compress(spark.createDataFrame([(1, [0.5] * 17, 1)], VECTORS))
    with pytest.raises(ValueError):
        compress(spark.createDataFrame([(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], VECTORS))


@settings(deadline=None, max_examples=80)
@given(st.integers(1, 130), st.integers(0, 10**6), st.sampled_from([1.0, 1e-3, 1e6]))
def test_intervals_always_hold_the_score(width, seed, scale):
    rng = np.random.default_rng(seed)
    points = np.floor(rng.normal(0, 60 * scale, (40, width)))
    points[1], points[2], points[3] = 0, points[4], -points[4]
    for vector in (points[4], points[1], np.floor(rng.normal(0, 60, width)), np.eye(width)[0] * 255):
        low, high = Anchor(vector).intervals(*encode(points))
        score = points @ vector
        assert (low <= score).all() and (score <= high).all()


def test_intervals_leave_most_rows_unscored():
    rng = np.random.default_rng(2)
    points = np.floor(32 * rng.normal(0, 1, (20_000, 64)) * np.exp(rng.normal(0, 1.2, (20_000, 1))))
    vector, scored = points[0], []
    low, high = Anchor(vector).intervals(*encode(points))
    at, scores = best_in_bands(low, high, lambda some: scored.append(len(some)) or exact_scores(points[some], vector), [(-(2**63), 2**63 - 1)], 5)
    assert sorted(scores)[-5:] == sorted(points @ vector)[-5:] and sum(scored) < 0.3 * len(points)


def plain_mine(rows, every, k=5, m=10):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, v, label in sorted(usable, key=lambda r: (r[0], r[2], r[1])):
        if i % every == 0:
            anchors.setdefault(i, (v, label))
    out = []
    for a, (v, label) in anchors.items():
        scores = [(-sum(x * y for x, y in zip(v, w)), i, own) for i, w, own in usable if i != a]
        for place, (s, p, _) in enumerate(sorted(t for t in scores if t[2] == label)[:k], 1):
            fit = sorted(t for t in scores if t[2] != label and 30 * -s <= 100 * -t[0] <= 90 * -s)[:m]
            out += [(a, p, rank, i, -s, -n, place) for rank, (n, i, _) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("least_shard", [2_048, 30])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, least_shard):
    monkeypatch.setattr(hard_negatives, "LEAST_SHARD_ROWS", least_shard)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 7 if least_shard == 30 else 16_384)
    rows = [*some_vectors(300), (None, [0.1] * 32, 1), (8, [0.1] * 32, None), (21, [0.05] * 32, 0), (21, [0.2] * 32, 3), (40, [0.0] * 32, 2)]
    rows += [rows[3]] * 40  # more copies of a row than any answer holds
    docs = spark.createDataFrame([(*r, 1, "c", 2, 0.5) for r in rows], EXTRA)
    got = sorted(tuple(r) for r in mine(docs, F.col("vec_id") % 10 == 0).collect())
    assert got == plain_mine(rows, 10) and len(got) > 100


def test_hard_negatives_of_nothing_and_of_large_components(spark):
    assert mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 10 == 0).collect() == []
    large = "vec_id long, embedding array<double>, label int"
    rows = [(10, [2.0**20 + 1 / 256, 1.0], 1), (11, [2.0**20, 3.0], 1), (12, [2.0**19, 5.0], 2), (13, [2.0**19, 4.0], 2)]
    assert [(r.negative_id, r.negative_score) for r in mine(spark.createDataFrame(rows, large), F.col("vec_id") == 10).orderBy("rank").collect()] == [(12, (2**28 + 1) * 2**27 + 256 * 1280), (13, (2**28 + 1) * 2**27 + 256 * 1024)]


def test_bands_are_whole_numbers():
    assert bands_of([100, 1, 0, -10], 30, 90) == [(30, 90), (1, 0), (0, 0), (-3, -9)]
