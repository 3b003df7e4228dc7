"""Context-tree weighting against a plain recursion over single bits, and edge cases."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayline.llm import context_tree
from wayline.llm.context_tree import DEPTH, SIGN, held_out, log_kt, score_texts
from wayline.llm.queries import op12_lm_scoring


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def signs(text):
    return [SIGN] * DEPTH + list(lower(text).encode()) + [SIGN]


class PlainTree:
    """Bit counts by (bytes before, bits before), weighted by recursion."""

    def __init__(self, texts):
        self.counts = defaultdict(lambda: [0, 0])
        self.longer = defaultdict(set)
        for text in texts:
            s = signs(text)
            for i in range(DEPTH, len(s)):
                bits = f"{s[i]:08b}"
                for d in range(DEPTH + 1):
                    before = tuple(s[i - d : i])
                    for k in range(8):
                        self.counts[before, bits[:k]][int(bits[k])] += 1
                        if d < DEPTH:
                            self.longer[before, bits[:k]].add((s[i - d - 1], *before))
        self.weighted = lru_cache(None)(self.weighted)

    def estimate(self, node):
        p, zeros, ones = 0.0, 0, 0
        a, b = self.counts.get(node, (0, 0))
        for _ in range(a):
            p, zeros = p + math.log((zeros + 0.5) / (zeros + ones + 1)), zeros + 1
        for _ in range(b):
            p, ones = p + math.log((ones + 0.5) / (zeros + ones + 1)), ones + 1
        return p

    def children(self, node):
        return sum(self.weighted((before, node[1])) for before in self.longer.get(node, ()))

    def weighted(self, node):
        if len(node[0]) == DEPTH:
            return self.estimate(node)
        return float(np.logaddexp(self.estimate(node), self.children(node)) - math.log(2))

    def bit(self, before, bits, bit):
        p = None
        for d in range(DEPTH, -1, -1):
            node = (before[DEPTH - d :], bits)
            a, b = self.counts.get(node, (0, 0))
            own = ((b if bit else a) + 0.5) / (a + b + 1)
            if p is None:
                p = own
            else:
                odds = math.exp(self.estimate(node) - self.children(node))
                p = (odds * own + p) / (odds + 1)
        return p

    def score(self, text):
        s, total = signs(text), 0.0
        for i in range(DEPTH, len(s)):
            bits = f"{s[i]:08b}"
            for k in range(8):
                total += math.log10(self.bit(tuple(s[i - DEPTH : i]), bits[:k], int(bits[k])))
        return total


def brute(texts, learn):
    words = [[*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None] for t in texts]
    counts = Counter(w for own, yes in zip(words, learn) if yes for w in own)
    n = sum(counts.values())
    tree = PlainTree([t for t, yes in zip(texts, learn) if yes])
    for text, own in zip(texts, words):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (len(counts) + 1))) for w in own)
        yield len(own), sum(counts[w] > 0 for w in own), n, pytest.approx(base, rel=1e-9, abs=1e-9), pytest.approx(tree.score(text), rel=1e-9)


COLUMNS = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


@pytest.fixture
def texts():
    rng = random.Random(12)
    some = [" ".join(rng.choice(["the", "The", "a", "ox", "über", "naïve", "q\x00", "日本", "ran"]) for _ in range(rng.randint(1, 25))) for _ in range(30)]
    return [*some, "", None, "  \t", some[0], some[0], "x" * 300, "never seen WORDS 12345", "é"]


@pytest.mark.parametrize("few", [False, True])
def test_scores_equal_a_plain_tree(spark, texts, few, monkeypatch):
    if few:  # nearly every word and gram then goes by the join
        monkeypatch.setattr(context_tree, "FREQUENT_ROWS", 5)
    schema = "doc_id long, text string, row int, value double, kind string, learn int"
    docs = spark.createDataFrame([(i, t, 1, 2.0, "k", 0) for i, t in enumerate(texts)], schema)
    found = {r.doc_id: [r[c] for c in COLUMNS] for r in score_texts(docs, F.col("doc_id") % 4 != 0).collect()}
    for i, want in enumerate(brute(texts, [i % 4 != 0 for i in range(len(texts))])):
        assert found[i] == list(want), texts[i]


def test_scores_of_ids_that_are_null_or_repeated_and_of_nothing(spark):
    docs = spark.createDataFrame([(7, "one two"), (7, "one two"), (None, "one three")], "doc_id long, text string")
    docs = docs.withColumn("held_out", held_out())
    got = sorted(((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known) for r in score_texts(docs, ~F.col("held_out"), ("doc_id", "held_out")).collect()))
    out = zlib.crc32(b"7") % 10 == 0
    assert got == [(0, True, 3, 0 if out else 2), (7, out, 3, 0 if out else 3), (7, out, 3, 0 if out else 3)]
    assert score_texts(docs.limit(0), F.lit(True)).collect() == []
    blank = score_texts(docs, F.lit(False)).first()
    assert (blank.n_known, blank.train_tokens, blank.base_score) == (0, 0, 0.0)
    assert blank.score == pytest.approx(-(len("one two") + 1) * 8 * math.log10(2)) or blank.score == pytest.approx(-(len("one three") + 1) * 8 * math.log10(2))


def test_query_says_nothing_of_the_fold_of_a_row_without_an_id(spark, tmp_path):
    rows = [(None, "one two"), (None, None), *((i, "one three") for i in range(30))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_lm_scoring(spark, str(tmp_path)).collect()
    learned = sum(zlib.crc32(str(i).encode()) % 10 != 0 for i in range(30))
    assert 0 < learned < 30 and {r.train_tokens for r in got} == {3 * learned}
    assert sorted((r.n_tokens, r.n_known) for r in got if r.doc_id is None) == [(1, 1), (3, 2)]
    assert all(r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)


def test_both_passes_stay_small_on_many_bytes():
    rng = random.Random(4)
    texts = [" ".join(f"{rng.getrandbits(20):x}" for _ in range(2000)) for _ in range(700)]  # some 8 MB
    batch = lambda *columns: pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b"])
    none = pa.array([], pa.large_binary()), np.zeros(0)
    add = context_tree._adder(SimpleNamespace(value={context_tree.WORD: none, context_tree.GRAM: (np.zeros(0, np.int64), np.zeros(0))}), 1.0)
    for run in (lambda: context_tree.count_terms([batch(texts, [True] * len(texts))]), lambda: add([batch(list(range(len(texts))), texts)])):
        tracemalloc.start()
        rows = sum(made.num_rows for made in run())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows > 0 and peak < 130e6, peak


def test_estimates_of_large_counts():
    for a, b in ((0, 0), (1, 0), (63, 64), (64, 1000), (10**7, 3)):
        want = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        assert log_kt(np.array([a]), np.array([b]))[0] == pytest.approx(want, rel=1e-12, abs=1e-7)


def test_probabilities_of_all_next_bytes_sum_to_one(spark, texts):
    tree = PlainTree(texts[:10])
    total = lambda before: sum(math.prod(tree.bit(before, f"{x:08b}"[:k], int(f"{x:08b}"[k])) for k in range(8)) for x in range(256))
    assert total((SIGN,) * DEPTH) == pytest.approx(1) and total(tuple(b"the ")) == pytest.approx(1)
