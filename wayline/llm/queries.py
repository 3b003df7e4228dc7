"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, context_tree, quality
from .common import hex_sha256, table
from .decontaminate import OVERLAPS_SQL, overlaps
from .hard_negatives import mine
from .html_text import extract_main_text
from .jaccard import similarity_classes
from .line_dedup import dedup_lines
from .license_scan import scan_licenses
from .secrets import scan_secrets
from .sharding import shard
from .topk import top_k
from .vector_codes import compress


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.transform("removed", lambda x: F.format_string("%d:%d", x.first, x.end)), ",").alias("removed"), "text")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", hex_sha256(F.col("base")).alias("base_sha256"), "spans", "n_model")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def _ranks_path() -> str:
    return import_module("public_tokenizers").path("byte_bpe_multi_50k.tiktoken")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.fingerprints(table(spark, sf_dir, "documents"), bpe.load_ranks(_ranks_path()))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity_classes(table(spark, sf_dir, "documents"), n=3, threshold="0.9")
    return found.select("doc_id", "n_shingles", "component_id", "class_id", "n_verified")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard(table(spark, sf_dir, "documents"), shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "n_tokens")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("findings").cast("long").alias("n_findings"),
        F.array_join(F.transform("findings", lambda x: F.format_string("%s:%d:%d", x.license, x.start, x.end)), ",").alias("findings"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("findings", lambda x: x.license))), ",").alias("licenses"),
        F.array_max(F.transform("findings", lambda x: x.coverage)).alias("coverage"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings")).drop("label")


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", context_tree.in_fold("doc_id"))
    return context_tree.score_texts(docs, ~F.col("held_out"), keep=("doc_id", "held_out"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_html_extraction": op3_html_extraction,
    "op4_decontamination": op4_decontamination,
    "op5_bpe": op5_bpe,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quality": op7_quality,
    "op8_sharding": op8_sharding,
    "op9_topk": op9_topk,
    "op10_license_scan": op10_license_scan,
    "op11_vector_codes": op11_vector_codes,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_hard_negatives": op13_hard_negatives,
}

USABLE_SQL = """embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Every part against every entry, two rounds of new entries, and the codes of the last ones."""
    nearest = lambda k: f"""a{k} AS MATERIALIZED (  -- the nearest entry of each part, ties to the lower index
            SELECT q.r, q.p, arg_min(e.i, [list_sum(list_transform(list_zip(q.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e.i]) AS i,
                   min(list_sum(list_transform(list_zip(q.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
            FROM q JOIN b{k} e USING (p) GROUP BY q.r, q.p
        )"""  # noqa: E731
    moved = lambda k: f"""b{k + 1} AS MATERIALIZED (
            SELECT p, i, coalesce(n.v, e.v) AS v FROM b{k} e LEFT JOIN (
                SELECT p, i, list(m ORDER BY j) AS v FROM (
                    SELECT p, i, j, CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS m FROM (SELECT p, i, unnest(q.v) AS x, generate_subscripts(q.v, 1) AS j FROM a{k} JOIN q USING (r, p)) GROUP BY p, i, j
                ) GROUP BY p, i
            ) n USING (p, i)
        )"""  # noqa: E731
    steps = ",\n        ".join(f"{nearest(k)},\n        {moved(k)}" for k in range(rounds))
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings WHERE {USABLE_SQL}
        ), q AS MATERIALIZED (
            SELECT r, p, e[p * len(e) // {parts} + 1 : (p + 1) * len(e) // {parts}] AS v FROM v, (SELECT unnest(range({parts})) AS p)
        ), b0 AS MATERIALIZED (SELECT p, r - 1 AS i, v FROM q WHERE r <= {entries}),
        {steps},
        {nearest(rounds)},
        codes AS (SELECT r, string_agg(format('{{:02x}}', i), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
        books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, i)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN codes USING (r), books
    """


ORACLE_SQL = {
    "op11_vector_codes": _codes_sql(),
    "op13_hard_negatives": f"""
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {USABLE_SQL}
        ), s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score, CAST(row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS INTEGER) AS positive_rank FROM s WHERE same
        ), n AS (
            SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (PARTITION BY anchor_id, positive_rank ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
            FROM p JOIN s USING (anchor_id) WHERE positive_rank <= 5 AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank FROM n WHERE rank <= 10
    """,
    "op4_decontamination": OVERLAPS_SQL,
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
