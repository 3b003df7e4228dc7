"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Fixed masks over eight words ignore some positions. The masked words at every place
of a benchmark item are hashed into seeds; a scan over the documents hashes every
place the same way and joins. A hit names an item and a diagonal (document place
less item place); on each diagonal the item's words are compared with the document's
and every window of the item with enough equal words counts, so that substituted
words between and around the seeds are tolerated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty

# Every 8 to 13 words of which ``SHARE`` are equal keep the words of one of these masks at some place.
MASKS = ("11010011", "10011101", "11101010", "01111100")
SPAN = 8
WINDOW = 13
SHARE = 0.8
LOST = 2  # words that a window may differ in, also those beyond a document's ends
BROADCAST_BYTES = 64 << 20  # of the seeds, of the items, of the ids to leave out


def words_column(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _places(df: DataFrame, keys: list[str], place: str, beyond: int = 0) -> DataFrame:
    """A row for each place and mask: the keys, the words and the hash of the words that the
    mask keeps. Places may reach ``beyond`` words over either end."""
    at = F.explode(F.sequence(F.lit(-beyond), F.size("words") - SPAN + beyond)).alias(place)
    at = df.where(F.size("words") >= SPAN - beyond).select(*keys, "words", at)
    hashes = [F.xxhash64(F.lit(m), *(F.get("words", F.col(place) + i) for i, c in enumerate(mask) if c == "1")) for m, mask in enumerate(MASKS)]
    return at.select(*keys, "words", place, F.explode(F.array(*hashes)).alias("seed"))


def _fits(df: DataFrame, size: Column) -> bool:
    """Whether the rows of ``df``, a table already written, are small enough to be broadcast."""
    return (df.agg(F.sum(size + 64)).first()[0] or 0) <= BROADCAST_BYTES


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """``doc_id, item_id, n_match, first_word, last_word`` of every document and item that overlap.

    Words are runs of letters and digits, lower-cased. A window is ``window`` words of
    the item, or the whole item if it is shorter, of which ``share`` equal the
    document's words at the same distance; ``n_match`` is the most equal words in a
    window, first and last word (from 0) bound the windows in the document. With the
    window and share given here no overlap is missed. Null and empty texts and items of
    fewer than eight words overlap with nothing. Rows that share an id give one result;
    a null id is an id of its own.
    """
    items = benchmark.select("item_id", words_column(text_or_empty()).alias("words")).where(F.size("words") >= SPAN)
    items = cut(items.withColumn("item_hash", F.xxhash64("words")).dropDuplicates(["item_id", "item_hash"]))
    seeds = cut(_places(items, ["item_id", "item_hash"], "q").drop("words"))
    id_bytes = F.coalesce(F.octet_length(F.col("item_id").cast("string")), F.lit(0))
    items_fit = _fits(items, F.octet_length(F.concat_ws(" ", "words")) + 16 * F.size("words") + id_bytes)
    items = items.select(F.col("item_id").alias("__item"), F.col("item_hash").alias("__hash"), F.col("words").alias("item"))
    if items_fit:
        items = F.broadcast(items)
    own = F.col("item_id").eqNullSafe(F.col("__item")) & (F.col("item_hash") == F.col("__hash"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_column(text_or_empty()).alias("words"))
    line = ["doc_id", "text_hash", "item_id", "item_hash", "diagonal"]
    # Of the document only the words beside the item go on; those before its start are null.
    begin = (F.col("p") - F.col("q")).alias("diagonal")
    before = F.greatest(-F.col("diagonal"), F.lit(0))
    beside = F.slice("words", F.greatest(F.col("diagonal"), F.lit(0)) + 1, F.greatest(F.size("item") - before, F.lit(0))).alias("beside")
    places = _places(rows, ["doc_id", "text_hash"], "p", LOST)
    if items_fit and _fits(seeds, id_bytes):
        hits = places.join(F.broadcast(seeds), "seed").select(*line[:4], "words", begin).join(items, own).select(*line, "item", beside)
        lines = hits.groupBy(*line).agg(F.first("item").alias("item"), F.first("beside").alias("beside"))
    else:
        # Ids alone are shuffled by the seeds; the words are fetched for the hits.
        hits = places.drop("words").join(seeds, "seed").select(*line[:4], begin).distinct()
        texts = rows.dropDuplicates(["doc_id", "text_hash"]).select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"), "words")
        hits = hits.join(texts, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__text")))
        lines = hits.join(items, own).select(*line, "item", beside)

    skip = F.greatest(-F.col("diagonal"), F.lit(0))
    equal = F.transform("item", lambda w, i: F.coalesce((F.get("beside", i - skip) == w) & (i >= skip), F.lit(False)).cast("int"))
    width = F.least(F.size("item"), F.lit(window))
    lines = lines.select("doc_id", "item_id", "diagonal", width.alias("width"), equal.alias("equal"))
    total = F.transform(F.sequence(F.lit(0), F.size("equal") - F.col("width")), lambda i: F.aggregate(F.slice("equal", i + 1, F.col("width")), F.lit(0), lambda a, x: a + x))
    lines = lines.withColumn("total", total).withColumn("needed", F.ceil(F.col("width") * share).cast("int"))
    good = F.filter(F.transform("total", lambda t, i: F.when(t >= F.col("needed"), i)), lambda i: i.isNotNull())
    lines = lines.withColumn("good", good).where(F.size("good") > 0)
    first = F.greatest(F.array_min("good") + F.col("diagonal"), F.lit(0))
    last = F.array_max("good") + F.col("diagonal") + F.col("width") - 1
    return lines.groupBy("doc_id", "item_id").agg(F.max(F.array_max("total")).alias("n_match"), F.min(first).alias("first_word"), F.max(last).alias("last_word"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no benchmark item, all their columns as they were."""
    bad = cut(overlaps(docs, benchmark).select(F.col("doc_id").alias("__bad")).distinct())
    if _fits(bad, F.coalesce(F.octet_length(F.col("__bad").cast("string")), F.lit(0))):
        bad = F.broadcast(bad)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__bad"]), "left_anti")


#: The same matches by plain SQL without masks: of 8 to 13 words that are equal in ``SHARE``, some three in a row are.
OVERLAPS_SQL = r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL
    ), b AS (
        SELECT item_id, w FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL)
        WHERE len(w) >= 8
    ), dp AS (
        SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3
    ), bp AS (
        SELECT item_id, w, unnest(range(1, len(w) - 1)) AS q FROM b
    ), ds AS (
        SELECT doc_id, p, concat_ws(' ', w[p], w[p+1], w[p+2]) AS three FROM dp
    ), bs AS (
        SELECT item_id, q, concat_ws(' ', w[q], w[q+1], w[q+2]) AS three FROM bp
    ), lines AS (
        SELECT DISTINCT doc_id, item_id, p - q AS diagonal FROM ds JOIN bs USING (three)
    ), pairs AS (
        SELECT doc_id, item_id, diagonal, len(b.w) AS n, least(len(b.w), 13) AS width, d.w AS dw, b.w AS bw
        FROM lines JOIN d USING (doc_id) JOIN b USING (item_id)
    ), equal AS (
        SELECT doc_id, item_id, diagonal, n, width, i,
               CASE WHEN i + diagonal >= 1 AND i + diagonal <= len(dw) AND dw[i + diagonal] = bw[i] THEN 1 ELSE 0 END AS e
        FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM pairs)
    ), totals AS (
        SELECT doc_id, item_id, diagonal, n, width, i - 1 AS i,
               sum(e) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS total
        FROM equal
    )
    SELECT doc_id, item_id, CAST(max(total) AS INTEGER) AS n_match,
           CAST(min(greatest(i + diagonal, 0)) AS INTEGER) AS first_word,
           CAST(max(i + diagonal + width - 1) AS INTEGER) AS last_word
    FROM totals WHERE i <= n - width AND total >= ceil(width * 0.8)
    GROUP BY doc_id, item_id
"""
