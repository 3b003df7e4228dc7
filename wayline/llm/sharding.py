"""Sharding by vector bin packing over (bytes, tokens, rows).

Equal texts form a group. A group with a share over that of an average bundle is placed
by itself, the many small ones are bundled by a hash of the text into a bounded number
of bundles, and a group that is too large is cut into pieces of a bounded share each.
Groups, bundles and pieces, a bounded list, are placed one after
the other, largest first, in the shard where the dot product of the item with the
shard's residual capacity is highest, of those with room, or else in the one with most
bytes left. Rows then look their bundle's shard up and get
gapless slots from counts per small cell, so no shard is ever sorted as a whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, scaled_partitions, text_or_empty

BUNDLES_EACH = 512  # bundles for each shard
PIECES_EACH = 128  # a group of more than 1 / (shards * PIECES_EACH) of the whole is cut
CELL_ROWS = 50_000


def pack(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item, an (n, d) array of sizes; largest first, each where
    the dot product with the residual capacity is highest of those it fits into, the lower
    shard on ties. One that fits nowhere goes where most of the first measure is left."""
    total = items.sum(axis=0)
    share = np.divide(items, total, out=np.zeros(items.shape), where=total > 0) * shards
    residual = np.ones((shards, items.shape[1]))
    placed = np.zeros(len(items), np.int64)
    for i in np.argsort(-share.sum(axis=1), kind="stable"):
        fits = (residual >= share[i] - 1e-9).all(axis=1)
        placed[i] = int(np.argmax(np.where(fits, residual @ share[i], -np.inf) if fits.any() else residual[:, 0]))
        residual[placed[i]] -= share[i]
    return placed


def shard(docs: DataFrame, shards: int = 8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each input row: id, ``size`` (UTF-8 bytes + 1), ``n_tokens`` (words),
    ``text_crc32``, ``shard`` from 0, ``slot`` (gapless from 0 in its shard).

    A null text is an empty one. Equal texts share a shard unless they hold more than
    1 / (shards * PIECES_EACH) of the bytes, tokens or rows; then they are cut into
    pieces of at most about that share, or of one row. Repeated rows are rows of their own,
    and rows of a null id too. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.regexp_count(text, F.lit("\\S+")).cast("long").alias("n_tokens"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
        # Tells rows apart that are the same in everything; the rows are written with it.
        F.monotonically_increasing_id().alias("row"),
    )
    rows = cut(rows)
    sizes = [F.sum("size").alias("size"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_rows")]
    measures = ["size", "n_tokens", "n_rows"]
    groups = cut(rows.groupBy("group").agg(*sizes))
    total = groups.agg(*(F.sum(m).alias(m) for m in measures)).first()
    if total["n_rows"] is None:
        return rows.select("doc_id", "size", "n_tokens", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    # Of these there can be no more than shards * PIECES_EACH for each measure.
    most = {m: max(total[m] / (shards * PIECES_EACH), 1) for m in measures}
    pieces = F.ceil(F.greatest(*(F.col(m) / most[m] for m in measures))).cast("int")
    # A single row is never cut, it is an item of its own.
    least = {m: total[m] / (shards * BUNDLES_EACH) for m in measures}
    alone = F.greatest(*(F.when(F.lit(least[m] > 0), F.col(m) / max(least[m], 1e-9)).otherwise(0.0) for m in measures)) > 1
    heavy = groups.where((pieces > 1) | alone).select("group", F.least(pieces.cast("long"), "n_rows").cast("int").alias("pieces"), *measures).collect()
    bundles = shards * BUNDLES_EACH
    bundle = F.pmod(F.xxhash64(F.col("group")), F.lit(bundles)).cast("int")
    light = groups.where(~((pieces > 1) | alone)).groupBy(bundle.alias("item")).agg(*(F.sum(m).alias(m) for m in measures)).collect()

    items = [(r["item"], *(float(r[m]) for m in measures)) for r in light]
    first_piece, at = [], bundles
    for r in sorted(heavy, key=lambda r: r["group"]):
        first_piece.append((r["group"], at, r["pieces"]))
        # Rows are dealt in turn, so the first pieces may have a row more.
        each, more = divmod(r["n_rows"], r["pieces"])
        items += [(at + i, *(r[m] * (each + (i < more)) / r["n_rows"] for m in measures)) for i in range(r["pieces"])]
        at += r["pieces"]
    items.sort()
    placed = pack(np.array([x[1:] for x in items]).reshape(len(items), len(measures)), shards)
    where = spark.createDataFrame([(x[0], int(s)) for x, s in zip(items, placed)], "item int, shard int")
    cut_groups = spark.createDataFrame(first_piece, "group long, first int, pieces int")

    # Bounded lists both: at most shards * (4 * BUNDLES_EACH + 6 * PIECES_EACH) items.
    cells = scaled_partitions(spark, total["n_rows"], CELL_ROWS)
    # A heavy group's rows are numbered by small cells, then dealt to its pieces in turn.
    dealt = rows.join(F.broadcast(cut_groups), "group").withColumn("deal", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(cells)).cast("int"))
    held = dealt.groupBy("group", "deal").agg(F.count("*").alias("n"))
    passed = F.coalesce(F.sum("n").over(Window.partitionBy("group").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = dealt.withColumn("turn", F.row_number().over(Window.partitionBy("group", "deal").orderBy("row"))).join(held.select("group", "deal", passed.alias("passed")), ["group", "deal"])
    fields = ["doc_id", "size", "n_tokens", "text_crc32", "row"]
    dealt = dealt.select(*fields, (F.col("first") + F.pmod(F.col("passed") + F.col("turn") - 1, F.col("pieces"))).cast("int").alias("item"))
    rows = rows.join(F.broadcast(cut_groups), "group", "left_anti").select(*fields, bundle.alias("item")).unionByName(dealt)
    rows = rows.join(F.broadcast(where), "item")

    rows = rows.withColumn("cell", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(max(1, cells // shards + 1))).cast("int"))
    cell = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "row")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    offsets = offsets.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = rows.withColumn("place", F.row_number().over(cell)).join(offsets, ["shard", "cell"])
    return numbered.select("doc_id", "size", "n_tokens", "text_crc32", "shard", (F.col("offset") + F.col("place") - 1).alias("slot"))
