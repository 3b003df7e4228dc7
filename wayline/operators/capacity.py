"""Battery capacity: weighted means, the period ledger, time-local correction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ESTIMATES = ("soc_estimate", "soc_fallback")
DAY = 86_400_000_000
RELIABLE_ROWS = 5


def is_donor() -> Column:
    return F.col("capacity_kwh").isNotNull() & ~F.coalesce(F.col("energy_source").isin(*ESTIMATES), F.lit(False)) & F.col("delta_soc").isNotNull() & (F.col("delta_soc") != 0)


def weighted_capacity(value: Column, weight: Column) -> Column:
    """Aggregate: mean of capacities by the change of charge; the plain mean without weights."""
    total = F.sum(weight)
    return F.when(total > 0, F.sum(value * weight) / total).otherwise(F.avg(value))


def period_capacity(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, kwh, n, source`` of each period: charges give it, else discharges, else it is unknown."""
    donor = is_donor() & (F.col("capacity_kwh") > 0)
    side = lambda wanted: F.when(donor & wanted, F.col("capacity_kwh"))
    weight = F.abs("delta_soc")
    up, down = side(F.col("delta_soc") > 0), side(F.col("delta_soc") < 0)
    mean = lambda c: F.sum(c * weight) / F.sum(F.when(c.isNotNull(), weight))
    found = rows.groupBy(*keys).agg(F.count(up).alias("n_up"), F.count(down).alias("n_down"), mean(up).alias("up"), mean(down).alias("down"))
    charged = F.col("n_up") > 0
    return found.select(*keys, F.when(charged, F.col("up")).otherwise(F.col("down")).alias("kwh"), F.when(charged, F.col("n_up")).otherwise(F.col("n_down")).alias("n"), F.when(charged, "charge").when(F.col("n_down") > 0, "discharge").otherwise("none").alias("source"))


def ledger_average(ledger: DataFrame) -> DataFrame:
    """``vehicle_id, kwh``: mean over the periods with enough donors by their number, else over all with any."""
    good, any_ = F.col("n") >= RELIABLE_ROWS, F.col("n") > 0
    mean = lambda c: F.sum(F.when(c, F.col("kwh") * F.col("n"))) / F.sum(F.when(c, F.col("n")))
    return ledger.where(F.col("kwh").isNotNull()).groupBy("vehicle_id").agg(F.coalesce(mean(good), mean(any_)).alias("kwh"))


def upsert_ledger(ledger: DataFrame, periods: DataFrame) -> DataFrame:
    """The ledger with the periods' values; a period without a value leaves what was there."""
    fresh = periods.where("kwh is not null and n > 0").select("vehicle_id", "period", F.struct("kwh", "n").alias("new"))
    both = ledger.select("vehicle_id", "period", F.struct("kwh", "n").alias("old")).join(fresh, ["vehicle_id", "period"], "full")
    return both.select("vehicle_id", "period", F.coalesce("new", "old").alias("entry")).select("vehicle_id", "period", "entry.*")


def ledger_map(ledger: DataFrame) -> DataFrame:
    """One row for each vehicle with its periods as a map."""
    return ledger.groupBy("vehicle_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("period", F.struct("kwh", "n").alias("entry"))))).alias("periods"))


def seed_capacity(vehicles: DataFrame, ledger: DataFrame, period: str) -> DataFrame:
    """The capacity that estimates start from: this period's if reliable, the ledger's mean, the platform's, the nominal one."""
    own = ledger.where((F.col("period") == period) & (F.col("n") >= RELIABLE_ROWS)).select("vehicle_id", F.col("kwh").alias("own"))
    mean = ledger_average(ledger).withColumnRenamed("kwh", "mean")
    return vehicles.join(own, "vehicle_id", "left").join(mean, "vehicle_id", "left").withColumn("seed_kwh", F.coalesce("own", "mean", "platform_kwh", "nominal_kwh")).drop("own", "mean")


def _local_mean(rows: DataFrame, keys: list[str], asked: Column, sides: list[Column], into: str) -> DataFrame:
    """``rows`` with ``into``: where ``asked``, the mean of donors in the smallest window of 15, 30, 60 … days
    around ``ts`` that holds one, weighted by the change of charge. ``sides`` are conditions on donors in order of
    preference; the first that has any in reach gives the mean. No window is wider than 15 days or the span of
    all rows of a key. One shuffle by key: windows find how wide to look, running sums what lies in it.
    """
    own = Window.partitionBy(*keys)
    back, ahead = (own.orderBy(order).rangeBetween(Window.unboundedPreceding, 0) for order in (F.asc("__at"), F.desc("__at")))
    donor = F.coalesce(*(F.when(side & F.col("ts").isNotNull(), i) for i, side in enumerate(sides)))
    columns = rows.columns
    found = rows.withColumns({"__at": F.unix_micros("ts"), "__id": F.monotonically_increasing_id(), "__donor": donor, "__asked": F.coalesce(asked, F.lit(False)), "__w": F.abs(F.coalesce("delta_soc", F.lit(0.0)))})
    found = found.withColumn("__most", F.greatest(F.lit(15 * DAY), F.coalesce(F.max("__at").over(own) - F.min("__at").over(own), F.lit(0))))
    near = {}
    for i in range(len(sides)):
        at = F.when(F.col("__donor") == i, F.col("__at"))
        near[f"__near{i}"] = F.least(F.col("__at") - F.max(at).over(back), F.min(at).over(ahead) - F.col("__at"))
    found = found.withColumns(near)
    within = [F.when(F.col(f"__near{i}") <= F.col("__most"), F.col(f"__near{i}")) for i in range(len(sides))]
    found = found.withColumns({"__near": F.when(F.col("__asked"), F.coalesce(*within)), "__side": F.coalesce(*(F.when(x.isNotNull(), i) for i, x in enumerate(within)))})
    doubled = 15.0 * DAY * F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(F.greatest("__near", F.lit(1)) / (15.0 * DAY)))))
    half = F.least(F.col("__most").cast("double"), doubled).cast("long")
    # A row is itself a donor; a row that asks also marks both ends of its window, before and after the donors there.
    edge = lambda at, order: F.struct(at.alias("at"), F.lit(order).alias("order"))
    pieces = F.when(F.col("__near").isNotNull(), F.array(edge(F.col("__at"), 1), edge(F.col("__at") - half, 0), edge(F.col("__at") + half, 2))).otherwise(F.array(edge(F.col("__at"), 1)))
    spread = found.select(*keys, "__id", "__side", "__donor", "__w", F.struct(*columns).alias("__row"), F.explode(pieces).alias("__edge"))
    whole = F.col("__edge.order") == 1
    so_far = own.orderBy("__edge.at", "__edge.order").rowsBetween(Window.unboundedPreceding, 0)
    counts = whole & (F.col("__donor").isNotNull())
    sums = []
    for i in range(len(sides)):
        of = lambda x: F.coalesce(F.sum(F.when(counts & (F.col("__donor") == i), x)).over(so_far), F.lit(0.0))  # noqa: B023,E731
        sums.append(F.struct(of(F.col("__w") * F.col("__row.capacity_kwh")).alias("wc"), of(F.col("__w")).alias("w"), of(F.col("__row.capacity_kwh")).alias("c"), of(F.lit(1.0)).alias("n")))
    picked = F.coalesce(*(F.when(F.col("__side") == i, x) for i, x in enumerate(sums)))
    spread = spread.withColumns({"__sums": picked, "__row": F.when(whole, F.col("__row"))})
    at_edge = lambda order: F.max(F.when(F.col("__edge.order") == order, F.col("__sums")))
    back_together = spread.groupBy(*keys, "__id").agg(F.first("__row", True).alias("__row"), at_edge(2).alias("__top"), at_edge(0).alias("__low"))
    between = lambda x: F.col(f"__top.{x}") - F.col(f"__low.{x}")
    mean = F.when(between("w") > 0, between("wc") / between("w")).otherwise(between("c") / between("n"))
    return back_together.select("__row.*", F.when(F.col("__top").isNotNull(), mean).alias(into))


def _whole_mean(donor: Column, keys: list[str]) -> Column:
    """The donors' weighted mean over all of a key, as a window; the plain mean without weights."""
    own, weight = Window.partitionBy(*keys), F.coalesce(F.abs("delta_soc"), F.lit(0.0))
    total = F.sum(F.when(donor, weight)).over(own)
    return F.when(total > 0, F.sum(F.when(donor, weight * F.col("capacity_kwh"))).over(own) / total).otherwise(F.avg(F.when(donor, F.col("capacity_kwh"))).over(own))


def correct_estimates(rows: DataFrame, fallback_kwh: float | None = None, keys: list[str] | None = None) -> DataFrame:
    """Step 1: capacity and energy of rows estimated from the charge, from the donors near in time.

    ``rows``: ``keys`` (a vehicle's report), ts, delta_soc, capacity_kwh, energy_source, delta_kwh.
    Charges give the local mean if there are any, else discharges; a row without a time takes
    the mean of the whole report, charges first; a report without donors ``fallback_kwh``.
    """
    keys = keys or ["vehicle_id"]
    estimate = (F.col("energy_source") == "soc_estimate") & F.col("delta_soc").isNotNull()
    up, down = is_donor() & (F.col("delta_soc") > 0), is_donor() & (F.col("delta_soc") < 0)
    found = rows.withColumn("__whole", F.coalesce(_whole_mean(up, keys), _whole_mean(down, keys), F.lit(fallback_kwh).cast("double")))
    found = _local_mean(found, keys, estimate, [up, down], "__local")
    fixed = F.when(estimate, F.coalesce("__local", "__whole"))
    return found.withColumns({"delta_kwh": F.coalesce(F.col("delta_soc") / 100 * fixed, F.col("delta_kwh")), "capacity_kwh": F.coalesce(fixed, F.col("capacity_kwh"))}).select(*rows.columns)


def replace_outliers(rows: DataFrame, keys: list[str] | None = None, fallback: tuple[float, float] | None = None) -> DataFrame:
    """Step 2: capacities over one population deviation from the report's mean take the local mean of the others.

    Estimated rows take their energy from it as well. With ``fallback``, (least change of
    charge in per cent, least relative deviation), so do counted rows that pass both, and their
    source becomes ``soc_fallback``; otherwise a counter's energy stays. Under three
    capacities nothing changes. ``outlier`` marks the rows.
    """
    keys = keys or ["vehicle_id"]
    own, valid = Window.partitionBy(*keys), F.col("capacity_kwh").isNotNull()
    # Deviation and distance squared, times the count squared, over the least capacity: no root or quotient rounds, so
    # a whole capacity just one deviation off is none over it, in whatever order the rows come.
    x = F.col("capacity_kwh") - F.min("capacity_kwh").over(own)
    found = rows.withColumns({"__mean": F.avg("capacity_kwh").over(own), "__x": x, "__n": F.count("capacity_kwh").over(own)})
    found = found.withColumns({"__sum": F.sum("__x").over(own), "__squares": F.sum(F.col("__x") * F.col("__x")).over(own)})
    off = F.col("__n") * F.col("__x") - F.col("__sum")
    far = off * off > F.col("__n") * F.col("__squares") - F.col("__sum") * F.col("__sum")
    found = found.withColumn("outlier", F.coalesce(valid & (F.col("__n") >= 3) & far, F.lit(False)))
    inlier = valid & ~F.col("outlier") & F.coalesce(F.col("energy_source") != "soc_fallback", F.lit(True))
    found = found.withColumn("__whole", F.coalesce(_whole_mean(inlier & F.col("ts").isNotNull(), keys), F.col("__mean")))
    found = _local_mean(found, keys, F.col("outlier"), [inlier], "__local")
    new = F.coalesce("__local", "__whole")
    estimate = (F.col("energy_source") == "soc_estimate") & (F.col("delta_soc") != 0)
    distrusted = F.lit(False)
    if fallback:
        least_soc, least_off = fallback
        distrusted = F.coalesce(F.coalesce(F.col("energy_source") != "soc_estimate", F.lit(True)) & (F.abs("delta_soc") >= least_soc) & (new > 0) & (F.abs(F.col("capacity_kwh") - new) / new >= least_off), F.lit(False))
    again = F.col("outlier") & (F.coalesce(estimate, F.lit(False)) | distrusted)
    return found.withColumns({
        "delta_kwh": F.when(again, F.col("delta_soc") / 100 * new).otherwise(F.col("delta_kwh")),
        "energy_source": F.when(F.col("outlier") & distrusted, "soc_fallback").otherwise(F.col("energy_source")),
        "capacity_kwh": F.when(F.col("outlier"), new).otherwise(F.col("capacity_kwh")),
    }).select(*rows.columns, "outlier")
