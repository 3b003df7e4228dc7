"""Weather, operators, charts and home: columns that later data add to report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import weather_key


def missing_weather(asked: DataFrame, cache: DataFrame) -> DataFrame:
    """The distinct keys that the cache doesn't hold."""
    return asked.select(weather_key("lat", "lon", "ts").alias("key")).where("key is not null").distinct().join(cache, "key", "left_anti")


def circular_mean(degrees: Column) -> Column:
    """Aggregate: mean direction, 0 to 360."""
    angle = F.radians(degrees)
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(angle)), F.avg(F.cos(angle)))), F.lit(360.0))


def fine_weather(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Means over a trip's samples, the circular mean of the wind, the most frequent type (first seen on ties)."""
    means = samples.groupBy(*keys).agg(*(F.avg(n).alias(n) for n in ("temperature", "pressure", "humidity", "wind_speed")), circular_mean(F.col("wind_deg")).alias("wind_deg"))
    kinds = samples.where("kind is not null").groupBy(*keys, "kind").agg(F.count("*").alias("n"), F.min(F.struct("ts", "row_no")).alias("first"))
    most = Window.partitionBy(*keys).orderBy(F.desc("n"), "first")
    top = kinds.withColumn("r", F.row_number().over(most)).where("r = 1").select(*keys, F.col("kind").alias("weather_kind"))
    return means.join(top, keys, "left")


def chart_fit(points: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """``keys, n, slope, intercept, r2`` of a line through the points; null for under two points or one x; r2 is 0 on a flat line."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    fit = points.where(both).groupBy(*keys).agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_syy(y, x).alias("syy"))
    return fit.withColumn("r2", F.when(F.col("slope").isNull(), None).when(F.col("syy") == 0, 0.0).otherwise(F.col("r2"))).drop("syy")


def fill_missing(rows: DataFrame, found: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``rows`` with what ``found`` knows in the cells that are still empty; running it again changes nothing."""
    new = found.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns))
    return rows.join(new, keys, "left").withColumns({c: F.coalesce(c, f"__{c}") for c in columns}).drop(*(f"__{c}" for c in columns))


def logger_means(samples: DataFrame, keys: list[str], least_mass: int = 5) -> DataFrame:
    """Weather means of a window and, from five readings on, the median mass and its variation."""
    mass = F.when(F.col("mass_kg") > 0, F.col("mass_kg"))
    enough = F.count(mass) >= least_mass
    return samples.groupBy(*keys).agg(F.avg("temperature").alias("temperature"), F.avg("pressure").alias("pressure"), F.avg("humidity").alias("humidity"), F.when(enough, F.median(mass)).alias("mass_kg"), F.when(enough, F.stddev_samp(mass) / F.avg(mass)).alias("mass_cv"))


def home_points(rows: DataFrame) -> DataFrame:
    """``vehicle_id, home_leg, home_lat, home_lon``: where the first located charge stood, by leg and then segment."""
    located = rows.where((F.col("kind") == "charge") & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    first = located.groupBy("vehicle_id").agg(F.min(F.struct("leg_id", "seg_no", "lat", "lon")).alias("h"))
    return first.select("vehicle_id", F.col("h.leg_id").alias("home_leg"), F.col("h.lat").alias("home_lat"), F.col("h.lon").alias("home_lon"))


def relabel_home(rows: DataFrame, within_km: float = 0.5) -> DataFrame:
    """``rows`` with ``at_home`` for charges, and ``start_home`` and ``end_home`` for trips (lat_start, ... lon_end).

    Home is where the vehicle's first located charge stood. All its charges within
    ``within_km`` are at home; trips only in legs after the one of that charge.
    """
    from ..functions.scalars import distance_km

    marked = rows.join(home_points(rows), "vehicle_id", "left")
    near = lambda lat, lon: F.coalesce(distance_km(F.col(lat), F.col(lon), F.col("home_lat"), F.col("home_lon")) < within_km, F.lit(False))
    charge, later = F.col("kind") == "charge", F.coalesce(F.col("leg_id") > F.col("home_leg"), F.lit(False))
    new = {"at_home": F.when(charge, near("lat", "lon"))}
    if "lat_start" in rows.columns:
        new |= {"start_home": F.when(~charge, later & near("lat_start", "lon_start")), "end_home": F.when(~charge, later & near("lat_end", "lon_end"))}
    return marked.withColumns(new).drop("home_leg", "home_lat", "home_lon")


def nearest_place(points: DataFrame, places: DataFrame, ident: list[str], within_km: float = 0.5) -> DataFrame:
    """``points`` (lat, lon) with the ``postcode`` of the nearest of ``places`` (lat, lon, postcode) within reach, null if none.

    Both sides meet in cells of a hundredth of a degree of latitude and as many kilometres of
    longitude, by bands of a degree: a point looks in the cells around it, in the band's own
    width, and near a band's edge in the next band as well, so no latitude loses a place.
    Points and places that share their coordinates meet once, the place by its least postcode.
    """
    from ..functions.scalars import distance_km

    row = lambda lat: F.floor(lat * 100).cast("long")
    steps = int(within_km / 1.1) + 1  # a cell is over 1.1 km high
    around = F.array(*(F.lit(i) for i in range(-steps, steps + 1)))
    # A cell's width in degrees at its band's far edge, where a degree is shortest; at the poles one cell is all round.
    width = lambda y: 0.01 / F.greatest(F.cos(F.radians(F.least(F.greatest(F.abs(F.floor(y / 100)), F.abs(F.floor(y / 100) + 1)), F.lit(89.9)))), F.lit(0.002))
    count = lambda y: F.ceil(360 / width(y)).cast("long")
    column = lambda lon, y: F.pmod(F.floor(F.pmod(lon, F.lit(360.0)) / width(y)).cast("long"), count(y))
    known = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    at = points.where(known).select(F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon")).distinct()
    at = at.withColumn("y", F.explode(F.transform(around, lambda i: row(F.col("p_lat")) + i)))
    at = at.withColumn("x", F.explode(F.array_distinct(F.transform(around, lambda i: F.pmod(column(F.col("p_lon"), F.col("y")) + i, count(F.col("y")))))))
    places = places.where(known).groupBy("lat", "lon").agg(F.min("postcode").alias("postcode"), F.count("*").alias("n"), F.count("postcode").alias("n_named"))
    # A place without a postcode comes before those at the same coordinates.
    places = places.withColumn("postcode", F.when(F.col("n") == F.col("n_named"), F.col("postcode")))
    spread = places.select("postcode", "lat", "lon", row(F.col("lat")).alias("y")).withColumn("x", column(F.col("lon"), F.col("y")))
    met = at.join(spread, ["y", "x"]).withColumn("km", distance_km(F.col("p_lat"), F.col("p_lon"), F.col("lat"), F.col("lon"))).where(F.col("km") <= within_km)
    best = met.groupBy("p_lat", "p_lon").agg(F.min(F.struct("km", "postcode")).alias("best")).select("p_lat", "p_lon", F.col("best.postcode").alias("postcode"))
    found = points.where(known).join(best, (points["lat"] == F.col("p_lat")) & (points["lon"] == F.col("p_lon")), "left").drop("p_lat", "p_lon")
    # Points without coordinates stay out of the join, where they would all be one task's.
    return found.unionByName(points.where(~known).withColumn("postcode", F.lit(None).cast(places.schema["postcode"].dataType)))


def leg_operator(legs: DataFrame, tokens: DataFrame, organisations: DataFrame, settings: DataFrame, makers: list[str], generic: tuple[str, ...] = (), known: tuple[str, ...] = ()) -> DataFrame:
    """``legs`` (vehicle_id, leg_id, trial_desc, organisation, leg_date) with ``operator``, ``operator_source`` and ``operator_unknown``.

    The operator is that of the trial's description, else the organisation's, else the setting whose
    dates hold the leg's day. A token that ``tokens`` (token, code) lacks gives itself in capitals
    with underscores; an organisation gives only what ``organisations`` (name, code) has, and
    ``generic`` ones nothing. Of ``settings`` (vehicle_id, place, valid_from, valid_to, code) the first
    by ``place`` counts; a single operator is one with open dates, placed last. Unknown are
    codes that aren't in ``known``, and legs without any.
    """
    from ..functions.scalars import operator_token, upper_snake

    plain = lambda c: F.lower(F.trim(F.col(c)))
    once = lambda df, name, key, code: df.groupBy(plain(name).alias(key)).agg(F.min("code").alias(code))
    rows = legs.withColumns({"__token": operator_token(F.col("trial_desc"), makers), "__org": plain("organisation")}).withColumn("__key", F.lower("__token"))
    rows = rows.join(once(tokens, "token", "__key", "__known"), "__key", "left")
    rows = rows.join(once(organisations, "name", "__org", "__org_code").where(~F.col("__org").isin(*generic) if generic else F.lit(True)), "__org", "left")
    dated = legs.select("vehicle_id", "leg_id", "leg_date").join(settings.where(F.trim("code") != ""), "vehicle_id")
    dated = dated.where((F.col("valid_from").isNull() | (F.col("valid_from") <= F.col("leg_date"))) & (F.col("valid_to").isNull() | (F.col("leg_date") < F.col("valid_to"))))
    dated = dated.groupBy("vehicle_id", "leg_id").agg(F.min_by(F.trim("code"), "place").alias("__dated"))
    rows = rows.join(dated, ["vehicle_id", "leg_id"], "left").withColumn("__trial", F.coalesce("__known", F.nullif(upper_snake(F.col("__token")), F.lit(""))))
    source = F.when(F.col("__trial").isNotNull(), "trial").when(F.col("__org_code").isNotNull(), "organisation").when(F.col("__dated").isNotNull(), "config").otherwise("none")
    code = F.coalesce("__trial", "__org_code", "__dated")
    return rows.select(*legs.columns, code.alias("operator"), source.alias("operator_source"), (~F.coalesce(code.isin(*known) if known else F.lit(False), F.lit(False))).alias("operator_unknown"))
