"""The registered queries over the supplied tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S
from ..operators import capacity as C
from ..operators import clean, enrich, islands, joins, mass, measure, sequence
from ..operators.grade import grade, grade_tally
from ..sources import telematics as src
from ..sources.fixture_tables import TELEMATICS_SQL, telematics
from ..sources.store import stored
from .ev import ev_report, trip_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The tables are sparse in time, so stops and tolerances are hours where vehicles have minutes.
TRIPS = {"threshold": 20.0, "min_stop_min": 360.0, "min_trip_min": 2.0, "max_extend_min": 360.0}
CHARGES = {"plateau_min": 720.0, "min_rise": 5.0}
DISCHARGES = {"plateau_min": 720.0, "rise_abort": 2.0, "min_drop": 5.0}
ID = ["vehicle_id", "leg_id", "seg"]


def query(name: str, *sql: str):
    """Register a query; ``sql`` is its common table expressions and its last SELECT."""

    def add(f):
        QUERIES[name] = f
        if sql:
            *parts, last = sql
            ORACLE_SQL[name] = ("WITH " + ",\n".join(parts) if parts else "") + "\n" + last
        return f

    return add


def us(column: str):
    return F.unix_micros(column)


def trips_of(rows: DataFrame) -> DataFrame:
    return islands.speed_trips(rows, **TRIPS).withColumn("seg", us("motion_start_ts"))


def charges_of(rows: DataFrame) -> DataFrame:
    return islands.charge_blocks(rows, **CHARGES)


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Times as whole microseconds."""
    times = {f.name for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.select(*(us(c).alias(c.replace("_ts", "_us")) if c in times else F.col(c) for c in columns))


TRIPS_SQL = f"""{TELEMATICS_SQL.strip()}, trips AS (
    SELECT vehicle_id, leg_id, seg,
           CASE WHEN seg - zero_before <= 21600000000 THEN zero_before ELSE seg END AS start_us,
           CASE WHEN zero_after - motion_end <= 21600000000 THEN zero_after ELSE motion_end END AS end_us
    FROM (
        SELECT vehicle_id, leg_id, min(a) AS seg, max(b) AS motion_end, arg_min_null(zero_before, a) AS zero_before, arg_max_null(zero_after, b) AS zero_after
        FROM (
            SELECT *, sum(CASE WHEN gap IS NULL OR gap > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id, leg_id ORDER BY a) AS trip
            FROM (
                SELECT *, a - lag(b) OVER (PARTITION BY vehicle_id, leg_id ORDER BY a) AS gap
                FROM (
                    SELECT vehicle_id, leg_id, island, min(us) AS a, max(us) AS b, arg_min_null(zero_before, us) AS zero_before, arg_max_null(zero_after, us) AS zero_after
                    FROM (
                        SELECT *, sum(CASE WHEN moving AND NOT coalesce(was, false) THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id, leg_id ORDER BY us, row_no) AS island
                        FROM (
                            SELECT *, speed > 20 AS moving, lag(speed > 20) OVER w AS was,
                                   last_value(CASE WHEN speed = 0 THEN us END IGNORE NULLS) OVER (PARTITION BY vehicle_id, leg_id ORDER BY us, row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS zero_before,
                                   first_value(CASE WHEN speed = 0 THEN us END IGNORE NULLS) OVER (PARTITION BY vehicle_id, leg_id ORDER BY us, row_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS zero_after
                            FROM t WINDOW w AS (PARTITION BY vehicle_id, leg_id ORDER BY us, row_no)
                        )
                    ) WHERE moving GROUP BY ALL
                )
            )
        ) GROUP BY vehicle_id, leg_id, trip
    ) WHERE motion_end - seg >= 120000000
)"""


def blocks_sql(name: str, sign: int, plateau_us: int, join: str, least: int) -> str:
    return f"""{name} AS (
    SELECT vehicle_id, leg_id, min(a_us) AS start_us, max(b_us) AS end_us, arg_min(a_soc, a_us) AS start_soc, arg_max(b_soc, b_us) AS end_soc
    FROM (
        SELECT *, sum(CASE WHEN first_on - prev_b <= {plateau_us} AND {join} THEN 0 ELSE 1 END) OVER (PARTITION BY vehicle_id, leg_id ORDER BY first_on) AS block
        FROM (
            SELECT *, lag(b_us) OVER v AS prev_b, coalesce(lag(against) OVER v, 0) AS prev_against
            FROM (
                SELECT vehicle_id, leg_id, island, min(CASE WHEN go THEN us END) AS first_on, max(CASE WHEN go THEN us END) AS b_us,
                       arg_min(p_us, us) FILTER (go) AS a_us, arg_min(p_soc, us) FILTER (go) AS a_soc, arg_max(soc, us) FILTER (go) AS b_soc,
                       coalesce(max(CASE WHEN NOT go THEN greatest(-d, 0) END), 0) AS against
                FROM (
                    SELECT *, sum(CASE WHEN go AND NOT coalesce(was, false) THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id, leg_id ORDER BY us, row_no) AS island
                    FROM (
                        SELECT *, coalesce(d > 0, false) AS go, lag(coalesce(d > 0, false)) OVER (PARTITION BY vehicle_id, leg_id ORDER BY us, row_no) AS was
                        FROM (SELECT *, (soc - lag(soc) OVER w) * {sign} AS d, lag(soc) OVER w AS p_soc, lag(us) OVER w AS p_us FROM t WHERE soc IS NOT NULL WINDOW w AS (PARTITION BY vehicle_id, leg_id ORDER BY us, row_no))
                    )
                ) WHERE island > 0 GROUP BY vehicle_id, leg_id, island
            ) WINDOW v AS (PARTITION BY vehicle_id, leg_id ORDER BY first_on)
        )
    ) GROUP BY vehicle_id, leg_id, block
    HAVING (arg_max(b_soc, b_us) - arg_min(a_soc, a_us)) * {sign} >= {least}
)"""


CHARGES_SQL = blocks_sql("charges", 1, 43_200_000_000, "prev_against = 0", 5)
TRIP_COLUMNS = ["vehicle_id", "leg_id", "start_ts", "end_ts"]


@query("n1_speed_trips", TRIPS_SQL, "SELECT vehicle_id, leg_id, start_us, end_us FROM trips")
def _(spark, d):
    return shown(trips_of(telematics(spark, d)), *TRIP_COLUMNS)


BLOCK = [*TRIP_COLUMNS, "start_soc", "end_soc"]


@query("n3_charge_blocks", TELEMATICS_SQL, CHARGES_SQL, "SELECT * FROM charges")
def _(spark, d):
    return shown(charges_of(telematics(spark, d)), *BLOCK)


@query("n4_discharge_blocks", TELEMATICS_SQL, blocks_sql("falls", -1, 43_200_000_000, "prev_against < 2", 5), "SELECT * FROM falls")
def _(spark, d):
    return shown(islands.discharge_blocks(telematics(spark, d), **DISCHARGES), *BLOCK)


@query("n15_stop_rows", TRIPS_SQL, """SELECT vehicle_id, end_us AS stop_start_us, nxt AS stop_end_us FROM (
    SELECT vehicle_id, end_us, lead(start_us) OVER (PARTITION BY vehicle_id ORDER BY start_us, end_us) AS nxt FROM trips) WHERE nxt - end_us > 60000000""")
def _(spark, d):
    stops = islands.stop_rows(trips_of(telematics(spark, d)))
    return stops.select("vehicle_id", us("stop_start").alias("stop_start_us"), us("stop_end").alias("stop_end_us"))


def _asof(direction: str):
    def run(spark, d):
        rows = telematics(spark, d)
        at = trips_of(rows).select(*src.LEG, "seg", F.col("start_ts" if direction == "backward" else "end_ts").alias("at"))
        return shown(joins.as_of(at, rows, "total_wh", ["seg"], direction), "vehicle_id", "seg", "total_wh", "total_wh_ts")

    return run


query("j1_asof_before", TRIPS_SQL, "SELECT trips.vehicle_id, seg, k.wh AS total_wh, k.us AS total_wh_us FROM trips ASOF LEFT JOIN (SELECT * FROM t WHERE wh IS NOT NULL) k ON trips.vehicle_id = k.vehicle_id AND trips.start_us >= k.us")(_asof("backward"))
query("j1_asof_after", TRIPS_SQL, "SELECT trips.vehicle_id, seg, k.wh AS total_wh, k.us AS total_wh_us FROM trips ASOF LEFT JOIN (SELECT * FROM t WHERE wh IS NOT NULL) k ON trips.vehicle_id = k.vehicle_id AND trips.end_us <= k.us")(_asof("forward"))


@query("j3_asof_nearest", TRIPS_SQL, """b AS (SELECT trips.vehicle_id, seg, k.wh AS v0, seg - k.us AS d0 FROM trips ASOF LEFT JOIN (SELECT * FROM t WHERE wh IS NOT NULL) k ON trips.vehicle_id = k.vehicle_id AND seg >= k.us)""",
    """f AS (SELECT trips.vehicle_id, seg, k.wh AS v1, k.us - seg AS d1 FROM trips ASOF LEFT JOIN (SELECT * FROM t WHERE wh IS NOT NULL) k ON trips.vehicle_id = k.vehicle_id AND seg <= k.us)""",
    """SELECT vehicle_id, seg, CASE WHEN d0 <= 7200000000 AND NOT coalesce(d1 < d0, false) THEN v0 WHEN d1 <= 7200000000 THEN v1 END AS total_wh FROM b JOIN f USING (vehicle_id, seg)""")
def _(spark, d):
    rows = telematics(spark, d)
    at = trips_of(rows).select(*src.LEG, "seg", F.col("motion_start_ts").alias("at"))
    return joins.as_of_nearest(at, rows, "total_wh", ["seg"], tolerance_min=120).select("vehicle_id", "seg", "total_wh")


SPIKES_SQL = """k AS (
    SELECT *, last_value(CASE WHEN trigger_type = 'TIMER' THEN soc END IGNORE NULLS) OVER (PARTITION BY vehicle_id, leg_id ORDER BY us, row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b,
           first_value(CASE WHEN trigger_type = 'TIMER' THEN soc END IGNORE NULLS) OVER (PARTITION BY vehicle_id, leg_id ORDER BY us, row_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a,
           min(soc) OVER (PARTITION BY vehicle_id, leg_id ORDER BY us RANGE BETWEEN 7200000000 PRECEDING AND 7200000000 FOLLOWING) AS low
    FROM t)"""


@query("f2_event_spikes", TELEMATICS_SQL, SPIKES_SQL, """SELECT row_no, CASE WHEN coalesce(trigger_type <> 'TIMER' AND soc - b >= 3 AND soc - a >= 3
    AND NOT (abs(b - a) >= least(soc - b, soc - a) AND NOT (soc - low >= 3)), false) THEN NULL ELSE soc END AS soc FROM k""")
def _(spark, d):
    return clean.blank_soc_spikes(telematics(spark, d), 3.0, within_min=120).select("row_no", "soc")


@query("f1_odometer_clean")
def _(spark, d):
    rows = telematics(spark, d)
    replay = F.when(F.pmod(F.col("row_no"), F.lit(37)) == 0, F.col("odometer_km") * 0.5).otherwise(F.col("odometer_km"))
    return clean.clean_odometer(rows.withColumn("odometer_km", replay.cast("double"))).select("row_no", "odometer_km")


OTHER_SQL = "o AS (SELECT vehicle_id, row_no AS uri, us - 3600000000 AS o_start, us + 3600000000 AS o_end, CAST(speed AS DECIMAL(18,2)) AS energy FROM t WHERE trigger_type = 'PURCHASE')"


def _sessions(rows: DataFrame) -> DataFrame:
    hour = F.expr("interval 1 hour")
    return rows.where("trigger_type = 'PURCHASE'").select("vehicle_id", F.col("row_no").alias("uri"), (F.col("ts") - hour).alias("o_start"), (F.col("ts") + hour).alias("o_end"), F.col("speed_kmh").cast("decimal(18,2)").alias("energy_kwh"), F.col("row_no").alias("list_order"))


@query("j4_overlap_first", TRIPS_SQL, OTHER_SQL, """SELECT trips.vehicle_id, seg, min(uri) AS uri FROM trips LEFT JOIN o ON o.vehicle_id = trips.vehicle_id AND o_start <= end_us + 240000000 AND o_end >= start_us - 240000000 GROUP BY ALL""")
def _(spark, d):
    rows = telematics(spark, d)
    return joins.first_overlap(trips_of(rows), _sessions(rows), ["vehicle_id"], ["vehicle_id", "seg"], 4.0).select("vehicle_id", "seg", "uri")


@query("j5_overlap_sum", TRIPS_SQL, OTHER_SQL, """SELECT trips.vehicle_id, seg, arg_min(uri, o_start) AS uri, CAST(sum(energy) AS DOUBLE) AS energy_kwh FROM trips LEFT JOIN o ON o.vehicle_id = trips.vehicle_id AND o_start <= end_us + 240000000 AND o_end >= start_us - 240000000 GROUP BY trips.vehicle_id, seg""")
def _(spark, d):
    rows = telematics(spark, d)
    found = joins.all_overlaps(trips_of(rows), _sessions(rows).drop("list_order"), ["vehicle_id"], ["vehicle_id", "seg"], 4.0)
    return found.select("vehicle_id", "seg", "uri", F.col("energy_kwh").cast("double").alias("energy_kwh"))


@query("j6_point_in_interval", TRIPS_SQL, """SELECT trips.vehicle_id, seg, CAST(count(*) AS BIGINT) AS n, min(t.row_no) AS first_row, max(soc) AS max_soc FROM trips JOIN t ON t.vehicle_id = trips.vehicle_id AND us BETWEEN start_us AND end_us GROUP BY ALL""")
def _(spark, d):
    rows = telematics(spark, d)
    return joins.in_interval(rows, trips_of(rows), ID).groupBy("vehicle_id", "seg").agg(F.count("*").alias("n"), F.min("row_no").alias("first_row"), F.max("soc").alias("max_soc"))


@query("n7_interval_subtract", TRIPS_SQL, CHARGES_SQL, """x AS (SELECT trips.vehicle_id, seg, trips.start_us, trips.end_us, c.start_us AS cs, c.end_us AS ce FROM trips JOIN charges c ON c.vehicle_id = trips.vehicle_id AND c.start_us < trips.end_us AND c.end_us > trips.start_us)""",
    """y AS (SELECT *, greatest(start_us, coalesce(max(ce) OVER (PARTITION BY vehicle_id, seg ORDER BY cs, ce ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), start_us)) AS cursor FROM x)""",
    """SELECT vehicle_id, seg, cursor AS part_start_us, cs AS part_end_us FROM y WHERE cs > cursor
    UNION ALL SELECT vehicle_id, seg, max(ce), end_us FROM x GROUP BY vehicle_id, seg, end_us HAVING max(ce) < end_us
    UNION ALL SELECT vehicle_id, seg, start_us, end_us FROM trips WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.vehicle_id = trips.vehicle_id AND x.seg = trips.seg)""")
def _(spark, d):
    rows = telematics(spark, d)
    charges = charges_of(rows).select(*src.LEG, F.col("start_ts").alias("c_start"), F.col("end_ts").alias("c_end"))
    parts = joins.subtract_intervals(trips_of(rows).select(*ID, "start_ts", "end_ts"), charges, ["seg"])
    return parts.select("vehicle_id", "seg", us("part_start").alias("part_start_us"), us("part_end").alias("part_end_us"))


@query("j10_boundary_reconcile", TRIPS_SQL, CHARGES_SQL, """x AS (SELECT c.vehicle_id, c.start_us AS seg, c.start_us, c.end_us, p.start_us AS ts, p.end_us AS te FROM charges c LEFT JOIN trips p ON p.vehicle_id = c.vehicle_id AND p.start_us < c.end_us AND p.end_us > c.start_us)""",
    """y AS (SELECT vehicle_id, seg, start_us, end_us, min(CASE WHEN ts >= start_us AND te > end_us THEN ts END) AS ne, max(CASE WHEN te <= end_us AND ts < start_us THEN te END) AS ns, coalesce(bool_or((ts >= start_us AND te <= end_us) OR (ts < start_us AND te > end_us)), true) AS holds FROM x GROUP BY ALL)""",
    """SELECT vehicle_id, seg, CASE WHEN holds OR coalesce(ns, start_us) >= coalesce(ne, end_us) THEN start_us ELSE coalesce(ns, start_us) END AS start_us, CASE WHEN holds OR coalesce(ns, start_us) >= coalesce(ne, end_us) THEN end_us ELSE coalesce(ne, end_us) END AS end_us FROM y""")
def _(spark, d):
    rows = telematics(spark, d)
    charges = charges_of(rows).withColumn("seg", us("start_ts"))
    trips = trips_of(rows).select(*src.LEG, F.col("start_ts").alias("o_start"), F.col("end_ts").alias("o_end"))
    return shown(joins.reconcile_charges(charges, trips, ["seg"]), "vehicle_id", "seg", "start_ts", "end_ts")


BETWEEN_SQL = """g AS (SELECT *, lag(end_us) OVER (PARTITION BY vehicle_id ORDER BY start_us, end_us) AS gap FROM trips),
    cb AS (SELECT g.*, EXISTS (SELECT 1 FROM charges c WHERE c.vehicle_id = g.vehicle_id AND g.gap < g.start_us AND c.start_us < g.start_us AND c.end_us > g.gap) AS between_ FROM g)"""


@query("j8_charge_between", TRIPS_SQL, CHARGES_SQL, BETWEEN_SQL, "SELECT vehicle_id, seg, between_ AS charge_between FROM cb")
def _(spark, d):
    rows = telematics(spark, d)
    charges = charges_of(rows).select(*src.LEG, F.col("start_ts").alias("o_start"), F.col("end_ts").alias("o_end"))
    return joins.charge_between(trips_of(rows), charges).select("vehicle_id", "seg", "charge_between")


# Mass: lineitem's quantities as readings of suppliers.
MASS_SQL = "s AS (SELECT l_suppkey AS vehicle_id, l_quantity * 1000 AS m, l_shipdate AS ts, l_orderkey * 10 + l_linenumber AS row_no, l_discount * 100 AS v, l_tax FROM lineitem)"


def _mass_rows(spark, d):
    items = spark.read.parquet(f"{d}/lineitem.parquet")
    return items.select(F.col("l_suppkey").alias("vehicle_id"), F.lit(0).cast("long").alias("leg_id"), (F.col("l_quantity") * 1000).alias("mass_kg"), F.col("l_shipdate").cast("timestamp").alias("ts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"), (F.col("l_discount") * 100).alias("speed_kmh"))


KEPT_SQL = {
    "none": ["kept AS (SELECT * FROM s0)"],
    "iqr": ["q AS (SELECT vehicle_id, quantile_cont(m, 0.25) AS a, quantile_cont(m, 0.75) AS b FROM s0 GROUP BY 1)", "kept AS (SELECT s0.* FROM s0 JOIN q USING (vehicle_id) WHERE b <= a OR m BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a))"],
    "mad": ["q AS (SELECT vehicle_id, median(m) AS a, mad(m) AS b FROM s0 GROUP BY 1)", "kept AS (SELECT s0.* FROM s0 JOIN q USING (vehicle_id) WHERE b <= 0 OR m BETWEEN a - 3 * b AND a + 3 * b)"],
    "trimmed": ["r AS (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY m, ts, row_no) AS r, count(*) OVER (PARTITION BY vehicle_id) AS n FROM s0)", "kept AS (SELECT * FROM r WHERE r > floor(n * 0.2) AND r <= n - floor(n * 0.2))"],
}
S0 = "s0 AS (SELECT * FROM (SELECT *, sum(CASE WHEN v > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id) AS nm FROM s WHERE m > 0) WHERE nm < 2 OR v > 1)"
MEANS = {"mean": "avg(m)", "median": "median(m)"}


def _mass_query(method: str):
    fence = method.split("_")[0] if "_" in method else "none"
    if method == "mad_tw_mean":
        parts = [*KEPT_SQL["mad"], "tw AS (SELECT *, (coalesce(lead(epoch(ts)) OVER w, epoch(ts)) - coalesce(lag(epoch(ts)) OVER w, epoch(ts))) / 2 AS w FROM kept WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, row_no))"]
        value, table = "sum(w * m) / sum(w)", "tw"
    else:
        parts, value, table = KEPT_SQL[fence], MEANS["median" if method.endswith("median") else "mean"], "kept"

    def run(spark, d):
        found = mass.mass_estimate(mass.moving_samples(_mass_rows(spark, d), ["vehicle_id"]), ["vehicle_id"], method)
        whole = lambda c, k: F.floor(F.col(c) * k + 0.5).cast("long")
        return found.select("vehicle_id", "n_kept", whole("mass_kg", 100).alias("mass_centi"), whole("mass_cv", 1e6).alias("cv_micro"))

    query(f"a1_mass_{method}", MASS_SQL, S0, *parts, f"SELECT vehicle_id, CAST(count(*) AS BIGINT) AS n_kept, CAST(floor({value} * 100 + 0.5) AS BIGINT) AS mass_centi, CAST(floor(stddev_samp(m) / avg(m) * 1e6 + 0.5) AS BIGINT) AS cv_micro FROM {table} GROUP BY vehicle_id")(run)


for _method in mass.ESTIMATORS:
    _mass_query(_method)

CLASSES_SQL = """mg AS (SELECT *, sum(CASE WHEN mass - p >= 4000 THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id ORDER BY mass ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM (SELECT vehicle_id, mass, lag(mass) OVER (PARTITION BY vehicle_id ORDER BY mass) AS p FROM t WHERE mass > 0 AND speed > 1)),
    mc AS (SELECT vehicle_id, row_number() OVER (PARTITION BY vehicle_id ORDER BY g) - 1 AS i, avg(mass) AS c FROM mg GROUP BY vehicle_id, g),
    ml AS (SELECT t.vehicle_id, t.row_no, arg_min(mc.i, [abs(mc.c - mass), mc.i]) AS i FROM t JOIN mc USING (vehicle_id) WHERE mass > 0 GROUP BY ALL),
    lab AS (SELECT t.*, CAST(CASE WHEN ml.i = 0 AND (SELECT c FROM mc WHERE mc.vehicle_id = t.vehicle_id AND mc.i = 0) < 13000 THEN NULL ELSE ml.i END AS INTEGER) AS mass_class FROM t LEFT JOIN ml USING (vehicle_id, row_no))"""


def _classed(spark, d):
    return mass.mass_classes(telematics(spark, d))


@query("n8_mass_classes", TELEMATICS_SQL, CLASSES_SQL, "SELECT row_no, mass_class FROM lab")
def _(spark, d):
    return _classed(spark, d).select("row_no", F.col("mass_class").cast("int").alias("mass_class"))


@query("n9_dominant_class", TRIPS_SQL, CLASSES_SQL, """z AS (SELECT trips.vehicle_id, seg, mass_class, speed FROM trips JOIN lab ON lab.vehicle_id = trips.vehicle_id AND us BETWEEN start_us AND end_us)""",
    """c AS (SELECT vehicle_id, seg, mass_class, count(*) FILTER (speed > 1) AS nm, count(*) AS n FROM z WHERE mass_class IS NOT NULL GROUP BY ALL)""",
    """SELECT p.vehicle_id, p.seg, (SELECT mass_class FROM c WHERE c.vehicle_id = p.vehicle_id AND c.seg = p.seg ORDER BY nm DESC, CASE WHEN nm > 0 THEN 0 ELSE n END DESC, mass_class LIMIT 1) AS mass_class FROM (SELECT DISTINCT vehicle_id, seg FROM z) p""")
def _(spark, d):
    rows = _classed(spark, d)
    samples = joins.in_interval(rows, trips_of(rows), ID)
    return mass.dominant_class(samples, ID).select("vehicle_id", "seg", F.col("mass_class").cast("int").alias("mass_class"))


@query("n10_class_changes", TRIPS_SQL, CLASSES_SQL, """st AS (SELECT *, max(CASE WHEN coalesce(speed, 0) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id ORDER BY us RANGE BETWEEN 43200000000 PRECEDING AND 43200000000 FOLLOWING) AS near FROM lab)""",
    """SELECT vehicle_id, seg, us AS split_us, p AS from_class, mass_class AS to_class FROM (SELECT trips.vehicle_id, seg, us, mass_class, near, lag(mass_class) OVER (PARTITION BY trips.vehicle_id, seg ORDER BY us, row_no) AS p FROM trips JOIN st ON st.vehicle_id = trips.vehicle_id AND us BETWEEN start_us AND end_us WHERE speed > 1 AND mass_class IS NOT NULL) WHERE p <> mass_class AND near = 1""")
def _(spark, d):
    rows = _classed(spark, d)
    # The standing sample may lie outside the trip, so the window runs over the leg first.
    samples = joins.in_interval(mass.standing_near(rows, 1440), trips_of(rows), ID)
    changed = mass.class_changes(samples, ID)
    return changed.select("vehicle_id", "seg", us("split_ts").alias("split_us"), F.col("from_class").cast("int").alias("from_class"), F.col("to_class").cast("int").alias("to_class"))


@query("n12_merge_adjacent", TRIPS_SQL, CHARGES_SQL, BETWEEN_SQL, """mm AS (SELECT *, lag(seg % 3) OVER w AS pc, lag(end_us) OVER w AS pe FROM cb WINDOW w AS (PARTITION BY vehicle_id ORDER BY start_us, end_us))""",
    """gg AS (SELECT *, sum(CASE WHEN start_us - pe < 172800000000 AND seg % 3 = pc AND NOT between_ THEN 0 ELSE 1 END) OVER (PARTITION BY vehicle_id ORDER BY start_us, end_us) AS grp FROM mm)""",
    """SELECT vehicle_id, min(start_us) AS start_us, max(end_us) AS end_us, CAST(count(*) AS BIGINT) AS n_parts FROM gg GROUP BY vehicle_id, grp""")
def _(spark, d):
    rows = telematics(spark, d)
    charges = charges_of(rows).select(*src.LEG, F.col("start_ts").alias("o_start"), F.col("end_ts").alias("o_end"))
    trips = joins.charge_between(trips_of(rows), charges).withColumns({"mass_class": F.col("seg") % 3, "energy_source": F.lit("total_energy"), "delta_kwh": F.lit(-1.0)})
    return shown(islands.merge_adjacent(trips, 2880), "vehicle_id", "start_ts", "end_ts", "n_parts")


#: Trips with energies, sources and anchors that differ from each other, so that what stays can be told from what is cut.
ANCHORED_SQL = """an AS (SELECT vehicle_id, seg, start_us, end_us, CASE WHEN seg % 5 = 0 THEN 'soc_estimate' WHEN seg % 7 = 0 THEN 'distance_only' ELSE 'total_energy' END AS src, -CAST(seg % 97 + 1 AS DOUBLE) AS kwh, -CAST(seg % 41 AS DOUBLE) AS ds, CAST(seg % 89 + 100 AS DOUBLE) AS cap, seg % 3 = 0 AS outside,
    start_us AS a0, CASE WHEN seg % 11 <> 0 THEN end_us + 86400000000 END AS a1, CAST(seg % 1000 AS DOUBLE) AS e0, CAST(seg % 1000 + 50 AS DOUBLE) AS e1 FROM trips)"""


@query("n14_anchor_clamp", TRIPS_SQL, ANCHORED_SQL, """us_ AS (SELECT *, src NOT IN ('soc_estimate', 'distance_only') AND a1 IS NOT NULL AS usable FROM an)""",
    """ld AS (SELECT *, lead(a0) OVER w AS n0, lead(e0) OVER w AS ne, lead(usable) OVER w AS nu FROM us_ WHERE src <> 'distance_only' WINDOW w AS (PARTITION BY vehicle_id ORDER BY start_us, end_us))""",
    """cl AS (SELECT *, coalesce(usable AND nu AND a1 > n0 AND e0 - ne < 0, false) AS cut FROM ld)""",
    """SELECT vehicle_id, seg, CASE WHEN cut THEN n0 ELSE a1 END AS anchor_end_us, CASE WHEN cut THEN ne ELSE e1 END AS anchor_end_kwh, CASE WHEN cut THEN e0 - ne ELSE kwh END AS delta_kwh, CASE WHEN cut AND ds <> 0 AND NOT outside THEN abs(e0 - ne) / (abs(ds) / 100) ELSE cap END AS capacity_kwh FROM cl
    UNION ALL SELECT vehicle_id, seg, a1, e1, kwh, cap FROM an WHERE src = 'distance_only'""")
def _(spark, d):
    seg, number = F.col("seg"), lambda c: c.cast("double")
    trips = trips_of(telematics(spark, d)).withColumns({
        "energy_source": F.when(seg % 5 == 0, "soc_estimate").when(seg % 7 == 0, "distance_only").otherwise("total_energy"), "delta_kwh": -number(seg % 97 + 1), "delta_soc": -number(seg % 41), "capacity_kwh": number(seg % 89 + 100), "outside_band": seg % 3 == 0,
        "anchor_start_ts": F.col("start_ts"), "anchor_end_ts": F.when(seg % 11 != 0, F.col("end_ts") + F.expr("interval 1 day")), "anchor_start_kwh": number(seg % 1000), "anchor_end_kwh": number(seg % 1000 + 50)})
    return shown(islands.clamp_anchors(trips), "vehicle_id", "seg", "anchor_end_ts", "anchor_end_kwh", "delta_kwh", "capacity_kwh")


@query("a8_interpolated", TRIPS_SQL, """b AS (SELECT trips.vehicle_id, seg, k.wh AS v0, k.us AS t0 FROM trips ASOF LEFT JOIN (SELECT * FROM t WHERE wh IS NOT NULL) k ON trips.vehicle_id = k.vehicle_id AND seg >= k.us)""",
    """f AS (SELECT trips.vehicle_id, seg, k.wh AS v1, k.us AS t1 FROM trips ASOF LEFT JOIN (SELECT * FROM t WHERE wh IS NOT NULL) k ON trips.vehicle_id = k.vehicle_id AND seg <= k.us)""",
    """SELECT vehicle_id, seg, CASE WHEN t0 = t1 THEN CAST(v0 AS DOUBLE) ELSE CAST(v0 AS DOUBLE) + (CAST(v1 AS DOUBLE) - CAST(v0 AS DOUBLE)) * CAST(seg - t0 AS DOUBLE) / CAST(t1 - t0 AS DOUBLE) END AS total_wh FROM b JOIN f USING (vehicle_id, seg)""")
def _(spark, d):
    rows = telematics(spark, d)
    at = trips_of(rows).select(*src.LEG, "seg", F.col("motion_start_ts").alias("at"))
    return measure.interpolated_at(at, rows, "total_wh", ["seg"], "at").select("vehicle_id", "seg", "total_wh")


@query("a10_kinetics", TELEMATICS_SQL, """v AS (SELECT vehicle_id, us, row_no, greatest(0, least(100, speed)) AS v FROM t)""", """s3 AS (SELECT *, list_sort(list_filter([lag(v) OVER w, v, lead(v) OVER w], lambda x: x IS NOT NULL)) AS l FROM v WINDOW w AS (PARTITION BY vehicle_id ORDER BY us, row_no))""",
    """sm AS (SELECT *, (CASE len(l) WHEN 3 THEN l[2] WHEN 2 THEN (l[1] + l[2]) / 2 ELSE l[1] END) / 3.6 AS s FROM s3)""", """ch AS (SELECT vehicle_id, (pow(lead(s) OVER (PARTITION BY vehicle_id ORDER BY us, row_no), 2) - pow(s, 2)) * 0.5 AS c FROM sm)""",
    """SELECT vehicle_id, CAST(floor(sum(20000 * CASE WHEN c >= 0 THEN c / 0.9 ELSE c * 0.9 END) / 3.6e6 * 1000 + 0.5) AS BIGINT) AS kinetic_wh FROM ch GROUP BY 1""")
def _(spark, d):
    found = measure.kinetic_kwh(telematics(spark, d), ["vehicle_id"], 20_000.0)
    return found.select("vehicle_id", F.floor(F.col("kinetic_kwh") * 1000 + 0.5).cast("long").alias("kinetic_wh"))


@query("a11_counter_change", TRIPS_SQL, """SELECT trips.vehicle_id, seg, CASE WHEN count(wh) >= 2 THEN max(wh) - min(wh) END AS change_wh, CASE WHEN count(wh) >= 2 THEN (max(wh) - min(wh)) / 1000 END AS spread FROM trips JOIN t ON t.vehicle_id = trips.vehicle_id AND us BETWEEN start_us AND end_us GROUP BY ALL""")
def _(spark, d):
    rows = telematics(spark, d)
    inside = joins.in_interval(rows, trips_of(rows), ID)
    return inside.groupBy("vehicle_id", "seg").agg(measure.counter_change("total_wh").alias("change_wh"), measure.spread("total_wh").alias("spread"))


# Capacity: events as report rows, a month for each period.
CAP_SQL = """c AS (SELECT user_id AS vehicle_id, event_id AS row_no, epoch_us(ts) AS us, CAST(floor(value) AS BIGINT) % 40 + 1 AS w, (CASE WHEN event_type IN ('view', 'error') THEN 1 ELSE -1 END) * (CAST(floor(value) AS BIGINT) % 40 + 1) AS ds, CAST(300 + CAST(floor(value * 7) AS BIGINT) % 97 AS DOUBLE) AS cap, CASE WHEN event_type IN ('signup', 'error') THEN 'soc_estimate' WHEN event_type = 'view' THEN 'ac_dc' ELSE 'total_energy' END AS src FROM events)"""


def _capacity_rows(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    change = (F.floor("value") % 40 + 1) * F.when(F.col("event_type").isin("view", "error"), 1).otherwise(-1)
    source = F.when(F.col("event_type").isin("signup", "error"), "soc_estimate").when(F.col("event_type") == "view", "ac_dc").otherwise("total_energy")
    return events.select(F.col("user_id").alias("vehicle_id"), F.lit("month").alias("leg_id"), F.col("event_id").alias("row_no"), "ts", change.cast("double").alias("delta_soc"), (300 + F.floor(F.col("value") * 7) % 97).cast("double").alias("capacity_kwh"), source.alias("energy_source"), F.lit(None).cast("double").alias("delta_kwh"))


PERIOD_SQL = """pc AS (SELECT vehicle_id, count(*) FILTER (ds > 0) AS nu, count(*) FILTER (ds < 0) AS nd, sum(cap * w) FILTER (ds > 0) / sum(w) FILTER (ds > 0) AS u, sum(cap * w) FILTER (ds < 0) / sum(w) FILTER (ds < 0) AS dn FROM c WHERE src <> 'soc_estimate' GROUP BY 1)"""


@query("a15_period_capacity", CAP_SQL, PERIOD_SQL, "SELECT vehicle_id, CASE WHEN nu > 0 THEN u ELSE dn END AS kwh, CASE WHEN nu > 0 THEN nu ELSE nd END AS n, CASE WHEN nu > 0 THEN 'charge' WHEN nd > 0 THEN 'discharge' ELSE 'none' END AS source FROM pc")
def _(spark, d):
    return C.period_capacity(_capacity_rows(spark, d), ["vehicle_id"])


def local_sql(name: str, table: str, asked: str, donors: list[str]) -> list[str]:
    """Rows of ``table`` that ask, with the mean ``v`` of the first of ``donors`` that there are, all pairs compared."""
    near = ", ".join(f"min(abs(x.us - e.us)) FILTER ({d}) AS n{i}" for i, d in enumerate(donors))
    side = "CASE " + " ".join(f"WHEN n{i} IS NOT NULL THEN {i}" for i in range(len(donors))) + " END"
    is_side = " OR ".join(f"(side = {i} AND {d})" for i, d in enumerate(donors))
    return [
        f"{name}s AS (SELECT vehicle_id, greatest(1296000000000, max(us) - min(us)) AS most FROM {table} GROUP BY 1)",
        f"{name}n AS (SELECT e.vehicle_id, e.row_no, e.us, {near} FROM {table} e JOIN {table} x USING (vehicle_id) WHERE e.{asked} GROUP BY ALL)",
        f"{name}h AS (SELECT n.*, {side} AS side, CAST(least(most, 1296000000000 * pow(2, greatest(0, ceil(log2(greatest(coalesce({', '.join(f'n{i}' for i in range(len(donors)))}), 1) / 1296000000000))))) AS BIGINT) AS half FROM {name}n n JOIN {name}s USING (vehicle_id))",
        f"{name} AS (SELECT h.row_no, CASE WHEN sum(abs(x.ds)) > 0 THEN sum(x.cap * abs(x.ds)) / sum(abs(x.ds)) ELSE avg(x.cap) END AS v FROM {name}h h JOIN {table} x ON x.vehicle_id = h.vehicle_id AND abs(x.us - h.us) <= half WHERE {is_side} GROUP BY 1)",
    ]


#: Users differ in what gives their capacity: charges, discharges only, or nothing.
SOURCES_SQL = "c1 AS (SELECT * REPLACE (CASE WHEN vehicle_id % 3 > 0 AND src = 'ac_dc' THEN 'soc_estimate' WHEN vehicle_id % 3 = 2 AND vehicle_id % 2 = 0 THEN 'soc_estimate' ELSE src END AS src) FROM c), c2 AS (SELECT *, src = 'soc_estimate' AS est FROM c1)"
STEP1_SQL = [CAP_SQL, SOURCES_SQL, *local_sql("lc", "c2", "est", ["NOT x.est AND x.ds > 0", "NOT x.est AND x.ds < 0"]), "st1 AS (SELECT c2.*, CASE WHEN est THEN coalesce(v, 280) ELSE cap END AS cap1, CASE WHEN est THEN ds / 100 * coalesce(v, 280) END AS kwh1 FROM c2 LEFT JOIN lc USING (row_no))"]


def _sourced(spark, d):
    user, source = F.col("vehicle_id"), F.col("energy_source")
    return _capacity_rows(spark, d).withColumn("energy_source", F.when((user % 3 > 0) & (source == "ac_dc"), "soc_estimate").when((user % 3 == 2) & (user % 2 == 0), "soc_estimate").otherwise(source))


@query("a17_local_capacity", *STEP1_SQL, "SELECT row_no, cap1 AS capacity_kwh, kwh1 AS delta_kwh FROM st1")
def _(spark, d):
    return C.correct_estimates(_sourced(spark, d), 280.0).select("row_no", "capacity_kwh", "delta_kwh")


#: Whole capacities, so that who is an outlier doesn't hang on the order of a sum.
OUTLIER_SQL = [CAP_SQL, """mm AS (SELECT vehicle_id, avg(cap) AS m, stddev_pop(cap) AS s, count(*) AS n FROM c GROUP BY 1)""", """oc AS (SELECT c.*, n >= 3 AND abs(cap - m) > s AS bad, m FROM c JOIN mm USING (vehicle_id))""", *local_sql("lo", "oc", "bad", ["NOT x.bad"]),
    """fx AS (SELECT oc.*, coalesce(v, m) AS new, bad AND src <> 'soc_estimate' AND abs(ds) >= 10 AND abs(cap - coalesce(v, m)) / coalesce(v, m) >= 0.1 AS back FROM oc LEFT JOIN lo USING (row_no))"""]


@query("a17_outliers", *OUTLIER_SQL, "SELECT row_no, bad AS outlier, CASE WHEN bad THEN new ELSE cap END AS capacity_kwh, CASE WHEN bad AND (src = 'soc_estimate' OR back) THEN ds / 100 * new END AS delta_kwh, CASE WHEN back THEN 'soc_fallback' ELSE src END AS energy_source FROM fx")
def _(spark, d):
    return C.replace_outliers(_capacity_rows(spark, d), fallback=(10.0, 0.1)).select("row_no", "outlier", "capacity_kwh", "delta_kwh", "energy_source")


LEDGER_SQL = "SELECT vehicle_id, coalesce(sum(kwh * n) FILTER (n >= 5) / sum(n) FILTER (n >= 5), sum(kwh * n) FILTER (n > 0) / sum(n) FILTER (n > 0)) AS kwh FROM l GROUP BY 1"
LEDGER = "l AS (SELECT o_custkey AS vehicle_id, o_orderstatus || o_orderpriority AS period, CAST(max(o_orderkey) AS DOUBLE) AS kwh, count(*) AS n FROM orders GROUP BY 1, 2)"


def _ledger(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.groupBy(F.col("o_custkey").alias("vehicle_id"), F.concat("o_orderstatus", "o_orderpriority").alias("period")).agg(F.max("o_orderkey").cast("double").alias("kwh"), F.count("*").alias("n"))


@query("a16_ledger_average", LEDGER, LEDGER_SQL)
def _(spark, d):
    return C.ledger_average(_ledger(spark, d))


@query("l1_ledger_upsert", LEDGER, "SELECT vehicle_id, period, CASE WHEN period LIKE 'F%' THEN kwh + 1 ELSE kwh END AS kwh, CASE WHEN period LIKE 'F%' THEN n + 1 ELSE n END AS n FROM l")
def _(spark, d):
    ledger = _ledger(spark, d)
    return C.upsert_ledger(ledger, ledger.where("period like 'F%'").selectExpr("vehicle_id", "period", "kwh + 1 as kwh", "n + 1 as n"))


@query("l3_seed_capacity", LEDGER, "avg_ AS (" + LEDGER_SQL + ")", """SELECT v.c_custkey AS vehicle_id, coalesce(o.kwh, a.kwh, CASE WHEN c_custkey % 2 = 0 THEN 500.0 END, 300.0) AS seed_kwh FROM customer v LEFT JOIN avg_ a ON a.vehicle_id = c_custkey LEFT JOIN (SELECT * FROM l WHERE period = 'F1-URGENT' AND n >= 5) o ON o.vehicle_id = c_custkey""")
def _(spark, d):
    vehicles = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("vehicle_id"), F.when(F.col("c_custkey") % 2 == 0, 500.0).alias("platform_kwh"), F.lit(300.0).alias("nominal_kwh"))
    return C.seed_capacity(vehicles, _ledger(spark, d), "F1-URGENT").select("vehicle_id", "seed_kwh")


# Grades: line items as graded segments.
GRADE_SQL = """g AS (SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_returnflag = 'A' THEN 'soc_estimate' WHEN l_linestatus = 'O' THEN 'total_energy' ELSE 'distance_only' END AS src, l_quantity AS e, l_quantity / 2 AS soc, l_quantity * 2 - 1 AS km, l_quantity * (0.7 + l_discount * 6) AS counter, l_tax * 60 AS okm, l_discount * 300 AS omin, l_tax * 100 AS dkm, CAST(l_orderkey % 3 AS BIGINT) AS odo, l_discount * 20 AS quantum, l_tax * 200 AS step, l_discount * 6000 AS rate, 150 + l_tax * 1000 AS ref FROM lineitem)"""


def _graded(spark, d):
    items = spark.read.parquet(f"{d}/lineitem.parquet").withColumn("q", F.col("l_quantity"))
    rows = items.select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.when(F.col("l_returnflag") == "A", "soc_estimate").when(F.col("l_linestatus") == "O", "total_energy").otherwise("distance_only").alias("energy_source"),
        (-F.col("q")).alias("delta_kwh"), (-F.col("q") / 2).alias("delta_soc"), (F.col("q") * 2 - 1).alias("distance_km"), (F.col("q") * (0.7 + F.col("l_discount") * 6)).alias("counter_kwh"), (F.col("l_tax") * 60).alias("outside_km"), (F.col("l_discount") * 300).alias("outside_min"),
        (F.col("l_tax") * 100).alias("dist_outside_km"), (F.col("l_orderkey") % 3).alias("odo_samples"), F.lit(5).alias("samples"), (F.col("l_discount") * 20).alias("soc_quantum"), (F.col("l_tax") * 200).alias("step_pct"), (F.col("l_discount") * 6000).alias("step_rate"), (150 + F.col("l_tax") * 1000).alias("referee_kwh"),
        F.lit("2024-01-01").cast("timestamp").alias("start_ts"), F.lit("2024-01-01 01:00:00").cast("timestamp").alias("end_ts"))
    return grade(rows.withColumn("ep", measure.energy_performance(F.col("delta_kwh"), F.col("distance_km"))))


FINDINGS_SQL = """s AS (SELECT *, src = 'total_energy' AS ct, src = 'soc_estimate' AS es, e / nullif(counter, 0) AS r, quantum / soc AS res, abs(e - soc / 100 * ref) / (soc / 100 * ref) AS ci, e / km AS ep FROM g),
    sv AS (SELECT *, [CASE WHEN ct THEN (r > 1.3)::INT + (r > 1.05)::INT ELSE 0 END, CASE WHEN ct THEN (r < 0.8)::INT ELSE 0 END, CASE WHEN ct THEN (okm / km > 0.1)::INT + (okm / km > 0.3)::INT ELSE 0 END,
        CASE WHEN ct THEN (omin / 60 * 3 / e > 0.1)::INT + (omin / 60 * 3 / e > 0.3)::INT ELSE 0 END, (dkm / km > 0.1)::INT + (dkm / km > 0.3)::INT, CASE WHEN odo = 0 THEN 2 ELSE 0 END, CASE WHEN es THEN (res > 0.1)::INT + (res > 0.25)::INT ELSE 0 END,
        CASE WHEN es AND rate > 300 THEN (step / soc >= 0.25)::INT + (step / soc >= 0.5)::INT ELSE 0 END, CASE WHEN ct AND soc >= 10 AND res <= 0.1 THEN (ci > 0.3)::INT + (ci > 0.6)::INT ELSE 0 END, (km < 3)::INT + (km < 1)::INT, (km > 95)::INT + (km > 105)::INT,
        greatest((ep < 0.15)::INT + (ep < 0.08)::INT, (ep > 4)::INT + (ep > 8)::INT)] AS f FROM s),
    gr AS (SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN src <> 'distance_only' THEN ['good', 'caution', 'poor'][list_max(f) + 1] END AS grade, CASE WHEN src <> 'distance_only' THEN CAST(len(list_filter(f, lambda x: x > 0)) AS INTEGER) ELSE 1 END AS n_reasons FROM sv)"""


@query("g_ep_grade", GRADE_SQL, FINDINGS_SQL, "SELECT l_orderkey, l_linenumber, grade, n_reasons FROM gr")
def _(spark, d):
    n = F.when(F.col("reason") == "", 0).otherwise(F.size(F.split("reason", "; ")))
    return _graded(spark, d).select("l_orderkey", "l_linenumber", "grade", n.alias("n_reasons"))


@query("a26_grade_tally", GRADE_SQL, FINDINGS_SQL, "SELECT l_returnflag, grade, count(*) AS n FROM gr WHERE grade IS NOT NULL GROUP BY ALL")
def _(spark, d):
    return grade_tally(_graded(spark, d), ["l_returnflag"])


@query("a18_soc_quantum", TELEMATICS_SQL, """q AS (SELECT vehicle_id, CAST(rint AS BIGINT) AS step FROM (SELECT vehicle_id, round(abs(soc - lag(soc) OVER (PARTITION BY vehicle_id ORDER BY us, row_no)) * 1000) AS rint FROM t WHERE soc IS NOT NULL) WHERE rint > 0)""",
    "SELECT vehicle_id, CASE WHEN count(*) >= 20 AND list_reduce(list(DISTINCT step), lambda a, b: gcd(a, b)) <= 5000 THEN list_reduce(list(DISTINCT step), lambda a, b: gcd(a, b)) / 1000 END AS soc_quantum FROM q GROUP BY 1")
def _(spark, d):
    return sequence.soc_quantum(telematics(spark, d)).select("vehicle_id", "soc_quantum")


#: The machine by recursion over each user's readings, after a median of five.
PEDAL_SQL = ["""v5 AS (SELECT vehicle_id, row_number() OVER (PARTITION BY vehicle_id ORDER BY us, row_no) - 1 AS i, CASE WHEN count(*) OVER w = 5 THEN median(speed) OVER w END AS m FROM t WINDOW w AS (PARTITION BY vehicle_id ORDER BY us, row_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))""",
    """y AS (SELECT vehicle_id, i, coalesce(m, first_value(m IGNORE NULLS) OVER (PARTITION BY vehicle_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(m IGNORE NULLS) OVER (PARTITION BY vehicle_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS v FROM v5)""",
    """st AS (SELECT vehicle_id, i, false AS ev, v AS low, i AS low_at, v AS peak, i AS peak_at, -1000000000 AS ended, NULL::DOUBLE AS hit FROM y WHERE i = 0
    UNION ALL SELECT n.vehicle_id, n.i, CASE WHEN NOT ev THEN n.v - least(low, n.v) >= 10 ELSE greatest(peak, n.v) - n.v < 8 END, CASE WHEN NOT ev THEN least(low, n.v) WHEN greatest(peak, n.v) - n.v >= 8 THEN n.v ELSE low END, CASE WHEN NOT ev AND n.v < low OR ev AND greatest(peak, n.v) - n.v >= 8 THEN n.i ELSE low_at END,
        CASE WHEN NOT ev THEN n.v ELSE greatest(peak, n.v) END, CASE WHEN NOT ev OR n.v > peak THEN n.i ELSE peak_at END, CASE WHEN ev AND greatest(peak, n.v) - n.v >= 8 AND (CASE WHEN n.v > peak THEN n.i ELSE peak_at END) - low_at + 1 >= 2 AND n.i - ended >= 3 THEN n.i ELSE ended END,
        CASE WHEN ev AND greatest(peak, n.v) - n.v >= 8 AND (CASE WHEN n.v > peak THEN n.i ELSE peak_at END) - low_at + 1 >= 2 AND n.i - ended >= 3 THEN greatest(peak, n.v) END FROM st JOIN y n ON n.vehicle_id = st.vehicle_id AND n.i = st.i + 1)"""]


@query("n17_pedal_histogram", "RECURSIVE " + TELEMATICS_SQL.strip(), *PEDAL_SQL, "SELECT vehicle_id, " + " || ',' || ".join(f"CAST(count(*) FILTER (least(floor(hit / 10), 9) = {i}) AS VARCHAR)" for i in range(10)) + " AS histogram FROM st WHERE hit IS NOT NULL GROUP BY 1")
def _(spark, d):
    return sequence.pedal_histograms(telematics(spark, d), "speed_kmh", ["vehicle_id"], smooth=5, least_width=2, least_apart=3)


@query("a20_chart_fit", """SELECT l_suppkey, count(*) AS n, CAST(floor(regr_slope(l_extendedprice, l_quantity) * 1000 + 0.5) AS BIGINT) AS slope_milli, CAST(floor(regr_intercept(l_extendedprice, l_quantity) * 100 + 0.5) AS BIGINT) AS intercept_centi, CAST(floor(regr_r2(l_extendedprice, l_quantity) * 1e6 + 0.5) AS BIGINT) AS r2_micro FROM lineitem GROUP BY 1""")
def _(spark, d):
    fit = enrich.chart_fit(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_suppkey"], "l_quantity", "l_extendedprice")
    whole = lambda c, k, name: F.floor(F.col(c) * k + 0.5).cast("long").alias(name)
    return fit.select("l_suppkey", "n", whole("slope", 1000, "slope_milli"), whole("intercept", 100, "intercept_centi"), whole("r2", 1e6, "r2_micro"))


WEATHER_SQL = "e AS (SELECT user_id AS vehicle_id, event_id AS row_no, epoch_us(ts) AS us, floor(value) AS x, event_type AS kind FROM events)"


@query("a23_weather_fine", WEATHER_SQL, """k AS (SELECT vehicle_id, kind, row_number() OVER (PARTITION BY vehicle_id ORDER BY count(*) DESC, min(us)) AS r FROM e GROUP BY vehicle_id, kind)""",
    """SELECT e.vehicle_id, avg(x) AS temperature, CAST(floor((degrees(atan2(avg(sin(radians(x))), avg(cos(radians(x))))) + 360) * 1e4 + 0.5) AS BIGINT) % 3600000 AS wind_1e4, any_value(k.kind) AS weather_kind FROM e JOIN k ON k.vehicle_id = e.vehicle_id AND r = 1 GROUP BY 1""")
def _(spark, d):
    x = F.col("speed_kmh")
    rows = telematics(spark, d).join(spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("row_no"), F.col("event_type").alias("kind")), "row_no")
    found = enrich.fine_weather(rows.withColumns({"temperature": x, "pressure": x, "humidity": x, "wind_speed": x, "wind_deg": x}), ["vehicle_id"])
    return found.select("vehicle_id", "temperature", (F.floor(F.col("wind_deg") * 1e4 + 0.5).cast("long") % 3_600_000).alias("wind_1e4"), "weather_kind")


@query("p_scalars", """SELECT c_custkey, ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][CAST(round_even(c_custkey * 9.0 / 45, 0) AS BIGINT) % 8 + 1] AS compass, CASE WHEN c_acctbal > 5000 AND c_custkey % 7 >= 3 THEN 'Mix charge' WHEN c_acctbal > 5000 THEN 'AC charge' ELSE 'DC charge' END AS charge,
    CASE WHEN c_custkey % 4 = 0 THEN CASE WHEN c_custkey % 10 > 5 THEN 'Round Trip' ELSE 'In House' END WHEN c_custkey % 4 = 1 THEN 'Outbound' WHEN c_custkey % 4 = 2 THEN 'Return' ELSE 'In Transit' END AS leg_type FROM customer""")
def _(spark, d):
    k = F.col("c_custkey")
    rows = spark.read.parquet(f"{d}/customer.parquet")
    ac, dc = F.when(F.col("c_acctbal") > 5000, 1.0).otherwise(0.0), F.when(k % 7 >= 3, 1.0).otherwise(0.0)
    start, end = (k % 4).isin(0, 1), (k % 4).isin(0, 2)
    return rows.select("c_custkey", S.cardinal(k * 9.0).alias("compass"), S.charge_type(ac, dc).alias("charge"), S.leg_type(F.lit("trip"), ac, dc, start, end, (k % 10).cast("double")).alias("leg_type"))


@query("snk6_transactions_upsert", "SELECT o_orderkey AS uri, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS energy_kwh FROM orders")
def _(spark, d):
    old = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("uri"), F.col("o_orderdate").cast("timestamp").alias("start_ts"), F.col("o_totalprice").alias("energy_kwh"))
    return src.upsert_transactions(old, old.where("uri % 3 = 0").withColumn("energy_kwh", F.col("energy_kwh") + 1)).select("uri", "energy_kwh")


@query("f12_dated_setting", """w AS (SELECT c_custkey AS vehicle_id, DATE '1992-01-01' + CAST(c_custkey % 900 AS INTEGER) AS a, DATE '1992-01-01' + CAST(c_custkey % 900 + 1200 AS INTEGER) AS b FROM customer)""",
    "SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) >= a AND CAST(o_orderdate AS DATE) < b THEN 'set' END AS value FROM orders LEFT JOIN w ON vehicle_id = o_custkey")
def _(spark, d):
    base = F.lit("1992-01-01").cast("date")
    settings = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("vehicle_id"), F.date_add(base, (F.col("c_custkey") % 900).cast("int")).alias("valid_from"), F.date_add(base, (F.col("c_custkey") % 900 + 1200).cast("int")).alias("valid_to"), F.lit("set").alias("value"))
    rows = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("vehicle_id"), F.to_date("o_orderdate").alias("leg_date"))
    return joins.dated_setting(rows, settings).select("o_orderkey", "value")


@query("src6_charger_meter", "SELECT o_custkey AS vehicle_id, o_orderkey AS uri, epoch_us(o_orderdate) AS us, o_totalprice AS meter_kwh FROM orders UNION ALL SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) + 3600000000, o_totalprice + 5 FROM orders")
def _(spark, d):
    start = F.col("o_orderdate").cast("timestamp")
    tx = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("vehicle_id"), F.col("o_orderkey").alias("uri"), start.alias("start_ts"), (start + F.expr("interval 1 hour")).alias("end_ts"), F.col("o_totalprice").alias("start_meter_kwh"), (F.col("o_totalprice") + 5).alias("end_meter_kwh"))
    return src.charger_meter(tx).select("vehicle_id", "uri", us("ts").alias("us"), "meter_kwh")


@query("src4_first_channel", "x AS (SELECT *, min(list_position(['purchase', 'click', 'view'], event_type)) OVER (PARTITION BY user_id) AS best FROM events WHERE event_type IN ('purchase', 'click', 'view'))", "SELECT event_id AS row_no, event_type AS channel FROM x WHERE list_position(['purchase', 'click', 'view'], event_type) = best")
def _(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").alias("vehicle_id"), F.lit(0).alias("leg_id"), F.col("event_id").alias("row_no"), F.col("event_type").alias("channel"))
    return src.first_channel(events, ["purchase", "click", "view"]).select("row_no", "channel")


DIESEL_SQL = """dz AS (SELECT l_suppkey AS vehicle_id, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS seg, l_quantity - 1 AS km, CASE WHEN l_discount > 0 THEN l_discount * 100 END AS fuel, CASE WHEN l_tax > 0.05 THEN l_tax * 1e5 END AS own, CASE WHEN l_returnflag = 'R' THEN 1.0 END AS temp FROM lineitem)"""


@query("f8_diesel_trips", DIESEL_SQL, """SELECT vehicle_id, seg, coalesce(own, last_value(own IGNORE NULLS) OVER (PARTITION BY vehicle_id ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS mass_kg, fuel * 10 AS fuel_kwh, fuel / km * 100 AS l_per_100km FROM dz WHERE km >= 1 AND (fuel IS NOT NULL OR own IS NOT NULL OR temp IS NOT NULL)""")
def _(spark, d):
    items = spark.read.parquet(f"{d}/lineitem.parquet")
    seg = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")
    trips = items.select(F.col("l_suppkey").alias("vehicle_id"), F.lit(0).alias("leg_id"), seg.alias("seg"), seg.alias("start_ts"), (F.col("l_quantity") - 1).alias("distance_km"), F.when(F.col("l_discount") > 0, F.col("l_discount") * 100).alias("fuel_l"), F.when(F.col("l_tax") > 0.05, F.col("l_tax") * 1e5).alias("own_mass_kg"), F.when(F.col("l_returnflag") == "R", 1.0).alias("temperature_c"))
    return measure.diesel_trips(trips).select("vehicle_id", "seg", "mass_kg", "fuel_kwh", "l_per_100km")


MEASURE_SQL = """tr AS (SELECT p.vehicle_id, p.start_us, p.end_us, (SELECT odo FROM t WHERE t.vehicle_id = p.vehicle_id AND us <= p.start_us ORDER BY us DESC, row_no DESC LIMIT 1) AS o0, (SELECT odo FROM t WHERE t.vehicle_id = p.vehicle_id AND us >= p.end_us ORDER BY us, row_no LIMIT 1) AS o1,
    (SELECT wh FROM t WHERE wh IS NOT NULL AND t.vehicle_id = p.vehicle_id AND us <= p.start_us ORDER BY us DESC, row_no DESC LIMIT 1) AS w0, (SELECT wh FROM t WHERE wh IS NOT NULL AND t.vehicle_id = p.vehicle_id AND us >= p.end_us ORDER BY us, row_no LIMIT 1) AS w1 FROM trips p)"""


@query("trip_report", TRIPS_SQL, MEASURE_SQL, """SELECT vehicle_id, start_us, end_us, CAST(o1 - o0 AS DOUBLE) AS distance_km, CASE WHEN w0 < w1 THEN CAST(w0 - w1 AS DOUBLE) / 1000 END AS delta_kwh, CASE WHEN o1 > o0 AND w0 < w1 THEN CAST(w1 - w0 AS DOUBLE) / 1000 / (o1 - o0) END AS ep_kwh_km, CASE WHEN o1 > o0 AND end_us > start_us THEN CAST(o1 - o0 AS DOUBLE) / ((end_us - start_us) / 3.6e9) END AS avg_speed_kmh FROM tr""")
def trip_report(spark, d):
    rows = telematics(spark, d)
    return shown(trip_rows(rows, trips_of(rows)), "vehicle_id", "start_ts", "end_ts", "distance_km", "delta_kwh", "ep_kwh_km", "avg_speed_kmh")


EV = {"trip_options": TRIPS, "charge_options": CHARGES, "block_options": DISCHARGES, "spike_pct": 3.0, "confirmed_km": 0.5, "split_by_mass": True, "merge_gap_min": 360.0, "reconcile": True}


@query("ev_report")
def _(spark, d):
    from .segment_queries import LIMITS, full

    rows, user = stored(full(spark, d)), F.col("vehicle_id")  # samples, legs, sessions and logger all come from these
    legs = rows.select(*src.LEG).distinct().withColumns({"leg_uri": F.concat(F.lit("https://fleet.example/api/legs/"), user.cast("string")), "operator": F.when(user % 3 > 0, F.concat(F.lit("OP_"), (user % 3).cast("string")))})
    named = lambda kind: _sessions(rows).withColumn("uri", F.concat(F.lit(f"https://fleet.example/api/{kind}/"), F.col("uri").cast("string")))
    report = ev_report(rows, legs=legs, chargers=named("charger"), loggers=named("logger"), logger_speed=rows.where(user % 2 == 0).select(*src.LEG, "ts", "row_no", "speed_kmh"), fallback=(10.0, 0.3), limits=LIMITS, block_limits=LIMITS, **EV)
    return shown(report, *report.columns)


from . import diesel_queries, patch_queries, raw_queries, report_queries, segment_queries, source_queries  # noqa: E402,F401  register their own
