"""How far an efficiency figure can be trusted: one finding for each check, the worst one grades."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of caution and poor, by check; sources and gates of the checks.
LIMITS = {
    "DUP_ENERGY": (1.05, 1.30), "SPLIT_ALLOC": (0.80, None), "ENERGY_WINDOW": (0.10, 0.30), "IDLE_WINDOW": (0.10, 0.30), "DIST_WINDOW": (0.10, 0.30),
    "SOC_RES": (0.10, 0.25), "SOC_STEP": (0.25, 0.50), "CAP_INCONS": (0.30, 0.60), "SHORT_DIST": (3.0, 1.0), "SPEED": (95.0, 105.0), "EP_LOW": (0.15, 0.08), "EP_HIGH": (4.0, 8.0),
}
# Checks whose values are bad above their limits (SOC_STEP at them), and the code that two of them share.
ABOVE = {"DUP_ENERGY", "ENERGY_WINDOW", "IDLE_WINDOW", "DIST_WINDOW", "DIST_EXTRAP", "SOC_RES", "SOC_STEP", "CAP_INCONS", "SPEED", "EP_HIGH"}
CODES = {"EP_LOW": "EP_RANGE", "EP_HIGH": "EP_RANGE"}
IDLE_KW, STEP_RATE, GATE_SOC, GATE_RES = 3.0, 300.0, 10.0, 0.10
COUNTERS, ESTIMATES = ("total_energy", "moving_energy"), ("soc_estimate", "soc_fallback")


def _limit(check: str, level: int) -> float | None:
    """The limit of caution (0) or poor (1) that a finding's value is beyond; SOC_STEP finds at its limit, so beyond the number before it."""
    limit = LIMITS.get(check, (-2.0, -1.0))[level]
    return math.nextafter(limit, -math.inf) if check == "SOC_STEP" else limit


def grade(rows: DataFrame, capacity: str = "referee_kwh") -> DataFrame:
    """``rows`` with ``grade`` (good, caution, poor; null without a figure) and ``reason``, worst first.

    Reads energy_source, delta_kwh, delta_soc, distance_km, start_ts, end_ts, ep, and the audit:
    counter_kwh, outside_km, outside_min, dist_outside_km, odo_samples, samples,
    soc_quantum, step_pct, step_rate. An unknown value finds nothing.
    """
    energy, soc, km = F.abs("delta_kwh"), F.abs("delta_soc"), F.col("distance_km")
    part = lambda a, b: F.when(b > 0, a / F.nullif(b, F.lit(0.0)))
    counter, estimated = F.col("energy_source").isin(*COUNTERS), F.col("energy_source").isin(*ESTIMATES)
    ratio = part(energy, F.col("counter_kwh"))
    hours = (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / 3.6e9
    res = part(F.col("soc_quantum"), soc)
    expected = soc / 100 * F.col(capacity)
    gate = (soc >= GATE_SOC) & F.coalesce(res <= GATE_RES, F.lit(True))
    values = {
        "DUP_ENERGY": F.when(counter, ratio), "SPLIT_ALLOC": F.when(counter, ratio), "ENERGY_WINDOW": F.when(counter, part(F.col("outside_km"), km)), "IDLE_WINDOW": F.when(counter, part(F.col("outside_min") / 60 * IDLE_KW, energy)),
        "DIST_WINDOW": part(F.col("dist_outside_km"), km), "DIST_EXTRAP": F.when((F.col("odo_samples") == 0) & (F.col("samples") > 0), F.lit(0.0)), "SOC_RES": F.when(estimated, res),
        "SOC_STEP": F.when(estimated & (F.col("step_rate") > STEP_RATE), part(F.col("step_pct"), soc)), "CAP_INCONS": F.when(counter & gate, part(F.abs(energy - expected), expected)), "SHORT_DIST": km, "SPEED": part(km, hours), "EP_LOW": F.col("ep"), "EP_HIGH": F.col("ep"),
    }
    # The values first, each once; a limit is passed where the greatest of the distances over it is positive. This is little code, which
    # a JVM compiles; a rule over an array is interpreted for every element, so only rows with findings get to it.
    over = lambda level: F.greatest(*(((F.col(f"__v_{name}") - _limit(name, level)) if name in ABOVE else (_limit(name, level) - F.col(f"__v_{name}"))) for name in values if _limit(name, level) is not None)) > 0
    found = rows.withColumns({f"__v_{name}": v.cast("double") for name, v in values.items()})
    found = found.withColumns({"__poor": over(1), "__caution": over(0)})
    graded = F.col("ep").isNotNull() & (F.col("energy_source") != "distance_only")
    found = found.withColumn("__worst", F.when(graded, F.when(F.col("__poor"), 2).when(F.col("__caution"), 1).otherwise(0)))
    rules = F.array(*(F.struct(F.lit(CODES.get(name, name)).alias("code"), F.lit(1.0 if name in ABOVE else -1.0).alias("sign"), *(F.lit(_limit(name, i)).cast("double").alias(k) for i, k in enumerate(("caution", "poor")))) for name in values))

    def severity(value: Column, rule: Column) -> Column:
        over = lambda limit: value * rule["sign"] > limit * rule["sign"]
        return F.struct(F.when(over(rule["poor"]), 2).when(over(rule["caution"]), 1).otherwise(0).alias("s"), rule["code"].alias("code"), value.alias("v"))

    findings = F.filter(F.zip_with(F.array(*(f"__v_{name}" for name in values)), rules, severity), lambda x: x["s"] > 0)
    found = found.withColumn("__found", F.when(F.col("__worst") > 0, findings))
    # Only findings become texts, each once, the worse ones first.
    decimals = lambda v, n: F.coalesce(v.try_cast(f"decimal(20,{n})").cast("string"), F.format_string(f"%.{n}f", v))
    text = lambda x: F.concat(x["code"], F.lit(" "), F.when(x["code"] == "SPEED", decimals(x["v"], 0)).otherwise(decimals(x["v"], 2)))
    of = lambda level: F.transform(F.filter("__found", lambda x: x["s"] == level), text)
    reason = F.when(F.col("__worst") > 0, F.array_join(F.concat(of(2), of(1)), "; ")).when(F.col("__worst") == 0, "").when(F.col("energy_source") == "distance_only", "NO_ENERGY")
    grades = F.when(F.col("__worst") == 2, "poor").when(F.col("__worst") == 1, "caution").when(F.col("__worst") == 0, "good")
    return found.withColumns({"grade": grades, "reason": reason}).select(*rows.columns, "grade", "reason")


def grade_tally(graded: DataFrame, keys: list[str]) -> DataFrame:
    # Rows without a grade go by their count: a filter on the grade would work all of it out once more, below the first time.
    return graded.groupBy(*keys, "grade").agg(F.count("grade").alias("n")).where("n > 0")
