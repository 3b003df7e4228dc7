"""Settings checked as data: JSON texts in, one row for each thing that is wrong with them out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The checked keys of a pipeline, where they belong and what they take.
TOP_LEVEL = {"soc_event_spike_pct": "positive"}
SPEED_PARAMS = {"keep_trips_outside_cap_band": "flag", "keep_odometer_confirmed_trips": "flag", "min_confirmed_distance_km": "positive"}
GROUPS = ("charge_params", "discharge_params", "speed_params")
#: What an override of a period may set, and its fields.
OVERRIDABLE = {"pipeline": "name", "prefer_logger_speed": "flag", "min_stop_duration_min": "positive", "split_by_mass": "flag", "merge_by_mass": "flag", "split_long_stops_min": "positive or null", "min_cluster_gap_kg": "positive", "mass_agg": "name"}
FIELDS = ("from", "to", "reason", "set")
KINDS = {"positive": "a positive number", "flag": "true or false", "name": "a name", "positive or null": "a positive number or null"}
DAY = r"^\d{4}-\d{2}-\d{2}$"


def kind_of(value: Column) -> Column:
    """``null``, ``flag``, ``number``, ``text``, ``list`` or ``object``; null where there is no value at all."""
    named = lambda t: F.when(t.isNull(), None).when(t == "VOID", "null").when(t == "BOOLEAN", "flag").when(t == "STRING", "text").when(t.startswith("ARRAY"), "list").when(t.startswith("OBJECT"), "object").otherwise("number")
    # Through an array of one, so that the value's schema is found once and not for every kind.
    return F.element_at(F.transform(F.array(F.upper(F.schema_of_variant(value))), named), 1)


def part(value: Column, key: str) -> Column:
    return F.try_variant_get(value, f"$['{key}']", "variant")


def takes(value: Column, wanted: str) -> Column:
    """Whether a value that is there is of the wanted kind."""
    kind = kind_of(value)
    positive = (kind == "number") & F.coalesce(F.try_variant_get(value, "$", "double") > 0, F.lit(False))
    return {"flag": kind == "flag", "name": (kind == "text") & (F.trim(F.try_variant_get(value, "$", "string")) != ""), "positive": positive, "positive or null": positive | (kind == "null")}[wanted]


def _wrong(condition: Column, *text) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.concat(*(F.lit(t) if isinstance(t, str) else t for t in text)))


def _rows(found: DataFrame, keep: list[str], errors: list[Column]) -> DataFrame:
    # An outer one: of another Spark takes a filter on the size, for which it works out all errors once more.
    return found.select(*keep, F.posexplode_outer(F.filter(F.array(*errors), lambda e: e.isNotNull())).alias("place", "error")).where("error is not null")


def pipeline_errors(pipelines: DataFrame) -> DataFrame:
    """``name, place, error`` of pipelines (name, json): checked keys of the wrong kind or in the wrong place.

    A text that isn't JSON is an error; a pipeline that isn't an object, and other keys, are left to the code that reads them.
    """
    v = F.try_parse_json("json")
    found = pipelines.withColumn("v", v)
    own = F.col("v")
    errors = [_wrong(own.isNull(), "is no JSON")]
    for key, wanted in TOP_LEVEL.items():
        errors.append(_wrong(part(own, key).isNotNull() & ~takes(part(own, key), wanted), f"{key} must be {KINDS[wanted]}"))
    errors += [_wrong(part(own, key).isNotNull(), f"{key} belongs in speed_params, not at the top level") for key in SPEED_PARAMS]
    for group in GROUPS:
        params = part(own, group)
        errors += [_wrong(part(params, key).isNotNull(), f"{key} belongs at the top level, not in {group}") for key in TOP_LEVEL]
        for key, wanted in SPEED_PARAMS.items():
            value = part(params, key)
            if group != "speed_params":
                errors.append(_wrong(value.isNotNull(), f"{key} belongs in speed_params, not in {group}"))
            else:
                errors.append(_wrong(value.isNotNull() & ~takes(value, wanted), f"speed_params.{key} must be {KINDS[wanted]}"))
    return _rows(found, ["name"], errors)


def _day(value: Column) -> Column:
    text = F.when(kind_of(value) == "text", F.try_variant_get(value, "$", "string"))
    return F.when(text.rlike(DAY), text.try_cast("date"))


def period_overrides(vehicles: DataFrame) -> DataFrame:
    """``vehicle_id, place, valid_from, valid_to, settings`` of the overrides of vehicles (vehicle_id, json), dates null where they
    aren't dates, with ``entry``, the whole override."""
    entries = F.try_variant_get(F.try_parse_json("json"), "$.period_overrides", "array<variant>")
    rows = vehicles.select("vehicle_id", F.posexplode_outer(entries).alias("place", "entry")).where("place is not null")
    entry = F.col("entry")
    return rows.select("vehicle_id", "place", _day(part(entry, "from")).alias("valid_from"), _day(part(entry, "to")).alias("valid_to"), part(entry, "set").alias("settings"), "entry")


def override_errors(vehicles: DataFrame, pipelines: DataFrame) -> DataFrame:
    """``vehicle_id, place, error``: overrides that aren't lists of objects, or stand on a diesel vehicle (``place`` -1); unknown fields,
    dates that are none, an end not after its start, settings that may not be set or of the wrong kind, pipelines (name)
    that there aren't, and windows of a vehicle that overlap: each is told at the later one."""
    # Few bytes of settings are much work: dealt out evenly, however few files or row groups they come in.
    vehicles = vehicles.select("vehicle_id", "json").repartition(int(vehicles.sparkSession.conf.get("spark.sql.shuffle.partitions")), "vehicle_id")
    # What several checks ask is worked out in steps, as columns: an expression that is used twice is evaluated twice.
    config = F.col("config")
    whole = vehicles.select("vehicle_id", "json", F.try_parse_json("json").alias("config")).withColumn("given", part(config, "period_overrides"))
    diesel = F.upper(F.coalesce(F.try_variant_get(config, "$.fuel_type", "string"), F.lit(""))) == "DIESEL"
    whole = whole.withColumns({"kind": kind_of(F.col("given")), "diesel": diesel, "some": F.size(F.try_variant_get(config, "$.period_overrides", "array<variant>")) > 0})
    lists = F.col("kind") == "list"
    whole = _rows(whole, ["vehicle_id"], [_wrong(config.isNull() & F.col("json").isNotNull(), "is no JSON"), _wrong(F.col("given").isNotNull() & (F.col("kind") != "null") & ~lists, "period_overrides must be a list"), _wrong(lists & F.col("some") & F.col("diesel"), "period_overrides are not for diesel vehicles")])
    names = pipelines.select(F.col("name").alias("known"))
    rows = period_overrides(vehicles)
    entry, settings = F.col("entry"), F.col("settings")
    keys = lambda value: F.coalesce(F.json_object_keys(F.to_json(value)), F.array().cast("array<string>"))
    others = lambda own, allowed: F.array_sort(F.array_except(own, F.array(*map(F.lit, allowed))))
    checked = rows.withColumns({**{f"f_{k}": part(entry, k) for k in FIELDS if k != "set"}, **{f"s_{k}": part(settings, k) for k in OVERRIDABLE}, "entry_kind": kind_of(entry), "set_kind": kind_of(settings), "set_keys": keys(settings), "entry_others": others(keys(entry), FIELDS)})
    checked = checked.withColumns({"set_others": others(F.col("set_keys"), OVERRIDABLE), "wanted": F.when(kind_of(F.col("s_pipeline")) == "text", F.try_variant_get(F.col("s_pipeline"), "$", "string"))})
    checked = checked.join(names, F.col("wanted") == F.col("known"), "left")
    is_object, sets = F.col("entry_kind") == "object", F.col("set_kind") == "object"
    start, to, reason = F.col("f_from"), F.col("f_to"), F.col("f_reason")
    errors = [
        _wrong(~is_object, "an override must be an object"),
        _wrong(is_object & (F.size("entry_others") > 0), "unknown fields: ", F.array_join("entry_others", ", ")),
        _wrong(is_object & start.isNull(), "'from' is required"),
        _wrong(start.isNotNull() & F.col("valid_from").isNull(), "'from' must be a day written YYYY-MM-DD"),
        _wrong(to.isNotNull() & F.col("valid_to").isNull() & (kind_of(to) != "null"), "'to' must be a day written YYYY-MM-DD"),
        _wrong(F.col("valid_to") <= F.col("valid_from"), "'to' must be after 'from'"),
        _wrong(reason.isNotNull() & ~kind_of(reason).isin("text", "null"), "'reason' must be text"),
        _wrong(is_object & settings.isNull(), "'set' is required"),
        _wrong(settings.isNotNull() & ~sets, "'set' must be an object"),
        _wrong(sets & (F.size("set_keys") == 0), "'set' is empty"),
        _wrong(sets & (F.size("set_others") > 0), "'set' may not change ", F.array_join("set_others", ", ")),
        *(_wrong(F.col(f"s_{key}").isNotNull() & ~takes(F.col(f"s_{key}"), kind), f"'set'.{key} must be {KINDS[kind]}") for key, kind in OVERRIDABLE.items()),
        _wrong(F.col("wanted").isNotNull() & F.col("known").isNull(), "no such pipeline: ", F.col("wanted")),
    ]
    own = _rows(checked.withColumnRenamed("place", "at"), ["vehicle_id", "at"], errors).select("vehicle_id", F.col("at").alias("place"), "error")
    before = Window.partitionBy("vehicle_id").orderBy("valid_from", "place")
    dated = rows.where("valid_from is not null").withColumn("previous", F.lag(F.struct("place", F.coalesce("valid_to", F.lit("9999-12-31").cast("date")).alias("ends"))).over(before))
    overlaps = dated.where(F.col("previous.ends") > F.col("valid_from")).select("vehicle_id", "place", F.concat(F.lit("overlaps override "), F.col("previous.place").cast("string")).alias("error"))
    return whole.select("vehicle_id", F.lit(-1).alias("place"), "error").unionByName(own).unionByName(overlaps)


def require_valid(errors: DataFrame) -> None:
    """Fail with the first errors, if there are any."""
    found = errors.orderBy(*errors.columns).limit(20).collect()
    if found:
        raise ValueError("; ".join(": ".join(str(x) for x in row) for row in found))
