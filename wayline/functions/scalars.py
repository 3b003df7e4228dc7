"""Scalar column functions of the report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def distance_km(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat)) / 2), 2) + F.cos(F.radians(lat)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon)) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def point_text(lat: Column, lon: Column) -> Column:
    return F.when(lat.isNotNull() & lon.isNotNull(), F.format_string("Point(%.6f %.6f)", lat, lon))


def point_part(text: Column, part: int) -> Column:
    """Latitude (1) or longitude (2) of a point's text; null if it isn't one."""
    return F.regexp_extract(text, r"^\s*Point\(\s*(-?[0-9.]+)[\s,]+(-?[0-9.]+)\s*\)\s*$", part).try_cast("double")


def cardinal(degrees: Column) -> Column:
    """One of eight compass points; half-way goes to the even one. None for null, which ``element_at`` itself doesn't give."""
    return F.when(degrees.isNotNull(), F.element_at(F.array(*map(F.lit, COMPASS)), (F.pmod(F.rint(degrees / 45).cast("int"), F.lit(8)) + 1).cast("int")))


def weather_key(lat: str, lon: str, ts: str) -> Column:
    """Place to two decimals and the hour."""
    hour = F.floor(F.unix_micros(ts) / 3_600_000_000) * 3600
    return F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.concat_ws(",", F.format_string("%.2f", F.col(lat)), F.format_string("%.2f", F.col(lon)), hour.cast("string")))


def charge_type(ac_kwh: Column, dc_kwh: Column, least: float = 0.5) -> Column:
    both = (ac_kwh >= least) & (dc_kwh >= least)
    return F.when(ac_kwh.isNull() & dc_kwh.isNull(), "estimated").when(both, "Mix charge").when(ac_kwh >= least, "AC charge").otherwise("DC charge")


def leg_type(kind: Column, ac_kwh: Column, dc_kwh: Column, start_home: Column, end_home: Column, km: Column) -> Column:
    """Charge rows by current and place, trips by the ends they have at home."""
    ac, dc = F.abs(F.coalesce(ac_kwh, F.lit(0.0))) > 1, F.abs(F.coalesce(dc_kwh, F.lit(0.0))) > 1
    current = F.when(ac & dc, "AC/DC").when(ac, "AC").when(dc, "DC").otherwise("Charge")
    trip = F.when(start_home & end_home & (km > 5), "Round Trip").when(start_home & end_home, "In House").when(start_home, "Outbound").when(end_home, "Return").otherwise("In Transit")
    return F.when(kind == "charge", F.concat_ws(" ", current, F.when(start_home, "Home").otherwise("Away"))).when(kind == "stop", "Stop").otherwise(trip)


def is_charge_label(label: Column) -> Column:
    return F.coalesce(F.trim(label).rlike("(?i)^(ac|dc|charge|mix|estimated)"), F.lit(False))


def is_stop_label(label: Column) -> Column:
    return F.coalesce(F.lower(F.trim(label)) == "stop", F.lit(False))


def is_trip_label(label: Column) -> Column:
    return F.coalesce(F.trim(label) != "", F.lit(False)) & ~is_charge_label(label) & ~is_stop_label(label)


def resource_url(base: Column, path: str, start: Column, end: Column, uri: Column, types: list[str] = ()) -> Column:
    """A link under the host of ``base`` with start, end, types and resource as parameters."""
    host = F.concat(F.parse_url(base, F.lit("PROTOCOL")), F.lit("://"), F.parse_url(base, F.lit("HOST")))
    part = lambda t: F.when(F.unix_micros(t) % 1_000_000 == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    iso = lambda t: F.url_encode(F.concat(part(t), F.lit("+00:00")))
    kinds = "".join(f"&type={t}" for t in types)
    return F.concat(host, F.lit(f"/{path}?start="), iso(start), F.lit("&end="), iso(end), F.lit(kinds + "&resourceUri="), F.url_encode(uri))


def spelling_variants(registration: Column) -> Column:
    """The spellings a registration is looked up by, in order, each once: without blanks, as given, parted
    after the fourth of two letters, two digits and three letters, at the change from letters to
    digits (after the digits first, if letters follow), and before the last three characters."""
    raw = F.upper(F.trim(F.coalesce(registration, F.lit(""))))
    plain = F.regexp_replace(raw, " ", "")
    part = lambda i: F.regexp_extract(plain, "^([A-Z]+)([0-9]+)([A-Z]*)$", i)
    mixed = plain.rlike("^[A-Z]+[0-9]+[A-Z]*$")
    found = F.array(
        plain, raw, F.when(plain.rlike("^[A-Z]{2}[0-9]{2}[A-Z]{3}$"), F.regexp_replace(plain, "^(.{4})", "$1 ")),
        F.when(mixed & (part(3) != ""), F.concat(part(1), part(2), F.lit(" "), part(3))), F.when(mixed, F.concat(part(1), F.lit(" "), part(2), part(3))),
        F.when(F.length(plain) >= 5, F.regexp_replace(plain, "(.{3})$", " $1")),
    )
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (x != "")))


def operator_token(description: Column, makers: list[str], prefix: str = "Round Robin") -> Column:
    """The operator that a description ``<prefix>: <operator>-<maker>`` names (words may stand before the prefix); null if it isn't one."""
    pattern = rf"(?i)^\s*(?:\w+\s+)?{prefix.replace(' ', chr(92) + 's+')}:\s*(.+?)\s*-\s*(?:{'|'.join(makers)})\s*$"
    return F.nullif(F.trim(F.regexp_extract(description, pattern, 1)), F.lit(""))


def upper_snake(text: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(F.trim(text), "[^A-Za-z0-9]+", "_"), F.lit("_")))


def cell_is_empty(text: Column) -> Column:
    """Whether a cell is null or blank; the missing-value formula is no empty cell."""
    return text.isNull() | (F.trim(text) == "")


def fractional_days(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 86_400_000_000


def needs_value(text: Column) -> Column:
    """Whether a report cell is empty: null, blank, NaN or the missing-value formula."""
    return text.isNull() | F.upper(F.trim(text)).isin("", "NAN", "=NA()", "#N/A")
