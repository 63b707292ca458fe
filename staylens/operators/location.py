"""Location enrichment by a table of stored geocoder responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.rules import CITY_FIELDS, ZONE_FIELDS
from staylens.functions.text import blank_to_null, latin_only, strip
from staylens.schemas import GEOCODE_BODY

_MISS_KEYS = 4096


def parse_response(body: Column) -> Column:
    """STRUCT<display_name, address MAP, broken>; NULL for no or broken JSON."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    parsed = F.from_json(body, GEOCODE_BODY + ", broken STRING", options)
    return F.when(parsed["broken"].isNull(), parsed)


def clean_address(display_name: Column) -> Column:
    """Latin part, stripped, then every comma as a space (in this order)."""
    return F.translate(strip(latin_only(display_name)), ",", " ")


def pick_zone(address: Column, fields: Sequence[str] = ZONE_FIELDS) -> Column:
    """First field that is still text after cleaning; '' when some were given
    but none survives; NULL when none was given."""
    given = [blank_to_null(F.try_element_at(address, F.lit(f))) for f in fields]
    cleaned = [blank_to_null(strip(latin_only(g))) for g in given]
    return F.coalesce(*cleaned, F.when(F.coalesce(*given).isNotNull(), F.lit("")))


def pick_city(address: Column, fields: Sequence[str] = CITY_FIELDS) -> Column:
    """First non-empty field, stripped, in its own script."""
    return strip(F.coalesce(*[blank_to_null(F.try_element_at(address, F.lit(f))) for f in fields]))


def locations(geocodes: DataFrame) -> DataFrame:
    """``geocodes(lat, lon, body)`` -> ``(lat, lon, address, zone, city)``, one per point.

    A point stored more than once keeps its smallest readable body, so that the
    lookup never multiplies rows and a failed response does not hide a good one.
    """
    readable = F.when(parse_response(F.col("body")).isNotNull(), F.col("body"))
    point = geocodes.groupBy("lat", "lon").agg(F.min(readable).alias("body"))
    parsed = point.select("lat", "lon", parse_response(F.col("body")).alias("response"))
    given = F.col("response").isNotNull()
    address = F.col("response.address")
    shown = F.when(given, F.coalesce("response.display_name", F.lit("")))
    return parsed.select(
        "lat",
        "lon",
        clean_address(shown).alias("address"),
        pick_zone(address).alias("zone"),
        pick_city(address).alias("city"),
    )


def locate(properties: DataFrame, places: DataFrame, spread_by: str) -> DataFrame:
    """Left lookup of ``places(lat, lon, ..)`` by ``latitude``/``longitude``.

    Properties without coordinates match nothing.  They get one of many keys
    outside the globe, by a hash of ``spread_by``, so that they do not all meet
    in one task.  No side is forced to be broadcast: the planner does so only
    when the measured size allows it.  Otherwise adaptive execution splits a hot
    point; it can do so only where both sides are shuffled for this very join,
    which the key ``cell`` brings about even if ``places`` comes grouped by point.
    """
    missing = F.col("latitude").isNull() | F.col("longitude").isNull()
    off_globe = F.lit(-1e9) - F.pmod(F.xxhash64(spread_by), F.lit(_MISS_KEYS))
    cell = F.xxhash64("lat", "lon")
    keyed = properties.withColumns(
        {
            "lat": F.when(missing, off_globe).otherwise(F.col("latitude")),
            "lon": F.when(missing, F.lit(0.0)).otherwise(F.col("longitude")),
        }
    ).withColumn("cell", cell)
    found = keyed.join(places.withColumn("cell", cell), ["cell", "lat", "lon"], "left")
    extra = [c for c in places.columns if c not in ("lat", "lon")]
    return found.select(*properties.columns, *[F.when(~missing, F.col(c)).alias(c) for c in extra])
