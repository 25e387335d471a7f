"""Display and map tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglass.functions.types import schema

# Display format, default layer, marker names and sphere radius (metres).
TIME_FORMAT = "M/d/yyyy, h:mm:ss a"
# milliseconds of the years 1 to 9999
MILLIS = (-62_135_596_800_000, 253_402_300_799_999)
DEFAULT_LAYER = "Markers"
MARKERS = ("BLUE", "GREEN", "YELLOW", "RED", "WARNING", "AWARD")
RADIUS = 6378137.0

# Position types; each extends the one before it.
_BASE = [("id", "rstring"), ("latitude", "float64"), ("longitude", "float64")]
MAPPED_POSITION = schema(_BASE)
MAPPED_POSITION_MARKER = schema([*_BASE, ("markerType", "enum"), ("note", "rstring")])
MAPPED_POSITION_ICON = schema([*_BASE, ("markerType", "rstring"), ("note", "rstring")])
MAPPED_POSITION_MARKER_LAYER = schema([*_BASE, ("markerType", "enum"), ("note", "rstring"), ("layer", "rstring")])
MAPPED_POSITION_ICON_LAYER = schema([*_BASE, ("markerType", "rstring"), ("note", "rstring"), ("layer", "rstring")])


def is_marker(name: Column) -> Column:
    """True for one of the predefined marker names."""
    return name.isin(*MARKERS)


def two_decimals(value: Column) -> Column:
    """Text with two decimals; the binary value is rounded, exact halves away from zero.

    Exact halves are odd multiples of 1/8; everything else has a nearest text.
    """
    wide = value.cast("double")
    half = (F.floor(wide * 8) == wide * 8) & (F.abs(wide) < 1e15)
    exact = F.round(wide.cast("decimal(30,3)"), 2).cast("decimal(30,2)").cast("string")
    near = F.regexp_replace(F.format_number(wide, 2), ",", "")
    return F.when(half & (wide != 0), exact).otherwise(near)


def live_table(df: DataFrame, raw: bool = False) -> DataFrame:
    """Display texts: timestamps, milliseconds in `*time*` attributes, two decimals."""
    if raw:
        return df
    columns = []
    for field in df.schema.fields:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.TimestampType | T.TimestampNTZType):
            value = F.date_format(value, TIME_FORMAT)
        elif isinstance(kind, T.LongType) and "time" in field.name.lower():
            # other units than milliseconds can lie outside the calendar: shown as numbers
            inside = value.between(*MILLIS)
            shown = F.date_format(F.timestamp_millis(F.when(inside, value)), TIME_FORMAT)
            value = F.when(value.isNull() | inside, shown).otherwise(value.cast("string"))
        elif isinstance(kind, T.FloatType | T.DoubleType):
            value = two_decimals(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def marker_key(layer: Column, identifier: Column) -> Column:
    """`layer:id`; a missing layer is the default one."""
    return F.concat_ws(":", F.coalesce(layer, F.lit(DEFAULT_LAYER)), identifier.cast("string"))


def with_marker(df: DataFrame) -> DataFrame:
    layer = F.col("layer") if "layer" in df.columns else F.lit(None).cast("string")
    return df.withColumn("marker", marker_key(layer, F.col("id")))


def mercator(df: DataFrame) -> DataFrame:
    """Add `x` and `y`, the web Mercator position of longitude and latitude."""
    return df.withColumns({"x": mercator_x(F.col("longitude")), "y": mercator_y(F.col("latitude"))})


def mercator_x(longitude: Column) -> Column:
    return F.radians(longitude) * RADIUS


def mercator_y(latitude: Column) -> Column:
    return F.log(F.tan(F.pi() / 4 + F.radians(latitude) / 2)) * RADIUS


def position_diff(polls: DataFrame, order: Sequence[str]) -> DataFrame:
    """Changes between consecutive polls: added, moved, kept and removed markers.

    `poll` is a running number. Within a poll the last row of a marker wins.
    Both sides of the join have one row per (marker, poll).
    """
    at = F.max_by(F.struct("longitude", "latitude"), F.struct(*order)).alias("at")
    now = with_marker(polls).groupBy("marker", "poll").agg(at)
    before = now.select("marker", (F.col("poll") + 1).alias("poll"), F.col("at").alias("was"))
    last = polls.agg(F.max("poll")).scalar()
    joined = now.join(before, ["marker", "poll"], "full")
    change = (
        F.when(F.col("was").isNull(), "added")
        .when(F.col("at").isNull(), "removed")
        .when(F.col("at") == F.col("was"), "kept")
        .otherwise("moved")
    )
    where = F.coalesce("at", "was")
    return joined.where(F.col("poll") <= last).select(
        "marker",
        "poll",
        change.alias("change"),
        where["longitude"].alias("longitude"),
        where["latitude"].alias("latitude"),
    )


def read_fences(lines: DataFrame) -> DataFrame:
    """Geofence lines `"id","WKT"` to fence id and WKT; other lines are skipped."""
    parts = F.split(F.col("value"), '","')
    picked = lines.select(parts.alias("p")).where(F.size("p") == 2)
    return picked.select(
        F.regexp_replace(F.col("p")[0], '^"', "").alias("fence"),
        F.regexp_replace(F.col("p")[1], '"\\s*$', "").alias("wkt"),
    )


def fence_points(fences: DataFrame) -> DataFrame:
    """Coordinate pairs of every ring of a fence."""
    number = r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
    pairs = F.regexp_extract_all("wkt", F.lit(rf"{number}\s+{number}"), 0)
    split = fences.select("fence", F.posexplode(pairs).alias("position", "pair"))
    both = F.split("pair", r"\s+")
    return split.select(
        "fence", "position", both[0].cast("double").alias("longitude"), both[1].cast("double").alias("latitude")
    )


def fence_extents(fences: DataFrame) -> DataFrame:
    """Extent of every fence and, with `fence` null, of all fences; degrees and metres."""
    extents = (
        fence_points(fences)
        .rollup("fence")
        .agg(
            F.min("longitude").alias("west"),
            F.max("longitude").alias("east"),
            F.min("latitude").alias("south"),
            F.max("latitude").alias("north"),
        )
    )
    return extents.withColumns(
        {
            "x_min": mercator_x(F.col("west")),
            "x_max": mercator_x(F.col("east")),
            "y_min": mercator_y(F.col("south")),
            "y_max": mercator_y(F.col("north")),
        }
    )
