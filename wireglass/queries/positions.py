"""Position and display queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglass.operators import positions
from wireglass.queries import derive
from wireglass.queries.registry import query, table


@query(
    "SELECT event_id, strftime(ts, '%-m/%-d/%Y, %-I:%M:%S %p') AS ts, "
    "strftime(make_timestamp(event_id * 1000000), '%-m/%-d/%Y, %-I:%M:%S %p') AS event_time, "
    "printf('%.2f', value) AS value, printf('%.2f', (user_id % 16) / 8.0 + CASE WHEN user_id % 2 = 1 THEN 0.000001 ELSE 0 END) AS eighths, "
    "event_type FROM events"
)
def live_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        (F.col("event_id") * 1000).alias("event_time"),
        "value",
        # half cents are rounded away from zero, which is the same as adding a little
        ((F.col("user_id") % 16) / 8.0).alias("eighths"),
        "event_type",
    )
    return positions.live_table(rows)


@query(
    f"WITH p AS ({derive.POSITION_SQL}) SELECT event_id, coalesce(layer, 'Markers') || ':' || id AS marker FROM p"
)
def position_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.with_marker(derive.positions(spark, sf_dir)).select("event_id", "marker")


_DAY = "cast(date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) AS bigint)"


@query(
    f"WITH p AS ({derive.POSITION_SQL}), n AS (SELECT coalesce(layer, 'Markers') || ':' || id AS marker, {_DAY} AS poll, "
    "arg_max(longitude, event_id) AS lon, arg_max(latitude, event_id) AS lat FROM p GROUP BY ALL), "
    "b AS (SELECT marker, poll + 1 AS poll, lon, lat FROM n) "
    "SELECT marker, poll, CASE WHEN b.lon IS NULL THEN 'added' WHEN n.lon IS NULL THEN 'removed' "
    "WHEN n.lon = b.lon AND n.lat = b.lat THEN 'kept' ELSE 'moved' END AS change, coalesce(n.lon, b.lon) AS longitude, "
    "coalesce(n.lat, b.lat) AS latitude FROM n FULL JOIN b USING (marker, poll) WHERE poll <= (SELECT max(poll) FROM n)"
)
def position_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.positions(spark, sf_dir)
    day = (F.unix_date(F.col("ts").cast("date")) - F.unix_date(F.lit("2024-01-01").cast("date"))).cast("bigint")
    return positions.position_diff(rows.withColumn("poll", day), derive.ORDER)


@query(
    f"WITH p AS ({derive.POSITION_SQL}) SELECT event_id, round(6378137.0 * radians(longitude), 3) AS x, "
    "round(6378137.0 * ln(tan(pi() / 4 + radians(latitude) / 2)), 3) + 0.0 AS y FROM p"
)
def project_mercator(spark: SparkSession, sf_dir: str) -> DataFrame:
    projected = positions.mercator(derive.positions(spark, sf_dir))
    return projected.select("event_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


# one fence line per customer, two rings each; some lines are no fences
_X = "(c_custkey % 300 - 150)"
_Y = "(c_nationkey * 3 - 40)"


def _pair(dx: str, dy: str) -> str:
    return f"cast({_X} + {dx} AS string) || ' ' || cast({_Y} + {dy} AS string)"


_LINE = (
    "CASE WHEN c_custkey % 31 = 0 THEN '# comment' ELSE '\"fence ' || cast(c_custkey AS string) || '\",\"POLYGON((' || "
    f"{_pair('0', '0')} || ', ' || {_pair('3', '0')} || ', ' || {_pair('3', '4')} || ', ' || {_pair('0', '0')} || '), (' || "
    f"{_pair('1', '1')} || ', ' || {_pair('2', '1')} || ', ' || {_pair('1', '1')} || '))\"' END"
)


@query(
    f"WITH f AS (SELECT 'fence ' || c_custkey AS fence, {_X}::double AS w, {_X} + 3.0 AS e, {_Y}::double AS s, {_Y} + 4.0 AS n "
    "FROM customer WHERE c_custkey % 31 <> 0), "
    "x AS (SELECT coalesce(fence, 'ALL') AS fence, min(w) AS w, max(e) AS e, min(s) AS s, max(n) AS n FROM f "
    "GROUP BY GROUPING SETS ((fence), ())) "
    "SELECT fence, cast(w AS double) AS west, cast(e AS double) AS east, cast(s AS double) AS south, cast(n AS double) AS north, "
    "round(6378137.0 * radians(w), 3) AS x_min, round(6378137.0 * radians(e), 3) AS x_max, "
    "round(6378137.0 * ln(tan(pi() / 4 + radians(s) / 2)), 3) + 0.0 AS y_min, "
    "round(6378137.0 * ln(tan(pi() / 4 + radians(n) / 2)), 3) + 0.0 AS y_max FROM x"
)
def geofence_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "customer").selectExpr(f"{_LINE} AS value")
    extents = positions.fence_extents(positions.read_fences(lines))
    rounded = {name: F.round(name, 3) for name in ("x_min", "x_max", "y_min", "y_max")}
    return extents.withColumns({"fence": F.coalesce("fence", F.lit("ALL")), **rounded})
