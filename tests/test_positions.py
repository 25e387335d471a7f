"""Display and map tables, port catalogue."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wireglass.functions.types import schema
from wireglass.operators import positions
from wireglass.operators.catalog import Port, port_catalog
from wireglass.sources import read_fence_lines


@pytest.mark.parametrize(
    ("value", "text"),
    [(1.005, "1.00"), (0.125, "0.13"), (0.375, "0.38"), (-0.125, "-0.13"), (2.0, "2.00"), (1234567.891, "1234567.89"), (0.0, "0.00"), (8.345, "8.35"), (1e15 + 0.5, "1000000000000000.50")],
)
def test_two_decimals(spark, value, text):
    assert spark.range(1).select(positions.two_decimals(F.lit(value)).alias("t")).first()["t"] == text


def test_live_table(spark):
    ts = datetime(2024, 1, 2, 15, 4, 5)
    df = spark.createDataFrame([(ts, 1704207845000, 7, 1.5)], "at timestamp, eventTimeMs long, n long, f double")
    row = positions.live_table(df).first()
    assert tuple(row) == ("1/2/2024, 3:04:05 PM", "1/2/2024, 3:04:05 PM", 7, "1.50")
    assert tuple(positions.live_table(df, raw=True).first()) == (ts, 1704207845000, 7, 1.5)


def test_position_types():
    assert positions.MAPPED_POSITION_MARKER_LAYER.fieldNames() == ["id", "latitude", "longitude", "markerType", "note", "layer"]
    assert positions.MAPPED_POSITION_ICON.fieldNames() == ["id", "latitude", "longitude", "markerType", "note"]


def test_position_changes(spark):
    rows = [
        (0, 0, "a", None, 1.0, 1.0),
        (0, 1, "b", "L", 1.0, 1.0),
        (0, 2, "b", "L", 2.0, 2.0),
        (1, 3, "a", None, 1.0, 1.0),
        (1, 4, "c", None, 0.0, 0.0),
        (2, 5, "a", None, 9.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "poll long, n long, id string, layer string, longitude double, latitude double")
    found = sorted((r["poll"], r["marker"], r["change"], r["longitude"]) for r in positions.position_diff(df, ["n"]).collect())
    assert found == [
        (0, "L:b", "added", 2.0),
        (0, "Markers:a", "added", 1.0),
        (1, "L:b", "removed", 2.0),
        (1, "Markers:a", "kept", 1.0),
        (1, "Markers:c", "added", 0.0),
        (2, "Markers:a", "moved", 9.0),
        (2, "Markers:c", "removed", 0.0),
    ]


def test_mercator(spark):
    df = spark.createDataFrame([(180.0, 0.0), (0.0, 85.0511287798066), (-90.0, -45.0)], "longitude double, latitude double")
    rows = positions.mercator(df).collect()
    assert math.isclose(rows[0]["x"], 20037508.342789244) and abs(rows[0]["y"]) < 1e-6
    assert math.isclose(rows[1]["y"], 20037508.342789244, rel_tol=1e-9)
    assert rows[2]["x"] < 0 and math.isclose(rows[2]["y"], -5621521.486192066)


def test_geofences(spark, tmp_path):
    path = tmp_path / "fences.csv"
    path.write_text('"one","POLYGON((1 2, 3 -4.5, 1.5e1 2))"\n"two","POLYGON((0 0, 1 1), (-2 0, 0 9))"\nno fence\n')
    rows = {r["fence"]: r for r in positions.fence_extents(positions.read_fences(read_fence_lines(spark, str(path)))).collect()}
    assert tuple(rows["one"])[1:5] == (1.0, 15.0, -4.5, 2.0)
    assert tuple(rows["two"])[1:5] == (-2.0, 1.0, 0.0, 9.0)
    assert tuple(rows[None])[1:5] == (-2.0, 15.0, -4.5, 9.0)


def test_port_catalogue(spark):
    ports = [
        Port("my.flow.In", "inject_tuple", 0, schema([("a", "int32"), ("b", "rstring")]), context="ctx"),
        Port("my.flow.View", "view", 1, schema([("x", "xml")])),
    ]
    rows = port_catalog(spark, ports).collect()
    assert [(r["operator"], r["port"], r["attribute"], r["type"]) for r in rows] == [
        ("my.flow.In", 0, "a", "int32"),
        ("my.flow.In", 0, "b", "rstring"),
        ("my.flow.View", 1, "x", "xml"),
    ]
    assert rows[0]["urls"] == [f"/ctx/In/ports/output/0/{a}" for a in ("inject", "form", "info")]
    assert rows[2]["urls"] == [f"/my.flow.View/ports/input/1/{a}" for a in ("tuples", "info")]
