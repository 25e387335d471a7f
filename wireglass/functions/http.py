"""Column functions over request fields. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content types of the inject operators and of forms.
JSON = "application/json"
XML = "application/xml"
OCTETS = "application/octet-stream"
FORM = "application/x-www-form-urlencoded"
TEXT = "text/html; charset=utf-8"

PAIRS = "array<struct<name:string,value:string>>"


def _without_fragment(url: Column) -> Column:
    return F.split_part(url, F.lit("#"), F.lit(1))


def url_query(url: Column) -> Column:
    """Raw, undecoded query string; null when the URL has no `?`."""
    plain = _without_fragment(url)
    mark = F.instr(plain, "?")
    return F.when(mark > 0, F.substring(plain, mark + 1, F.length(plain)))


def url_without_query(url: Column) -> Column:
    return F.split_part(_without_fragment(url), F.lit("?"), F.lit(1))


def has_content_type(content_type: Column, wanted: str) -> Column:
    """Equal to the wanted type or that type with parameters; false for null."""
    exact = content_type == wanted
    return F.coalesce(exact | content_type.startswith(wanted + ";"), F.lit(False))


def body_text(body: Column) -> Column:
    return F.coalesce(F.decode(body, "UTF-8"), F.lit(""))


def split_pairs(encoded: Column) -> Column:
    """`a=1&b` -> [{a,1},{b,}]; decoded. A field that cannot be decoded is null."""
    pieces = F.filter(F.split(F.coalesce(encoded, F.lit("")), "&"), lambda piece: piece != "")
    halves = F.transform(pieces, lambda piece: F.split(piece, "=", 2))
    return F.transform(
        halves,
        lambda half: F.struct(
            F.try_url_decode(half[0]).alias("name"),
            F.try_url_decode(F.coalesce(F.get(half, F.lit(1)), F.lit(""))).alias("value"),
        ),
    )


def first_value(pairs: Column, name: str) -> Column:
    """First value of a name in a pair list, null when the name is absent."""
    return F.get(pairs["value"], (F.array_position(pairs["name"], name) - 1).cast("int"))


def all_values(pairs: Column, name: str) -> Column:
    return F.transform(F.filter(pairs, lambda p: p["name"] == name), lambda p: p["value"])


def first_values(names: Column, values: Column) -> Column:
    """Map of every name to its first value. Pass plain columns: both are read per entry."""
    distinct = F.array_distinct(names)
    return F.map_from_arrays(
        distinct, F.transform(distinct, lambda n: F.get(values, (F.array_position(names, n) - 1).cast("int")))
    )


def map_text(entries: Column) -> Column:
    """A map as sorted `name=value` text, for files and comparisons."""
    rows = F.transform(F.map_entries(entries), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(rows), "|")


def pairs_text(pairs: Column) -> Column:
    """A pair list as `name=value` text in its own order."""
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["name"], F.lit("="), p["value"])), "|")
