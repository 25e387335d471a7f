"""Attribute types, their defaults and strict text coercion.

A tuple never holds null: an absent attribute has the default of its type. A
schema is an ordinary StructType whose fields remember the attribute type in
their metadata, because several attribute types share one Spark type (`xml`
and `rstring` are both strings).
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Attribute type name -> Spark type.
_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
SPARK_TYPES: dict[str, T.DataType] = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "rstring": T.StringType(),
    "ustring": T.StringType(),
    "bstring": T.StringType(),
    "enum": T.StringType(),
    "blob": T.BinaryType(),
    "xml": T.StringType(),
    "timestamp": T.TimestampType(),
    "map<rstring,rstring>": _TEXT_MAP,
    "list<rstring>": T.ArrayType(T.StringType()),
}
STRINGS = ("rstring", "ustring", "bstring")
SIGNED = ("int8", "int16", "int32", "int64")
UNSIGNED = {"uint8": 2**8 - 1, "uint16": 2**16 - 1, "uint32": 2**32 - 1, "uint64": 2**64 - 1}
FLOATS = ("float32", "float64")

# The default attribute type of a Spark column that carries no metadata.
_FROM_SPARK = {
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "float": "float32",
    "double": "float64",
    "boolean": "boolean",
    "string": "rstring",
    "binary": "blob",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp",
    "map<string,string>": "map<rstring,rstring>",
    "array<string>": "list<rstring>",
    "decimal(20,0)": "uint64",
}

# Number texts a form may carry: decimal or hexadecimal floats with an optional
# type suffix, NaN and Infinity spelled exactly so, blanks around allowed.
_FLOAT_TEXT = (
    r"^[\x00-\x20]*[+-]?(NaN|Infinity"
    r"|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?)[\x00-\x20]*$"
)
_INT_TEXT = r"^[+-]?[0-9]+$"


def schema(attributes: Iterable[tuple[str, str]]) -> T.StructType:
    """StructType from (name, attribute type) pairs, the type kept as metadata."""
    return T.StructType([T.StructField(name, SPARK_TYPES[kind], True, {"attribute": kind}) for name, kind in attributes])


def attribute_type(field: T.StructField) -> str:
    """Attribute type name of a field: its metadata, else the natural one."""
    kind = (field.metadata or {}).get("attribute")
    return kind or _FROM_SPARK.get(field.dataType.simpleString(), field.dataType.simpleString())


def default(kind: str) -> Column:
    """Value of an attribute nothing was assigned to."""
    spark_type = SPARK_TYPES[kind]
    if kind in SIGNED or kind in UNSIGNED or kind in FLOATS:
        return F.lit(0).cast(spark_type)
    if kind == "boolean":
        return F.lit(False)
    if kind == "blob":
        return F.lit(b"")
    if kind == "timestamp":
        return F.timestamp_seconds(F.lit(0))
    if kind == "map<rstring,rstring>":
        return F.create_map().cast(spark_type)
    if kind.startswith("list<"):
        return F.array().cast(spark_type)
    return F.lit("")


def coerce(text: Column, kind: str) -> Column:
    """Typed value of a text, null where the text is not a value of the type.

    Stricter than a cast: ` 12 ` is no integer, `yes` is no true, `inf` is no
    float. A text is never null here, so null always means rejected.
    """
    spark_type = SPARK_TYPES[kind]
    if kind in SIGNED:
        return F.when(text.rlike(_INT_TEXT), text.try_cast(spark_type))
    if kind in UNSIGNED:
        wide = F.when(text.rlike(_INT_TEXT), text.try_cast("decimal(38,0)"))
        return F.when(wide.between(F.lit(0), F.lit(Decimal(UNSIGNED[kind]))), wide.cast(spark_type))
    if kind in FLOATS:
        return F.when(text.rlike(_FLOAT_TEXT), text.try_cast(spark_type))
    if kind == "boolean":
        return F.lower(text) == "true"
    if kind in STRINGS or kind == "enum":
        return text
    return default(kind)


def coerce_or_default(text: Column, kind: str) -> Column:
    """Coerced value; the default where the text is absent or empty, null where it is rejected."""
    return F.when(F.coalesce(text, F.lit("")) == "", default(kind)).otherwise(coerce(text, kind))
