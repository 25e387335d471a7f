"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# whole texts travel to Python, so a batch holds few rows: a thousand long documents still fit a worker
ROWS_PER_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, unless the session already asks for less."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > ROWS_PER_BATCH or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, str(ROWS_PER_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int = 4) -> Column:
    """crc32 of the id's decimal text, modulo `parts`; a null id is fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0).cast("bigint"))


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only; texts of plain ASCII take the fast built-in."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct `__row`: beside it helper columns cannot clash with those of the table."""
    return F.struct(*df.columns).alias("__row")


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that `whole_row` packed."""
    return df.select(*[F.col("__row")[c].alias(c) for c in columns])


def has_maps(kind: T.DataType) -> bool:
    """Whether values of the type cannot be put in order."""
    if isinstance(kind, T.StructType):
        return any(has_maps(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return has_maps(kind.elementType)
    return isinstance(kind, T.MapType | T.VariantType)


def orderable(df: DataFrame, name: str) -> Column:
    """The column, as JSON text where it holds maps."""
    return F.to_json(F.struct(name)) if has_maps(df.schema[name].dataType) else F.col(name)
