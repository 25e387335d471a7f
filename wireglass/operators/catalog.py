"""Port catalogue: operators, their ports, URLs and attributes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglass.functions.types import attribute_type
from wireglass.plans.checks import check_context

# What each kind of operator offers below a port.
ACTIONS = {
    "inject_tuple": ("output", ("inject", "form", "info")),
    "inject_json": ("output", ("inject", "info")),
    "inject_xml": ("output", ("inject", "info")),
    "inject_blob": ("output", ("inject", "info")),
    "view": ("input", ("tuples", "info")),
    "latest": ("input", ("attribute", "info")),
    "websocket_inject": ("output", ("wsinject", "info")),
    "websocket_send": ("input", ("wssend", "info")),
}


@dataclass(frozen=True)
class Port:
    """A registered port. `name` is the full operator name, dots included."""

    name: str
    operator: str
    number: int
    schema: T.StructType
    context: str | None = None

    @property
    def prefix(self) -> str:
        """`/<context>/<base name>/ports`, or `/<full name>/ports` without a context."""
        check_context(self.context)
        if self.context is None:
            return f"/{self.name}/ports"
        return f"/{self.context}/{self.name.rsplit('.', 1)[-1]}/ports"

    def urls(self) -> list[str]:
        direction, actions = ACTIONS[self.operator]
        return [f"{self.prefix}/{direction}/{self.number}/{action}" for action in actions]


SCHEMA = (
    "operator string, kind string, direction string, port int, position int, "
    "attribute string, type string, urls array<string>"
)


def port_catalog(spark: SparkSession, ports: Sequence[Port]) -> DataFrame:
    """One row per operator, port and attribute with its type name and URLs."""
    rows = [
        (p.name, p.operator, ACTIONS[p.operator][0], p.number, at, f.name, attribute_type(f), p.urls())
        for p in ports
        for at, f in enumerate(p.schema.fields)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def port_usage(routed: DataFrame) -> DataFrame:
    """Ports seen in routed traffic, with their hits."""
    seen = routed.where("error is null")
    return seen.groupBy("context", "operator", "direction", "port", "action").agg(F.count(F.lit(1)).alias("hits"))
