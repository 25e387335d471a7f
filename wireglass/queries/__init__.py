"""The query catalogue: every operator over the given tables, with its SQL check."""

from wireglass.queries import exchange, ingest, messages, positions, streams, views  # noqa: F401
from wireglass.queries.registry import ORACLES, QUERIES  # noqa: F401
