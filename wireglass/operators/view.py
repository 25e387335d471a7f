"""Views: what a window over a tuple stream holds, and requests that read it.

A window is evaluated at its last trigger: rows after it are not visible yet,
rows before it stay visible until the next one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta
from functools import reduce
from itertools import product
from urllib.parse import parse_qsl, unquote_plus

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglass.functions import http
from wireglass.functions.types import FLOATS, attribute_type, coerce
from wireglass.plans.buckets import Layout
from wireglass.plans.checks import JSON_ATTRIBUTE, ViewPort, check_views
from wireglass.plans.ordered import running

# ---- window contents ------------------------------------------------------------


def _desc(order: Sequence[str]) -> list[Column]:
    return [F.col(name).desc() for name in order]


def _same_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])


def _with_per_key(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join one summary row per key. Small summaries are broadcast by AQE after
    their size is known; otherwise AQE splits a hot key on the row side."""
    renamed = summary.withColumnsRenamed({k: f"__{k}" for k in keys})
    return df.join(renamed, _same_keys(keys)).drop(*[f"__{k}" for k in keys])


def _newest(df: DataFrame, depth: int, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The `depth` newest rows (per key) with `__back` = 1 for the newest.

    With keys Spark cuts every map task's rows of a key to `depth` before the
    shuffle, so a hot key moves a bounded number of rows.
    """
    if keys:
        back = F.row_number().over(Window.partitionBy(*keys).orderBy(*_desc(order)))
        return df.withColumn("__back", back).where(F.col("__back") <= depth)
    top = df.orderBy(*_desc(order)).limit(depth)
    # a window without keys, over at most `depth` rows
    return top.withColumn("__back", F.row_number().over(Window.orderBy(*_desc(order))))


def last_n(df: DataFrame, n: int, order: Sequence[str], keys: Sequence[str] = (), trigger: int = 1) -> DataFrame:
    """Sliding count window: the last `n` rows as of the last multiple of `trigger`.

    The window does not have to be full. Instead of numbering all rows, the
    newest n + trigger - 1 rows are ranked backwards and placed with the count.
    """
    if trigger == 1:
        if not keys:
            return df.orderBy(*_desc(order)).limit(n)
        return _newest(df, n, order, keys).drop("__back")
    rows = _newest(df, n + trigger - 1, order, keys)
    if keys:
        rows = _with_per_key(rows, df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__count")), keys)
        count = F.col("__count")
    else:
        count = df.agg(F.count(F.lit(1))).scalar()
    pending = F.pmod(count, F.lit(trigger))
    return rows.where((F.col("__back") > pending) & (F.col("__back") <= pending + n)).drop("__back", "__count")


def last_batch(df: DataFrame, n: int, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Tumbling count window: the last complete batch of `n` rows, none before it."""
    return last_n(df, n, order, keys, trigger=n)


def sliding_time(df: DataFrame, size: timedelta, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sliding time window frozen at the newest row (of the key)."""
    if not keys:
        return df.where(F.col(ts) > df.agg(F.max(ts)).scalar() - F.lit(size))
    newest = df.groupBy(*keys).agg(F.max(ts).alias("__as_of"))
    rows = _with_per_key(df, newest, keys)
    return rows.where(F.col(ts) > F.col("__as_of") - F.lit(size)).drop("__as_of")


def tumbling_time(df: DataFrame, size: timedelta, ts: str, start: timedelta = timedelta(0)) -> DataFrame:
    """Tumbling time window: rows of the newest window that has ended by max(ts).

    Windows are aligned to the epoch plus `start`. All partitions share the
    clock, so a partition without rows in that window is empty.
    """
    width, shift = (f"{round(t.total_seconds() * 1e6)} microseconds" for t in (size, start))
    # the window of the newest row is still open: its start ends the wanted one
    newest = df.agg(F.max(ts).alias(ts)).select(F.window(ts, width, startTime=shift)["start"].alias("end"))
    end = newest.scalar()
    return df.where((F.col(ts) >= end - F.lit(size)) & (F.col(ts) < end))


def delta_window(
    df: DataFrame, attribute: str, distance: float | int, order: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Rows whose attribute is within `distance` of the newest row's value."""
    newest = F.max_by(attribute, F.struct(*order)).alias("__newest")
    if keys:
        rows = _with_per_key(df, df.groupBy(*keys).agg(newest), keys)
        reference = F.col("__newest")
    else:
        rows, reference = df, df.agg(newest).scalar()
    return rows.where(F.abs(reference - F.col(attribute)) <= F.lit(distance)).drop("__newest")


def punct_window(df: DataFrame, punct: str, order: Sequence[str]) -> DataFrame:
    """Rows of the last segment closed by a punctuation row (`punct` is true).

    Only the two newest punctuations matter, so no running count is needed.
    Punctuations belong to the stream and close the segment of every partition.
    """
    place = F.struct(*order)
    marks = df.where(F.col(punct)).orderBy(*_desc(order)).limit(2).select(place.alias("at"), F.col(order[0]).alias("lead"))
    ends = marks.agg(F.max("at").alias("close"), F.min("at").alias("open"), F.count("at").alias("n"), F.max("lead").alias("lead"))
    close = ends.select("close").scalar()
    opened = ends.select(F.when(F.col("n") == 2, F.col("open"))).scalar()
    rows = df.where(~F.col(punct)).where((F.col(order[0]) <= ends.select("lead").scalar()) & (place < close))
    return rows.where(F.coalesce(place > opened, F.lit(True)))


# ---- view specification and single requests ----------------------------------------


@dataclass(frozen=True)
class SlidingTime:
    """Rows younger than `size` as of the newest row (of the key)."""

    size: timedelta

    def contents(self, df: DataFrame, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
        return sliding_time(df, self.size, order[0], keys)


@dataclass(frozen=True)
class TumblingTime:
    """Rows of the newest ended window of `size`, aligned to the epoch plus `start`."""

    size: timedelta
    start: timedelta = timedelta(0)

    def contents(self, df: DataFrame, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
        return tumbling_time(df, self.size, order[0], self.start)


@dataclass(frozen=True)
class Delta:
    """Rows whose attribute is within `distance` of the newest row's value."""

    attribute: str
    distance: float | int

    def contents(self, df: DataFrame, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
        return delta_window(df, self.attribute, self.distance, order, keys)


@dataclass(frozen=True)
class Punctuation:
    """Rows of the last segment that a row with a true `column` closed."""

    column: str

    def contents(self, df: DataFrame, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
        return punct_window(df, self.column, order)


@dataclass(frozen=True)
class ViewSpec:
    """One view port: its window, order, keys and query rules.

    Without `window` it is a count window of `n` rows.

    `attributes` are the columns of the port (technical order columns excluded);
    empty means all columns of the frame.
    """

    order: Sequence[str]
    n: int = 1
    keys: Sequence[str] = ()
    tumbling: bool = False
    trigger: int = 1
    named: bool = False
    force_empty: bool = False
    attributes: Sequence[str] = ()
    window: SlidingTime | TumblingTime | Delta | Punctuation | None = None

    def columns(self, df: DataFrame) -> list[str]:
        return list(self.attributes) or df.columns


@dataclass(frozen=True)
class ViewQuery:
    """A decoded query string: values by key, and the projection."""

    values: dict[str, str] = field(default_factory=dict)
    attribute: Sequence[str] | None = None
    suppress: Sequence[str] = ()


class QueryError(ValueError):
    """A request that cannot be answered."""


def snapshot(df: DataFrame, spec: ViewSpec) -> DataFrame:
    """Contents of all partitions of the view. Unknown or repeated keys are an error."""
    check_views([ViewPort(df.schema, bool(spec.keys))], partition_by=[",".join(spec.keys)] if spec.keys else None)
    if spec.window is not None:
        return spec.window.contents(df, spec.order, spec.keys)
    return last_n(df, spec.n, spec.order, spec.keys, trigger=spec.n if spec.tumbling else spec.trigger)


def read_query(text: str, spec: ViewSpec) -> ViewQuery:
    """Interpret a `/tuples` query string for a port.

    In named mode `attribute`, `suppress` and `callback` are partition names
    when a key is called so. Unknown names count as no partition given. A key
    value that cannot be decoded is an error.
    """
    _check_encoding(text or "", spec)
    pairs = parse_qsl(text or "", keep_blank_values=True)
    keys_taken = set(spec.keys) if spec.named else set()

    def listed(name: str) -> list[str] | None:
        values = [value for key, value in pairs if key == name]
        return values if values and name not in keys_taken else None

    values: dict[str, str] = {}
    if spec.named:
        for name, value in pairs:
            if name in spec.keys:
                values.setdefault(name, value)
    elif spec.keys:
        given = [value for name, value in pairs if name == "partition"]
        if given and len(given) < len(spec.keys):
            raise QueryError("too few partition values")
        values = dict(zip(spec.keys, given))
    return ViewQuery(values, listed("attribute"), listed("suppress") or ())


def _check_encoding(text: str, spec: ViewSpec) -> None:
    """Values of keys must be well encoded UTF-8."""
    position = 0
    for piece in filter(None, text.split("&")):
        name, _, value = piece.partition("=")
        name = unquote_plus(name)
        if spec.named:
            key = name if name in spec.keys else None
        else:
            key = spec.keys[position] if name == "partition" and position < len(spec.keys) else None
            position += name == "partition"
        if key is None:
            continue
        try:
            broken = re.search("%(?![0-9A-Fa-f]{2})", value)
            unquote_plus(value, errors="strict")
        except UnicodeDecodeError:
            broken = True
        if broken:
            raise QueryError(f"bad partition value for {key}")


def _unsupported(kind: str) -> bool:
    return kind in FLOATS or kind in ("timestamp", "blob", "xml") or "<" in kind


def key_predicate(df: DataFrame, spec: ViewSpec, query: ViewQuery) -> Column:
    """Literal predicates for the given keys only, so that they reach the scan."""
    if spec.keys and not query.values:
        return F.lit(not spec.force_empty)
    parts = [F.lit(True)]
    for name, text in query.values.items():
        kind = attribute_type(df.schema[name])
        if _unsupported(kind):
            raise QueryError(f"unsupported partition type for {name}")
        parts.append(F.col(name) == coerce(F.lit(text), kind))
    return reduce(lambda a, b: a & b, parts)


def projected(df: DataFrame, spec: ViewSpec, query: ViewQuery) -> list[str]:
    """Columns a request sees: `attribute` order first, then `suppress` removed."""
    names = spec.columns(df)
    if query.attribute is not None:
        names = [name for name in dict.fromkeys(query.attribute) if name in names]
    return [name for name in names if name not in set(query.suppress)]


def read_view(df: DataFrame, spec: ViewSpec, query_text: str = "") -> DataFrame:
    """Rows one request gets. Catalyst pushes the key predicate below the rank."""
    query = read_query(query_text, spec)
    rows = snapshot(df, spec).where(key_predicate(df, spec, query))
    return rows.select(*projected(df, spec, query))


# ---- rendering ---------------------------------------------------------------------


def _json_value(row: Column, field_: T.StructField) -> Column:
    if field_.name == JSON_ATTRIBUTE and isinstance(field_.dataType, T.StringType):
        return F.try_parse_json(row[field_.name]).alias(field_.name)
    return row[field_.name].alias(field_.name)


def _keep_nulls(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_cells(df: DataFrame, attributes: Sequence[str]) -> Column:
    """The attributes of a row as JSON texts `"name":value`; of a pure JSON port the document itself."""

    def text(field_: T.StructField) -> Column:
        value = F.col(field_.name)
        if list(attributes) == [JSON_ATTRIBUTE]:
            return F.coalesce(F.try_parse_json(value).cast("string"), F.lit("null"))
        if field_.name == JSON_ATTRIBUTE and isinstance(field_.dataType, T.StringType):
            value = F.try_parse_json(value)
        braced = _keep_nulls(F.struct(value.alias(field_.name)))
        return F.substring(braced, F.lit(2), F.length(braced) - 2)

    return F.array(*[text(df.schema[name]) for name in attributes]) if attributes else F.array().cast("array<string>")


def render(
    contents: DataFrame, order: Sequence[str], attributes: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """One JSON array per partition, rows in window order; bounded by the window.

    A text attribute `jsonString` is embedded as JSON. When it is the only
    attribute the array holds the documents themselves.
    """
    fields = [contents.schema[name] for name in attributes]
    entry = F.struct(*[F.col(name).alias(f"o{i}") for i, name in enumerate(order)], F.struct(*attributes).alias("row"))
    grouped = contents.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    if list(attributes) == [JSON_ATTRIBUTE]:
        documents = F.transform("rows", lambda e: F.try_parse_json(e["row"][JSON_ATTRIBUTE]))
    else:
        documents = F.transform("rows", lambda e: F.struct(*[_json_value(e["row"], f) for f in fields]))
    return grouped.select(*keys, F.size("rows").cast("bigint").alias("n"), _keep_nulls(documents).alias("json"))


def render_view(df: DataFrame, spec: ViewSpec, query_text: str = "") -> DataFrame:
    """The JSON a request gets, one row per partition (one row without keys)."""
    query = read_query(query_text, spec)
    rows = snapshot(df, spec).where(key_predicate(df, spec, query))
    names = spec.columns(df)
    if names != [JSON_ATTRIBUTE]:
        names = projected(df, spec, query)
    return render(rows, spec.order, names, spec.keys)


# ---- many requests -------------------------------------------------------------------


def _coerced_key(df: DataFrame, key: str, text: Column, present: Column) -> tuple[Column, Column]:
    """Typed value and error of a key; a value that is there but cannot be decoded is an error, not a wildcard."""
    kind = attribute_type(df.schema[key])
    if _unsupported(kind):
        return F.lit(None).cast(df.schema[key].dataType), F.lit(f"unsupported partition type for {key}")
    value = coerce(text, kind)
    return value, F.when(present & value.isNull(), F.lit(f"bad partition value for {key}"))


def read_requests(df: DataFrame, spec: ViewSpec, requests: DataFrame) -> DataFrame:
    """Decode the `query` column of many requests against one port.

    Adds one typed column `q_<key>` per key (null = not given) and `error`,
    null for requests that can be answered.
    """
    decoded = requests.withColumn("__pairs", http.split_pairs(F.col("query")))
    given = http.all_values(F.col("__pairs"), "partition")
    errors = []
    for at, key in enumerate(spec.keys):
        if spec.named:
            text = http.first_value(F.col("__pairs"), key)
            present = F.coalesce(F.array_contains(F.col("__pairs")["name"], key), F.lit(False))
        else:
            text, present = F.get(given, F.lit(at)), F.size(given) > at
        value, error = _coerced_key(df, key, text, present)
        decoded = decoded.withColumn(f"q_{key}", value)
        errors.append(error)
    if not spec.named and spec.keys:
        short = F.size(given).between(1, len(spec.keys) - 1)
        errors.insert(0, F.when(short, F.lit("too few partition values")))
    error = F.coalesce(*errors) if errors else F.lit(None).cast("string")
    return decoded.withColumn("error", error).drop("__pairs")


def _mask(keys: Sequence[str]) -> Column:
    """Which keys a request gives, as a text of 0 and 1."""
    return F.concat(*[F.col(f"q_{k}").isNotNull().cast("int").cast("string") for k in keys])


def answer_requests(contents: DataFrame, requests: DataFrame, spec: ViewSpec) -> DataFrame:
    """Rows of the snapshot for every request of `read_requests`.

    A key that is not given matches anything. To stay with an equi-join the
    snapshot is repeated for every subset of given keys; a request meets only
    its own subset. Requests with an error get no rows.
    """
    keys = list(spec.keys)
    good = requests.where(F.col("error").isNull())
    if not keys:
        raise QueryError("a port without keys has one answer for all requests: use read_view")
    asked = good.withColumn("__mask_q", _mask(keys))
    # only the subsets that occur: no more than requests, and no more than 2^keys
    occurring = {row[0] for row in asked.select("__mask_q").distinct().collect()}
    masks = [m for m in product([0, 1], repeat=len(keys)) if "".join(map(str, m)) in occurring]
    if spec.force_empty:
        masks = [mask for mask in masks if any(mask)]
    if not masks:
        masks = [(1,) * len(keys)]

    def mask_struct(mask: tuple[int, ...]) -> Column:
        parts = [F.lit("".join(map(str, mask))).alias("__mask")]
        for bit, key in zip(mask, keys):
            value = F.col(key) if bit else F.lit(None).cast(contents.schema[key].dataType)
            parts.append(value.alias(f"__{key}"))
        return F.struct(*parts)

    repeated = contents.withColumn("__m", F.explode(F.array(*[mask_struct(m) for m in masks])))
    repeated = repeated.select(*contents.columns, "__m.*")
    same = F.col("__mask_q") == F.col("__mask")
    for key in keys:
        same = same & F.col(f"q_{key}").eqNullSafe(F.col(f"__{key}"))
    dropped = ["__mask", "__mask_q", *[f"__{k}" for k in keys], *[f"q_{k}" for k in keys]]
    return asked.drop("error").join(repeated, same).drop(*dropped)


def answer_as_of(
    tuples: DataFrame, requests: DataFrame, spec: ViewSpec, request_id: str = "request_id", layout: Layout | None = None
) -> DataFrame:
    """What every request saw at its own time.

    Both frames carry the keys and the order columns of the view. A request
    sees the tuples ordered at or before it, as of the last trigger. In a count
    window tuples and requests are numbered together, so that a request knows
    how many tuples of its key came before; it then meets the one or two blocks
    of `n` tuples that hold its rows. A sliding time window is answered by such
    blocks too, any other window, and requests that leave a key out, by the spans
    in which rows are shown. `position` counts the rows of an answer.
    """
    if spec.window is not None:
        return _answer_windows(tuples, requests, spec, request_id, layout)
    keys, order, n = list(spec.keys), list(spec.order), spec.n
    trigger = n if spec.tumbling else spec.trigger
    tuple_side = tuples.withColumn("__request", F.lit(0))
    request_side = requests.select(*keys, *order, F.col(request_id).alias("__request_id"), F.lit(1).alias("__request"))
    both = tuple_side.unionByName(request_side, allowMissingColumns=True)
    numbered = running(
        both, [*order, "__request"], "__r", (1 - F.col("__request")).cast("bigint"), keys=keys, layout=layout
    )
    block = F.call_function("div", F.col("__r") - 1, F.lit(n))
    rows = numbered.where("__request = 0").select(*tuples.columns, "__r", block.alias("__block"))
    shown = F.col("__r") - F.pmod(F.col("__r"), F.lit(trigger))
    first = F.call_function("div", F.greatest(F.col("__shown") - n, F.lit(0)), F.lit(n))
    last = F.call_function("div", F.col("__shown") - 1, F.lit(n))
    asked = (
        numbered.where("__request = 1")
        .select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__request_id").alias(request_id), shown.alias("__shown"))
        .where("__shown > 0")
        .withColumn("__want", F.explode(F.sequence(first, last)))
    )
    on = (F.col("__want") == F.col("__block")) & (F.col("__r") <= F.col("__shown")) & (F.col("__r") > F.col("__shown") - n)
    if keys:
        on = on & _same_keys(keys)
    joined = asked.join(rows, on)
    position = (F.col("__r") - F.greatest(F.col("__shown") - n, F.lit(0))).alias("position")
    return joined.select(request_id, position, *tuples.columns)


def _answer_windows(
    tuples: DataFrame, requests: DataFrame, spec: ViewSpec, request_id: str, layout: Layout | None
) -> DataFrame:
    # that module is built on this one
    from wireglass.operators.as_of import answer_ranges, apart, see

    order = list(spec.order)
    ranged = None
    if isinstance(spec.window, SlidingTime) and order[0] not in spec.keys:
        groups, others = apart(requests, spec, request_id)
        ranged = answer_ranges(tuples, groups, spec, request_id, layout)
        if others.isEmpty():
            return ranged
        rest = others.select(F.col(request_id).alias("__other"))
        requests = requests.join(rest, F.col(request_id).eqNullSafe(F.col("__other")), "left_semi")
    given = [F.col(k).alias(f"q_{k}") for k in spec.keys]
    asked = requests.select(F.col(request_id).alias("__request_id"), *given, F.struct(*order).alias("__at"))
    seen = see(tuples, asked, replace(spec, force_empty=False), "__at", layout=layout)
    mine = Window.partitionBy("__request_id").orderBy(*order)
    position = F.row_number().over(mine).cast("bigint").alias("position")
    answers = seen.select(F.col("__request_id").alias(request_id), position, *tuples.columns)
    return answers if ranged is None else ranged.unionByName(answers)


def latest(df: DataFrame, value: str, order: Sequence[str], ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Newest value and its arrival time per key; empty text means no content."""
    newest = F.max_by(F.struct(F.col(value), F.col(ts)), F.struct(*order)).alias("newest")
    rows = df.groupBy(*keys).agg(newest)
    content = F.coalesce(F.col(f"newest.{value}"), F.lit(""))
    return rows.select(
        *keys, content.alias(value), F.col(f"newest.{ts}").alias("arrived"), (content != "").alias("has_content")
    )
