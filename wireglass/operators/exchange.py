"""Request and response processing: correlation, timeouts, forms, routing."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglass.functions import http
from wireglass.functions.types import attribute_type, default
from wireglass.plans.buckets import Layout
from wireglass.plans.checks import check_request_port
from wireglass.plans.intervals import by_width, contained
from wireglass.plans.ordered import Measure, measures, running, sequence
from wireglass.plans.pinned import pinned

# Defaults of the exchange.
TIMEOUT = timedelta(seconds=15)
# Texts a form answer reports.
NO_FORM_DATA, BAD_PAIR = "ERROR-noFormData", "ERROR-nameValueParse"
PARAMETERS_MISSING, NAME_MISSING = "ERROR-notRequiredParams", "ERROR-nameRequired"
# what stands for a status number out of range
NO_STATUS = -1
DEFAULT_STATUS = 200
TIMEOUT_STATUS = 408

# ---- request side ----------------------------------------------------------------


def assign_tracking_key(df: DataFrame, order: list[str], name: str = "key", layout: Layout | None = None) -> DataFrame:
    """Number requests 1, 2, 3, ... in arrival order."""
    return sequence(df, order, name, layout=layout)


def request_payload(url: Column, body: Column) -> Column:
    """Raw query string if the URL has one, else the body without line breaks."""
    return F.coalesce(http.url_query(url), F.regexp_replace(http.body_text(body), "[\r\n]", ""))


def _request_fields() -> dict[str, Column]:
    return {
        "request": request_payload(F.col("url"), F.col("body")),
        "method": F.col("method"),
        "contentType": F.col("content_type"),
        "contextPath": F.col("context_path"),
        "pathInfo": F.nullif(F.col("path_info"), F.lit("")),
        "url": http.url_without_query(F.col("url")),
        "header": F.col("headers"),
    }


def request_tuples(df: DataFrame, schema: T.StructType, **names: str) -> DataFrame:
    """Request attributes of routed, numbered requests, as the port schema asks.

    `names` overrides attribute names. Absent values are ``; attributes that
    take no request field have their default.
    """
    found = check_request_port(schema, **names)
    if found is None:
        return request_json(df).select(F.col("json").alias(schema.fieldNames()[0]))
    fields = {**_request_fields(), "key": F.col("key")}
    source = {attribute: field for field, attribute in found.items()}
    columns = []
    for field in schema.fields:
        if field.name in source:
            value = fields[source[field.name]]
            if source[field.name] != "key":
                value = F.coalesce(value, default(attribute_type(field)))
        else:
            value = default(attribute_type(field))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def request_json(df: DataFrame) -> DataFrame:
    """The whole request as one JSON object; absent values stay null."""
    fields = {"key": F.col("key"), **_request_fields()}
    packed = F.struct(*[value.alias(name) for name, value in fields.items()])
    return df.select("key", F.to_json(packed, {"ignoreNullFields": "false"}).alias("json"))


# ---- response side ---------------------------------------------------------------


def response_defaults(df: DataFrame) -> DataFrame:
    """Tuple mode: fill what a response leaves open. Empty content type = default."""
    have = set(df.columns)

    def value(name: str, fallback: Column) -> Column:
        return F.coalesce(F.col(name), fallback) if name in have else fallback

    return df.withColumns(
        {
            "response": value("response", F.lit("")),
            "status": value("status", F.lit(DEFAULT_STATUS)),
            "contentType": F.coalesce(F.nullif(value("contentType", F.lit("")), F.lit("")), F.lit(http.TEXT)),
            "header": value("header", F.create_map().cast("map<string,string>")),
        }
    )


def response_from_json(df: DataFrame, column: str = "jsonString") -> DataFrame:
    """JSON mode: decode a response document.

    `error` is `missing tracking key` when the text is no object or its key is
    no integer (such a row answers nobody). A field of the wrong type makes the
    answer a 400. Null fields take the defaults.
    """
    names = ("key", "response", "status", "contentType", "header")
    doc = pinned(df, {"__doc": F.try_parse_json(F.col(column))})
    parts = {f"__{name}": F.try_variant_get("__doc", f"$.{name}", "variant") for name in names}
    doc = pinned(doc, parts)
    # null and absent fields have the type VOID
    kinds = {f"__{name}_type": F.coalesce(F.schema_of_variant(F.col(f"__{name}")), F.lit("VOID")) for name in names}
    doc = pinned(doc, kinds)

    def wrong(name: str, wanted: str) -> Column:
        return ~F.col(f"__{name}_type").rlike(f"^(VOID|{wanted})$")

    # every header value must be a text: `OBJECT<name: STRING, ...>`
    bad = (
        wrong("response", "STRING")
        | wrong("status", "BIGINT")
        | wrong("contentType", "STRING")
        | wrong("header", "OBJECT<([^:]*: STRING,? ?)*>")
    )
    doc = doc.withColumn("__bad", bad)

    def field(name: str, kind: str, fallback: Column) -> Column:
        value = F.try_variant_get(f"__{name}", "$", kind)
        return F.when(F.col("__bad"), fallback).otherwise(F.coalesce(value, fallback))

    decoded = doc.withColumns(
        {
            "key": F.when(F.col("__key_type") == "BIGINT", F.try_variant_get("__key", "$", "bigint")),
            "response": field("response", "string", F.lit("")),
            # a number no int holds is no status, and becomes a 500 like any other outside 100..599
            "status": F.when(F.col("__bad"), F.lit(400)).otherwise(
                F.coalesce(field("status", "bigint", F.lit(DEFAULT_STATUS)).try_cast("int"), F.lit(NO_STATUS))
            ),
            "contentType": field("contentType", "string", F.lit(http.TEXT)),
            "header": field("header", "map<string,string>", F.create_map().cast("map<string,string>")),
        }
    )
    decoded = decoded.withColumn("error", F.when(F.col("key").isNull(), F.lit("missing tracking key")))
    return decoded.drop("__doc", "__bad", *parts, *kinds)


def drop_markers(df: DataFrame, column: str = "is_punct") -> DataFrame:
    """Window markers on the response port are ignored."""
    return df.where(~F.coalesce(F.col(column), F.lit(False))) if column in df.columns else df


# ---- correlation -------------------------------------------------------------------


def _first_responses(requests: DataFrame, responses: DataFrame, timeout: timedelta, tie: str) -> DataFrame:
    """(__key, __ts, __id): earliest response of each request inside [req_ts, req_ts + timeout).

    The join key holds the time bucket as well, so that a key with very many
    responses is spread, and only the narrow request keys are repeated. The
    minimum is taken over two narrow columns before rows are brought together by key.
    """
    asked = requests.select("key", F.col("req_ts").alias("__from"), (F.col("req_ts") + F.lit(timeout)).alias("__to"))
    width = max(round(timeout.total_seconds() * 1e6), 1)
    inside = contained(responses, asked, "rsp_ts", "__from", "__to", by_width(width), keys=["key"])
    # by time first, so that both steps keep plain numbers and can hash
    by_time = inside.groupBy("key", "rsp_ts").agg(F.min(tie).alias(tie))
    first = by_time.groupBy("key").agg(F.min("rsp_ts").alias("__ts"), F.min_by(tie, "rsp_ts").alias("__id"))
    return first.withColumnRenamed("key", "__key")


def _answers(requests: DataFrame, responses: DataFrame, timeout: timedelta, tie: str) -> DataFrame:
    """key and answer: the whole first response, fetched by its id after the narrow minimum.

    A response may be there several times: of rows that agree in key, time and
    id one answers (of different contents the least as JSON text).
    """
    first = _first_responses(requests, responses.select("key", "rsp_ts", tie), timeout, tie)
    answer = F.struct(*[c for c in responses.columns if c != "key"])
    fetched = responses.join(first, _is_first(tie)).select("key", answer.alias("answer"))
    # copies are cut to one per task before the shuffle; the sort by key serves the join with the requests too
    one = F.row_number().over(Window.partitionBy("key").orderBy(F.to_json("answer")))
    return fetched.withColumn("__copy", one).where(F.col("__copy") == 1).drop("__copy")


def _is_first(tie: str) -> Column:
    return (F.col("key") == F.col("__key")) & (F.col("rsp_ts") == F.col("__ts")) & (F.col(tie) == F.col("__id"))


def correlate(requests: DataFrame, responses: DataFrame, timeout: timedelta = TIMEOUT, tie: str = "rsp_id") -> DataFrame:
    """One row per request with its answer, or 408 when none came in time.

    `requests` has unique `key` and `req_ts`; `responses` has `key`, `rsp_ts`,
    the tie-break column and the fields of `response_defaults`. The first
    response wins, however often it was delivered. A status outside 100..599 turns the answer into a 500.
    """
    first = _answers(requests, responses, timeout, tie)
    joined = requests.join(first, "key", "left")
    answered = F.col("answer").isNotNull()
    given = F.col("answer.status")
    valid = F.coalesce(given.between(100, 599), F.lit(False))
    status = F.when(~answered, TIMEOUT_STATUS).when(valid, given).otherwise(500)
    outcome = F.when(~answered, "timeout").when(valid, "responded").otherwise("error")
    body = F.when(~answered, "").when(valid, F.col("answer.response")).otherwise("invalid status")
    done = F.when(answered, F.col("answer.rsp_ts")).otherwise(F.col("req_ts") + F.lit(timeout))
    return joined.withColumns(
        {
            "status": status.cast("int"),
            "outcome": outcome,
            "response": body,
            "done_ts": done,
            tie: F.col(f"answer.{tie}"),
        }
    ).drop("answer")


def timeouts(requests: DataFrame, responses: DataFrame, timeout: timedelta = TIMEOUT, tie: str = "rsp_id") -> DataFrame:
    """Requests nobody answered in time, with the time they were given up."""
    return correlate(requests, responses, timeout, tie).where("outcome = 'timeout'")


def unmatched_responses(
    requests: DataFrame, responses: DataFrame, timeout: timedelta = TIMEOUT, tie: str = "rsp_id"
) -> DataFrame:
    """Responses that answered no request: late, second, repeated or with an unknown key.

    Joined on key and the response's own place: no hot key. The key is gone with its
    first use, so of equal rows all but the one that answered are unmatched;
    they are counted, not brought together.
    """
    first = _first_responses(requests, responses.select("key", "rsp_ts", tie), timeout, tie)
    row = F.struct(*responses.columns).alias("row")
    copies = responses.join(first, _is_first(tie)).select("key", row)
    copies = copies.groupBy("key", F.to_json("row").alias("text")).agg(F.first("row").alias("row"), F.count("*").alias("n"))
    # one row per different content of a key's first response
    answering = F.row_number().over(Window.partitionBy("key").orderBy("text")) == 1
    left = copies.select("row", (F.col("n") - F.when(answering, 1).otherwise(0)).alias("n")).where("n > 0")
    again = left.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).select("row.*")
    return responses.join(first, _is_first(tie), "left_anti").unionByName(again)


def metrics(requests: DataFrame, responses: DataFrame, timeout: timedelta = TIMEOUT, tie: str = "rsp_id") -> DataFrame:
    """Counters of the exchange, one row. `responses.error` marks missing keys."""
    missing = F.col("error").isNotNull() if "error" in responses.columns else F.lit(False)
    usable = responses.where(~missing)
    zero = F.lit(0).cast("bigint")
    outcome = correlate(requests, usable, timeout, tie).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("outcome") == "responded").alias("responded"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
        F.count_if(F.col("outcome") == "timeout").alias("timeouts"),
        zero.alias("missing_key"),
        zero.alias("arrived"),
    )
    arrived = responses.agg(
        *[zero.alias(n) for n in ("received", "responded", "errors", "timeouts")],
        F.count_if(missing).alias("missing_key"),
        F.count_if(~missing).alias("arrived"),
    )
    total = outcome.unionByName(arrived).agg(*[F.sum(c).alias(c) for c in outcome.columns])
    found = F.col("responded") + F.col("errors")
    return total.withColumn("key_not_found", F.col("arrived") - found).drop("arrived")


def active_gauge(correlated: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Requests in flight after every arrival and completion; completions first on ties.

    Reads its input twice: give it the written answers rather than the join.
    """
    changes = F.array(
        F.struct(F.col("req_ts").alias("ts"), F.lit(1).alias("delta")),
        F.struct(F.col("done_ts").alias("ts"), F.lit(-1).alias("delta")),
    )
    events = correlated.select("key", F.explode(changes).alias("e")).select("key", "e.ts", "e.delta")
    return running(events, ["ts", "delta", "key"], "active", F.col("delta").cast("bigint"), layout=layout)


def completion_order(correlated: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Arrival and completion number of answered requests, and whether one overtook.

    A request overtakes when it completes before one that arrived earlier.
    Reads its input several times: give it the written answers.
    """
    done = correlated.where("outcome <> 'timeout'").select("key", "req_ts", "done_ts")
    arrival = {
        "arrival_no": Measure(F.lit(1).cast("bigint")),
        "__latest": Measure(F.col("done_ts"), how="max", inclusive=False),
    }
    numbered = measures(done, ["req_ts", "key"], arrival, layout=layout)
    numbered = sequence(numbered, ["done_ts", "key"], "completion_no", layout=layout)
    overtook = F.coalesce(F.col("done_ts") < F.col("__latest"), F.lit(False))
    return numbered.withColumn("overtook", overtook).drop("__latest")


# ---- work between request and response ----------------------------------------------


def reflect(request: Column, fill: int, letter: str = "X") -> Column:
    """The payload followed by `fill` letters."""
    return F.concat(request, F.repeat(F.lit(letter), fill))


def route_by_path(df: DataFrame, routes: dict[str, Column]) -> DataFrame:
    """Transform the payload by `pathInfo`; other paths are dropped. One pass."""
    response = None
    for path, value in routes.items():
        matches = F.col("pathInfo") == path
        response = F.when(matches, value) if response is None else response.when(matches, value)
    return df.where(F.col("pathInfo").isin(*routes)).withColumn("response", response)


def form_to_map(df: DataFrame, payload: str = "request") -> DataFrame:
    """Add `formdata` and `error` from an undecoded form payload.

    Of a repeated name the last value stays; text behind a second `=` is
    ignored.
    """
    split = pinned(df, {"__all": F.split(F.col(payload), "&")})
    split = pinned(split, {"__entries": F.reverse(F.filter("__all", lambda e: e != ""))})

    def piece(number: int) -> Column:
        return F.transform("__entries", lambda e: F.split_part(e, F.lit("="), F.lit(number)))

    split = pinned(split, {"__names": piece(1), "__values": piece(2)})
    empty = F.coalesce(F.col(payload), F.lit("")) == ""
    nothing = F.create_map().cast("map<string,string>")
    error = (
        F.when(empty, NO_FORM_DATA).when(F.array_contains("__all", ""), BAD_PAIR).otherwise("")
    )
    formdata = F.coalesce(http.first_values(F.col("__names"), F.col("__values")), nothing)
    return pinned(split, {"formdata": formdata, "error": error}).drop("__all", "__entries", "__names", "__values")


def form_status(df: DataFrame) -> DataFrame:
    """Add `status` and `response` (the error text) for a login form map."""
    form = F.col("formdata")
    complete = F.lit(True)
    for name in ("name", "password", "profession"):
        complete = complete & F.map_contains_key(form, name)
    status = (
        F.when((F.col("error") != "") | ~complete | (form["name"] == ""), 400)
        .when(form["password"] == "", 401)
        .otherwise(200)
    )
    text = (
        F.when(F.col("error") != "", F.col("error"))
        .when(~complete, PARAMETERS_MISSING)
        .when(form["name"] == "", NAME_MISSING)
        .otherwise("")
    )
    return df.withColumn("status", status).withColumn("response", text)


def render_template(template: Column, values: dict[str, Column]) -> Column:
    """Replace `%name%` by the value, literally."""
    for name, value in values.items():
        template = F.replace(template, F.lit(f"%{name}%"), value)
    return template


def pair_turns(df: DataFrame, request_role: str = "user", response_role: str = "assistant") -> DataFrame:
    """Conversation turns as request and response: turn t with turn t + 1.

    Joined on (conversation, turn), so a long conversation is spread.
    """
    asked = df.where(F.col("role") == request_role).select("conv_id", "turn", F.col("text").alias("request"))
    told = df.where(F.col("role") == response_role).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(told, ["conv_id", "turn"], "left")


# ---- JSON text and tuples --------------------------------------------------------------


def json_to_tuple(df: DataFrame, schema: T.StructType, column: str = "jsonString") -> DataFrame:
    """Typed tuple from JSON text; `error` marks text that does not fit the schema."""
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = df.withColumn("__t", F.from_json(F.col(column), with_corrupt, options))
    values = {f.name: F.coalesce(F.col("__t")[f.name], default(attribute_type(f))) for f in schema.fields}
    broken = F.col("__t").isNull() | F.col("__t._corrupt").isNotNull()
    return parsed.withColumns({**values, "error": F.when(broken, F.lit("not a tuple"))}).drop("__t")


def tuple_to_json(df: DataFrame, attributes: list[str], name: str = "jsonString") -> DataFrame:
    return df.withColumn(name, F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}))
