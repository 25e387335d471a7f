"""Ingest: captured requests to typed tuples, with rejects kept apart.

Every step adds columns and at most a reason in `error`; the first reason
stays. One narrow stage from scan to write, no shuffle, and no row can fail
the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglass.functions import http
from wireglass.functions.types import attribute_type, coerce_or_default, default
from wireglass.plans.checks import check_inject
from wireglass.plans.pinned import pinned

# The URL forms below `/ports` and what each direction offers.
ROUTE = (
    r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?(?:/([^/?#]+))?/([^/?#]+)/ports"
    r"/(output|input|analyze)/([0-9]+)(/[^?#]*)?(?:[?#].*)?$"
)
OUTPUT_ACTIONS = ("inject", "form", "info", "wsinject")
INPUT_ACTIONS = ("tuples", "attribute", "info", "wssend")
CONTENT_TYPES = {"json": http.JSON, "xml": http.XML, "blob": http.OCTETS}


def with_error(df: DataFrame, reason: Column) -> DataFrame:
    """Set `error` where `reason` is not null and there is none yet."""
    if "error" in df.columns:
        reason = F.coalesce(F.col("error"), reason)
    return df.withColumn("error", reason)


def route_requests(df: DataFrame) -> DataFrame:
    """Add context, operator, direction, port, action, context_path and path_info.

    `/ctx/Op/ports/...` carries a context and a base name, `/full.name/ports/...`
    a full operator name. Requests below no port get the error `no route`, and so
    do port numbers above the int range.
    """
    # one pass of the pattern: its groups, joined by a character no URL holds
    groups = F.split(F.regexp_replace(F.col("url"), ROUTE, "$1\u0001$2\u0001$3\u0001$4\u0001$5"), "\u0001")
    split = pinned(df, {"__parts": F.coalesce(groups, F.array().cast("array<string>"))})
    matched = F.size("__parts") == 5
    names = ("context", "operator", "__side", "__port", "__rest")
    parts = {name: F.when(matched, F.get("__parts", F.lit(at))).otherwise(F.lit("")) for at, name in enumerate(names)}
    routed = pinned(split, parts)
    analyze = F.col("__side") == "analyze"
    name = F.substring(F.col("__rest"), F.lit(2), F.length("__rest"))
    offered = ((F.col("__side") == "output") & name.isin(*OUTPUT_ACTIONS)) | (
        (F.col("__side") == "input") & name.isin(*INPUT_ACTIONS)
    )
    routed = routed.withColumn("action", F.when(analyze, F.lit("analyze")).when(offered, name).otherwise(F.lit("")))
    number = F.col("__port").try_cast("int")
    routed = routed.withColumn("action", F.when(number.isNull(), "").otherwise(F.col("action")))
    known = F.col("action") != ""

    def kept(value: Column) -> Column:
        return F.when(known, value).otherwise(F.lit(""))

    prefix = F.concat(F.when(F.col("context") == "", "").otherwise(F.concat(F.lit("/"), "context")), F.lit("/"), "operator")
    routed = routed.withColumns(
        {
            "direction": kept(F.when(analyze, F.lit("output")).otherwise(F.col("__side"))),
            "port": F.when(known, number),
            "context_path": kept(F.concat(prefix, F.lit("/ports"))),
            "path_info": F.when(analyze, F.col("__rest")).otherwise(F.lit("")),
        }
    )
    routed = routed.withColumns({"context": kept(F.col("context")), "operator": kept(F.col("operator"))})
    return with_error(routed.drop("__parts", "__side", "__port", "__rest"), F.when(~known, F.lit("no route")))


def content_type_gate(df: DataFrame, payload: str) -> DataFrame:
    """Reject requests whose content type is not the one of a payload kind."""
    wanted = CONTENT_TYPES[payload]
    bad = ~http.has_content_type(F.col("content_type"), wanted)
    return with_error(df, F.when(bad, F.lit(f"content type is not {wanted}")))


def method_gate(df: DataFrame, *methods: str) -> DataFrame:
    bad = ~F.coalesce(F.col("method").isin(*methods), F.lit(False))
    return with_error(df, F.when(bad, F.lit("method not allowed")))


def size_gate(df: DataFrame, max_kb: int = 200) -> DataFrame:
    """Reject form posts above `max_kb` * 1000 bytes; other payloads have no limit."""
    large = F.octet_length("body") > max_kb * 1000
    form = http.has_content_type(F.col("content_type"), http.FORM)
    return with_error(df, F.when(form & F.coalesce(large, F.lit(False)), F.lit("form too large")))


def parse_parameters(df: DataFrame) -> DataFrame:
    """Add `parameters`: decoded (name, value) pairs of the query, then of a form body."""
    form = F.col("method").isin("POST", "PUT") & http.has_content_type(F.col("content_type"), http.FORM)
    body = F.when(form, http.body_text(F.col("body")))
    pairs = http.split_pairs(F.concat_ws("&", http.url_query(F.col("url")), body))
    parsed = pinned(df, {"parameters": pairs})
    broken = F.exists("parameters", lambda p: p["name"].isNull() | p["value"].isNull())
    return with_error(parsed, F.when(broken, F.lit("bad parameter encoding")))


def inject_tuple(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Form posts to tuples: each attribute takes the first parameter of its name.

    Missing and empty parameters leave the default, unknown ones are ignored.
    A rejected attribute is null.
    """
    parsed = parse_parameters(size_gate(method_gate(df, "GET", "HEAD", "POST")))
    kinds = {field.name: attribute_type(field) for field in schema.fields}
    texts = {f"__{name}": http.first_value(F.col("parameters"), name) for name in kinds}
    raw = pinned(parsed, texts)
    # null = rejected text; typed once, then tested
    typed = pinned(raw, {name: coerce_or_default(F.col(f"__{name}"), kind) for name, kind in kinds.items()})
    bad = [F.when(F.col(name).isNull(), F.lit(f"bad value for {name}")) for name in kinds]
    return with_error(typed, F.coalesce(*bad)).drop(*texts)


def _others(schema: T.StructType, *taken: str) -> dict[str, Column]:
    return {f.name: default(attribute_type(f)) for f in schema.fields if f.name not in taken}


def inject_json(df: DataFrame, schema: T.StructType, validate: bool = False) -> DataFrame:
    """JSON posts to tuples: the text goes to `jsonString`, else to the first attribute.

    The text is passed on unread; `validate` rejects text that is no JSON.
    """
    target = check_inject(schema, "json")
    gated = content_type_gate(method_gate(df, "POST"), "json")
    if validate:
        text = http.body_text(F.col("body"))
        gated = with_error(gated, F.when(F.try_parse_json(text).isNull(), F.lit("not a JSON document")))
    return gated.withColumns({target: http.body_text(F.col("body")), **_others(schema, target)})


def inject_xml(df: DataFrame, schema: T.StructType) -> DataFrame:
    """XML posts to tuples; an empty body is accepted, a malformed one rejected."""
    target = check_inject(schema, "xml")
    gated = content_type_gate(method_gate(df, "POST"), "xml").withColumn(target, http.body_text(F.col("body")))
    parsed = F.from_xml(F.col(target), "_corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    malformed = (F.col(target) != "") & parsed["_corrupt_record"].isNotNull()
    return with_error(gated, F.when(malformed, F.lit("malformed XML"))).withColumns(_others(schema, target))


def inject_blob(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Binary posts to tuples; a second attribute of map type takes the headers."""
    target = check_inject(schema, "blob")
    gated = content_type_gate(method_gate(df, "POST"), "blob")
    values = {target: F.coalesce(F.col("body"), F.lit(b"")), **_others(schema, target)}
    if len(schema.fields) > 1 and attribute_type(schema.fields[1]) == "map<rstring,rstring>":
        values[schema.fields[1].name] = F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>"))
    return gated.withColumns(values)


def header_map(df: DataFrame, pairs: Column, name: str = "headers") -> DataFrame:
    """Add one value per header from a list of (name, value) pairs.

    The first value of a name counts; names ignore case and keep their first spelling.
    """
    listed = pinned(df.withColumn("__pairs", pairs), {"__names": F.col("__pairs.name"), "__values": F.col("__pairs.value")})
    listed = pinned(listed, {"__lower": F.transform("__names", F.lower)})
    places = pinned(
        listed,
        {"__at": F.transform(F.array_distinct("__lower"), lambda n: (F.array_position("__lower", n) - 1).cast("int"))},
    )
    headers = F.map_from_arrays(
        F.transform("__at", lambda i: F.get("__names", i)), F.transform("__at", lambda i: F.get("__values", i))
    )
    return places.withColumn(name, headers).drop("__pairs", "__names", "__values", "__lower", "__at")


def split_ports(df: DataFrame, ports: int) -> dict[int, DataFrame]:
    """One frame per output port of a routed frame; all other rows are `no_port`."""
    return {number: df.where(F.col("port") == number) for number in range(ports)}


def no_port(df: DataFrame, ports: int) -> DataFrame:
    """The rows of a routed frame for none of the ports, with an error."""
    other = ~F.coalesce(F.col("port").between(0, ports - 1), F.lit(False))
    return with_error(df.where(other), F.lit("no route"))


def accepted(df: DataFrame, schema: T.StructType, *carried: str) -> DataFrame:
    """The tuples of an inject step, without rejects."""
    return df.where("error is null").select(*carried, *schema.fieldNames())


def rejects(df: DataFrame, *carried: str) -> DataFrame:
    """The dead-letter rows of an inject step."""
    return df.where("error is not null").select(*carried, "error")


def outcomes(df: DataFrame, *carried: str) -> DataFrame:
    """Status a client would see: 204 accepted, else 404, 405 or 500 with the reason."""
    error = F.col("error")
    status = (
        F.when(error.isNull(), 204)
        .when(error == "no route", 404)
        .when(error == "method not allowed", 405)
        .otherwise(500)
    )
    return df.select(*carried, status.alias("status"), F.coalesce(error, F.lit("")).alias("reason"))
