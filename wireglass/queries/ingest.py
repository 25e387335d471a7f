"""Ingest queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglass.functions import http
from wireglass.functions.types import coerce, schema
from wireglass.operators import catalog, ingest
from wireglass.queries import derive
from wireglass.queries.registry import query, table


_PATH = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1)"


_ROUTE_SQL = "^(?:/([^/]+))?/([^/]+)/ports/(output|input|analyze)/([0-9]+)(/.*)?$"


def _group(number: int) -> str:
    return f"regexp_extract(path, '{_ROUTE_SQL}', {number})"


_ROUTED_SQL = (
    f"hit AS ({derive.HITS_SQL}), "
    "every AS (SELECT 'hit' AS source, request_id, method, url, content_type, body FROM hit UNION ALL "
    "SELECT 'page', page_id, 'GET', url, NULL, '' FROM pages), "
    f"paths AS (SELECT *, {_PATH} AS path FROM every), "
    f"parts AS (SELECT *, {_group(3)} AS side, {_group(5)} AS rest FROM paths), "
    "acts AS (SELECT *, CASE WHEN side = 'analyze' THEN 'analyze' "
    "WHEN side = 'output' AND rest IN ('/inject', '/form', '/info', '/wsinject') THEN rest[2:] "
    "WHEN side = 'input' AND rest IN ('/tuples', '/attribute', '/info', '/wssend') THEN rest[2:] ELSE '' END AS action "
    "FROM parts), "
    f"routed AS (SELECT source, request_id, method, action, CASE WHEN action = '' THEN '' ELSE {_group(1)} END AS context, "
    f"CASE WHEN action = '' THEN '' ELSE {_group(2)} END AS operator, "
    "CASE WHEN action = '' THEN '' WHEN side = 'analyze' THEN 'output' ELSE side END AS direction, "
    f"CASE WHEN action = '' THEN NULL ELSE TRY_CAST({_group(4)} AS int) END AS port, "
    "CASE WHEN action = '' THEN '' ELSE regexp_extract(path, '^((?:/[^/]+)?/[^/]+/ports)/', 1) END AS context_path, "
    "CASE WHEN side = 'analyze' THEN rest ELSE '' END AS path_info FROM acts)"
)


def _every(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["request_id", "method", "url", "content_type", "body"]
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("request_id"),
        F.lit("GET").alias("method"),
        "url",
        F.lit(None).cast("string").alias("content_type"),
        F.lit(b"").alias("body"),
        F.lit("page").alias("source"),
    )
    hit = derive.hits(spark, sf_dir).select(*columns, F.lit("hit").alias("source"))
    return ingest.route_requests(hit.unionByName(pages))


@query(
    f"WITH {_ROUTED_SQL} SELECT source, request_id, context, operator, direction, port, action, context_path, "
    "path_info, CASE WHEN action = '' THEN 'no route' ELSE '' END AS error FROM routed"
)
def route_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["source", "request_id", "context", "operator", "direction", "port", "action", "context_path", "path_info"]
    return _every(spark, sf_dir).select(*names, F.coalesce("error", F.lit("")).alias("error"))


@query(
    f"WITH {_ROUTED_SQL} SELECT context, operator, direction, port, action, count(*) AS hits FROM routed "
    "WHERE action <> '' GROUP BY ALL"
)
def port_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.port_usage(_every(spark, sf_dir))


_TYPES = (
    "CASE event_id % 6 WHEN 0 THEN 'application/json' WHEN 1 THEN 'application/json; charset=utf-8' "
    "WHEN 2 THEN 'Application/JSON' WHEN 3 THEN 'application/jsonx' WHEN 4 THEN 'application/json;x' ELSE NULL END"
)


@query(
    f"SELECT event_id, CASE WHEN coalesce({_TYPES} = 'application/json' OR starts_with({_TYPES}, 'application/json;'), "
    "false) THEN '' ELSE 'content type is not application/json' END AS error FROM events"
)
def content_type_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = table(spark, sf_dir, "events").selectExpr("event_id", f"{_TYPES} AS content_type")
    gated = ingest.content_type_gate(typed, "json")
    return gated.select("event_id", F.coalesce("error", F.lit("")).alias("error"))


# whole document texts as form posts, every 10th with a broken escape
_LANG_QUERY = "'/op/ports/output/0/inject?id=' || cast(doc_id AS string) || '&lang=' || lang || '&&empty&x=1=2'"


@query(
    "WITH f AS (SELECT doc_id, lang, text, source, doc_id % 10 = 0 AS bad FROM documents) "
    "SELECT doc_id, cast(CASE WHEN bad THEN 7 ELSE 6 END AS int) AS n, lang AS first_lang, '' AS empty, "
    "'1=2' AS x, md5(text) AS text_md5, CASE WHEN bad THEN 'bad parameter encoding' ELSE '' END AS error FROM f"
)
def parse_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    broken = F.when(F.col("doc_id") % 10 == 0, F.lit("&bad=%zz")).otherwise(F.lit(""))
    body = F.concat(F.lit("text="), F.url_encode("text"), F.lit("&lang=again"), broken)
    posts = documents.select(
        "doc_id",
        F.expr(_LANG_QUERY).alias("url"),
        F.lit("POST").alias("method"),
        F.lit(http.FORM).alias("content_type"),
        F.encode(body, "UTF-8").alias("body"),
    )
    parsed = ingest.parse_parameters(posts)
    pairs = F.col("parameters")
    return parsed.select(
        "doc_id",
        F.size(pairs).alias("n"),
        http.first_value(pairs, "lang").alias("first_lang"),
        http.first_value(pairs, "empty").alias("empty"),
        http.first_value(pairs, "x").alias("x"),
        F.md5(http.first_value(pairs, "text")).alias("text_md5"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


_TEXT = (
    "CASE event_id % 20 WHEN 0 THEN '+5' WHEN 1 THEN ' 12' WHEN 2 THEN '12 ' WHEN 3 THEN '1.5' WHEN 4 THEN 'abc' "
    "WHEN 5 THEN '300' WHEN 6 THEN '-1' WHEN 7 THEN '70000' WHEN 8 THEN 'true' WHEN 9 THEN 'TRUE' WHEN 10 THEN 'yes' "
    "WHEN 11 THEN '99999999999999999999' WHEN 12 THEN '1e3' WHEN 13 THEN 'inf' WHEN 14 THEN '-128' WHEN 15 THEN '007' "
    "WHEN 16 THEN '18446744073709551615' WHEN 17 THEN '4294967295' WHEN 18 THEN cast(value AS string) "
    "ELSE cast(event_id AS string) END"
)
_WHOLE = "regexp_matches(t, '^[+-]?[0-9]+$')"
_UNSIGNED_SQL = {"u8": 2**8 - 1, "u16": 2**16 - 1, "u32": 2**32 - 1, "u64": 2**64 - 1}


def _unsigned_sql(name: str, top: int) -> str:
    wide = f"CASE WHEN {_WHOLE} THEN TRY_CAST(t AS decimal(38,0)) END"
    return f"CASE WHEN {wide} BETWEEN 0 AND {top} THEN cast({wide} AS varchar) END AS {name}"


@query(
    f"WITH c AS (SELECT event_id, {_TEXT} AS t FROM events) SELECT event_id, "
    f"CASE WHEN {_WHOLE} THEN TRY_CAST(t AS tinyint) END AS i8, CASE WHEN {_WHOLE} THEN TRY_CAST(t AS smallint) END AS i16, "
    f"CASE WHEN {_WHOLE} THEN TRY_CAST(t AS int) END AS i32, CASE WHEN {_WHOLE} THEN TRY_CAST(t AS bigint) END AS i64, "
    + ", ".join(_unsigned_sql(name, top) for name, top in _UNSIGNED_SQL.items())
    + ", CASE WHEN regexp_matches(t, '^ *[+-]?[0-9.]+(e[0-9]+)? *$') THEN TRY_CAST(trim(t) AS double) END AS f64, "
    "lower(t) = 'true' AS b, t AS s FROM c"
)
def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "events").selectExpr("event_id", f"{_TEXT} AS t")
    t = F.col("t")
    unsigned = [coerce(t, f"uint{name[1:]}").cast("string").alias(name) for name in _UNSIGNED_SQL]
    signed = [coerce(t, f"int{bits}").alias(f"i{bits}") for bits in (8, 16, 32, 64)]
    return texts.select(
        "event_id",
        *signed,
        *unsigned,
        coerce(t, "float64").alias("f64"),
        coerce(t, "boolean").alias("b"),
        coerce(t, "rstring").alias("s"),
    )


FORM_SCHEMA = schema(
    [
        ("event_id", "int64"),
        ("user_id", "int32"),
        ("event_type", "rstring"),
        ("value", "float64"),
        ("flag", "boolean"),
        ("note", "rstring"),
        ("small", "uint8"),
    ]
)

# form fields of a request of the fixture: present only when the body is a form that is posted
_FORM_SQL = (
    f"req AS ({derive.REQ_SQL}), "
    "form AS (SELECT r.*, e.event_type AS et, e.value AS v, "
    "r.content_type LIKE 'application/x-www-form%' AND method IN ('POST', 'PUT') AS posted "
    "FROM req r JOIN events e ON e.event_id = r.request_id), "
    "checked AS (SELECT *, CASE WHEN method = 'PUT' THEN 'method not allowed' "
    "WHEN posted AND request_id % 7 <> 0 AND request_id % 11 = 0 THEN 'bad value for value' ELSE '' END AS error FROM form)"
)


def _injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.inject_tuple(ingest.route_requests(derive.requests(spark, sf_dir)), FORM_SCHEMA)


@query(
    f"WITH {_FORM_SQL} SELECT request_id AS event_id, cast(user_id AS int) AS user_id, "
    "CASE WHEN posted THEN et ELSE '' END AS event_type, "
    "CASE WHEN posted AND request_id % 7 <> 0 THEN v ELSE 0.0 END AS value, "
    "posted AND request_id % 13 = 0 AS flag, '' AS note, cast(0 AS smallint) AS small FROM checked WHERE error = ''"
)
def inject_tuple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.accepted(_injected(spark, sf_dir), FORM_SCHEMA)


@query(f"WITH {_FORM_SQL} SELECT request_id, ts, error FROM checked WHERE error <> ''")
def inject_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.rejects(_injected(spark, sf_dir), "request_id", "ts")


@query(
    f"WITH {_ROUTED_SQL} SELECT source, request_id, cast(CASE WHEN action = '' THEN 404 WHEN method = 'PUT' THEN 405 "
    "ELSE 204 END AS int) AS status, CASE WHEN action = '' THEN 'no route' WHEN method = 'PUT' THEN 'method not allowed' "
    "ELSE '' END AS reason FROM routed"
)
def inject_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = schema([("a", "int64"), ("t", "rstring")])
    return ingest.outcomes(ingest.inject_tuple(_every(spark, sf_dir), small), "source", "request_id")


_POSTED = f"req AS ({derive.REQ_SQL})"


@query(
    f"WITH {_POSTED} SELECT request_id, cast(0 AS int) AS a, body AS jsonString FROM req "
    "WHERE content_type = 'application/json' AND method = 'POST'"
)
def inject_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    port = schema([("a", "int32"), ("jsonString", "rstring")])
    return ingest.accepted(ingest.inject_json(derive.requests(spark, sf_dir), port), port, "request_id")


_XML_ERROR = (
    "CASE WHEN method <> 'POST' THEN 'method not allowed' WHEN content_type NOT LIKE 'application/xml%' "
    "THEN 'content type is not application/xml' WHEN request_id % 9 = 0 THEN 'malformed XML' ELSE '' END"
)


@query(f"WITH {_POSTED} SELECT request_id, {_XML_ERROR} AS error, body AS data FROM req")
def inject_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    port = schema([("data", "xml")])
    posted = ingest.inject_xml(derive.requests(spark, sf_dir), port)
    return posted.select("request_id", F.coalesce("error", F.lit("")).alias("error"), "data")


@query(
    f"WITH {_POSTED} SELECT request_id, md5(body) AS data_md5, octet_length(encode(body)) AS bytes, "
    "'Content-Type=' || content_type || '|X-User=' || user_id AS headers FROM req "
    "WHERE content_type = 'application/octet-stream' AND method = 'POST'"
)
def inject_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    port = schema([("data", "blob"), ("headers", "map<rstring,rstring>")])
    posted = ingest.accepted(ingest.inject_blob(derive.requests(spark, sf_dir), port), port, "request_id")
    return posted.select(
        "request_id",
        F.md5("data").alias("data_md5"),
        F.octet_length("data").cast("bigint").alias("bytes"),
        http.map_text(F.col("headers")).alias("headers"),
    )


@query(
    "SELECT event_id, 'Accept=' || event_type || CASE WHEN event_id % 3 = 0 THEN '|Cookie=c' || event_id ELSE '' END "
    "|| '|X-User=' || user_id AS headers FROM events"
)
def header_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pair(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    listed = F.array(
        pair("Accept", F.col("event_type")),
        pair("X-User", F.col("user_id")),
        pair("accept", F.lit("second")),
        pair("Cookie", F.concat(F.lit("c"), "event_id")),
        pair("X-User", F.lit(-1)),
    )
    kept = F.filter(listed, lambda p: (p["name"] != "Cookie") | (F.col("event_id") % 3 == 0))
    with_headers = ingest.header_map(table(spark, sf_dir, "events"), kept)
    return with_headers.select("event_id", http.map_text(F.col("headers")).alias("headers"))


_DOC_TYPE = (
    "CASE doc_id % 3 WHEN 0 THEN 'application/x-www-form-urlencoded' "
    "WHEN 1 THEN 'application/x-www-form-urlencoded; charset=utf-8' ELSE 'application/json' END"
)


@query(
    "SELECT doc_id, octet_length(encode('text=' || text)) AS bytes, CASE WHEN doc_id % 3 < 2 AND "
    "octet_length(encode('text=' || text)) > 5000 THEN 'form too large' ELSE '' END AS error FROM documents"
)
def size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(_DOC_TYPE).alias("content_type"), F.encode(F.concat(F.lit("text="), "text"), "UTF-8").alias("body")
    )
    gated = ingest.size_gate(posts, max_kb=5)
    return gated.select(
        "doc_id", F.octet_length("body").cast("bigint").alias("bytes"), F.coalesce("error", F.lit("")).alias("error")
    )


@query(
    f"WITH {_FORM_SQL} SELECT cast(request_id % 2 AS int) AS port, request_id, "
    "CASE WHEN request_id % 2 = 0 THEN request_id ELSE user_id END AS number FROM checked WHERE method <> 'PUT'"
)
def split_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ingest.route_requests(derive.requests(spark, sf_dir))
    schemas = {0: schema([("event_id", "int64")]), 1: schema([("user_id", "int64"), ("x", "rstring")])}
    rows = []
    for number, frame in ingest.split_ports(routed, len(schemas)).items():
        port = schemas[number]
        tuples = ingest.accepted(ingest.inject_tuple(frame, port), port, "request_id")
        first = F.col(port.fieldNames()[0]).alias("number")
        rows.append(tuples.select(F.lit(number).alias("port"), "request_id", first))
    return rows[0].unionByName(rows[1])


@query(f"WITH {_FORM_SQL} SELECT request_id, 'no route' AS error FROM checked WHERE request_id % 2 <> 0")
def split_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for a port that an operator with one port does not have."""
    routed = ingest.route_requests(derive.requests(spark, sf_dir))
    return ingest.no_port(routed, 1).select("request_id", "error")
