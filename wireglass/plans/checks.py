"""Start-up checks of ports and parameters, with stable message codes.

All of these look at schemas on the driver before a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

from wireglass.functions.types import STRINGS, attribute_type

# Message codes and texts.
MESSAGES = {
    3852: "Input port '{0}' requires an XML-attribute.",
    3853: "Only type '{0}' is allowed for attribute '{1}'.",
    3855: "Parameter '{0}' must not be empty.",
    3856: "Could not detect required attribute '{0}' on {1} port 0. Or specify a valid value for parameter '{2}'.",
    3857: "Only type '{0}' is allowed for attribute '{1}'.",
    3858: "Only types '{0}' and '{1}' is allowed for attribute '{2}'.",
    3859: "No Input port window is partitioned, but parameter '{0}' has a non empty value.",
    3860: "The cardinality of parameter partitionBy ({0}) must be equal the number of input ports ({1}) !",
    3861: "Partition name: '{0}' is duplicate for input port {1}.",
    3862: "Input port {0} has no attribute with name '{1}'.",
    3863: "Input port {0} is not partitioned but has none empty partition with name '{1}'.",
    3864: "Window is partitioned but partition attribute names are not specified.",
    3865: "Parameter messageAttributeName is required if output port has more than one attribute.",
    3866: "Port Attribute {0} must be of type {1}, {2} or {3}.",
}


class CheckError(ValueError):
    """A failed check; `code` is the message number, None for parameter conflicts."""

    def __init__(self, code: int | None, *values: object):
        self.code = code
        text = MESSAGES[code].format(*values) if code else " ".join(map(str, values))
        super().__init__(f"{code}: {text}" if code else text)


def _kind(schema: T.StructType, name: str) -> str | None:
    return attribute_type(schema[name]) if name in schema.fieldNames() else None


# ---- inject ports -----------------------------------------------------------


def check_inject(schema: T.StructType, payload: str) -> str:
    """Attribute that takes the payload of a `json`, `xml` or `blob` inject port."""
    wanted = {"json": "rstring", "xml": "xml", "blob": "blob"}[payload]
    name = schema.fieldNames()[0]
    if payload == "json" and "jsonString" in schema.fieldNames():
        name = "jsonString"
    if _kind(schema, name) != wanted:
        raise CheckError(3857, wanted, name)
    return name


def check_latest(schema: T.StructType, port: str = "0") -> str:
    """First XML attribute of a latest-value view."""
    for field in schema.fields:
        if attribute_type(field) == "xml":
            return field.name
    raise CheckError(3852, port)


def check_context(context: str | None) -> None:
    if context == "":
        raise CheckError(3855, "context")


# ---- views ------------------------------------------------------------------


@dataclass(frozen=True)
class ViewPort:
    schema: T.StructType
    partitioned: bool = False


def check_views(
    ports: Sequence[ViewPort],
    partition_key: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
) -> list[list[str]]:
    """Partition keys of every view port.

    `partition_key` is one list for all ports (a single value may be a comma
    list), `partition_by` has one comma list per port.
    """
    if partition_key is not None and partition_by is not None:
        raise CheckError(None, "partitionKey and partitionBy exclude each other")
    shared: list[str] = []
    if partition_key is not None:
        parts = partition_key[0].split(",") if len(partition_key) == 1 else partition_key
        shared = [name for name in parts if name]
    if not any(port.partitioned for port in ports):
        if shared:
            raise CheckError(3859, "partitionKey")
        if any(partition_by or ()):
            raise CheckError(3859, "partitionBy")
        return [[] for _ in ports]
    if partition_by is not None and len(partition_by) != len(ports):
        raise CheckError(3860, len(partition_by), len(ports))
    keys = [list(shared) for _ in ports]
    if partition_by is not None:
        keys = [[name for name in names.split(",") if name] for names in partition_by]
    for number, names in enumerate(keys):
        for at, name in enumerate(names):
            if name in names[:at]:
                raise CheckError(3861, name, number)
    for number, (port, names) in enumerate(zip(ports, keys)):
        if not port.partitioned and names:
            raise CheckError(3863, number, names[0])
        for name in names:
            if name not in port.schema.fieldNames():
                raise CheckError(3862, number, name)
    for port, names in zip(ports, keys):
        if port.partitioned and not names:
            raise CheckError(3864)
    return keys


# ---- request and response ports ----------------------------------------------

# Default attribute names, their parameter and their type.
REQUEST_ATTRIBUTES = {
    "request": ("requestAttributeName", "string"),
    "header": ("headerAttributeName", "MAP"),
    "method": ("methodAttributeName", "string"),
    "pathInfo": ("pathInfoAttributeName", "string"),
    "contextPath": ("contextPathAttributeName", "string"),
    "url": ("urlAttributeName", "string"),
    "contentType": ("contentTypeAttributeName", "string"),
}
RESPONSE_ATTRIBUTES = {
    "response": ("responseAttributeName", "string"),
    "status": ("responseStatusAttributeName", "INT32"),
    "header": ("responseHeaderAttributeName", "MAP"),
    "contentType": ("responseContentTypeAttributeName", "string"),
}
JSON_ATTRIBUTE = "jsonString"


def is_json_port(schema: T.StructType, json_attribute: str = JSON_ATTRIBUTE) -> bool:
    """JSON mode: the JSON attribute is the only one."""
    return schema.fieldNames() == [json_attribute]


def _meets(kind: str, wanted: str) -> bool:
    if wanted == "string":
        return kind in ("rstring", "ustring")
    if wanted == "MAP":
        return kind.startswith("map<")
    return kind == wanted.lower()


def _resolve_port(
    schema: T.StructType, side: str, known: dict[str, tuple[str, str]], given: dict[str, str], json_name: str
) -> dict[str, str] | None:
    """Field -> attribute name for a tuple port, None for a JSON port."""
    if is_json_port(schema, json_name):
        return None
    key = given.get("keyAttributeName", "key")
    kind = _kind(schema, key)
    if kind is None:
        raise CheckError(3856, key, side, "keyAttributeName")
    if kind != "int64":
        raise CheckError(3857, "INT64", key)
    found = {"key": key}
    for field, (parameter, wanted) in known.items():
        name = given.get(parameter, field)
        kind = _kind(schema, name)
        if kind is None:
            if parameter in given:
                raise CheckError(3856, name, side, parameter)
            continue
        if not _meets(kind, wanted):
            if wanted == "string":
                raise CheckError(3858, "USTRING", "RSTRING", name)
            raise CheckError(3857, wanted, name)
        found[field] = name
    return found


def check_request_port(schema: T.StructType, **given: str) -> dict[str, str] | None:
    """Request side: which attribute takes which request field; None in JSON mode."""
    name = given.pop("jsonAttributeName", JSON_ATTRIBUTE)
    return _resolve_port(schema, "output", REQUEST_ATTRIBUTES, given, name)


def check_response_port(schema: T.StructType, **given: str) -> dict[str, str] | None:
    """Response side: which attribute holds which response field; None in JSON mode."""
    name = given.pop("responseJsonAttributeName", JSON_ATTRIBUTE)
    return _resolve_port(schema, "input", RESPONSE_ATTRIBUTES, given, name)


# ---- WebSocket ports ----------------------------------------------------------


@dataclass(frozen=True)
class MessagePort:
    message: str
    binary: bool
    sender: str | None = None


def check_message_port(schema: T.StructType, message: str | None = None, sender: str | None = None) -> MessagePort:
    """Message and sender attribute of a WebSocket inject port."""
    if message is None:
        if len(schema.fields) > 1:
            raise CheckError(3865)
        message = schema.fieldNames()[0]
    kind = _kind(schema, message)
    if kind is None:
        raise CheckError(3856, message, "output", "messageAttributeName")
    if kind not in ("rstring", "ustring", "blob"):
        raise CheckError(3866, message, "rstring", "ustring", "blob")
    if sender is not None:
        sender_kind = _kind(schema, sender)
        if sender_kind is None:
            raise CheckError(3856, sender, "output", "senderIdAttributeName")
        if sender_kind not in STRINGS:
            raise CheckError(3858, "rstring", "ustring", sender)
    return MessagePort(message, kind == "blob", sender)


def check_send_port(schema: T.StructType, text: str | None = None, binary: str | None = None) -> str:
    """Body of an outgoing message: `tuple`, `text` or `binary`."""
    if text is not None and binary is not None:
        raise CheckError(None, "textMessage and binaryMessageAttributeName exclude each other")
    if binary is not None:
        kind = _kind(schema, binary)
        if kind is None:
            raise CheckError(3856, binary, "input", "binaryMessageAttributeName")
        if kind != "blob":
            raise CheckError(3853, "BLOB", binary)
        return "binary"
    return "text" if text is not None else "tuple"
