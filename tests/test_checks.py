"""Parameter checks and their codes."""

import pytest

from wireglass.functions.types import schema
from wireglass.plans import checks
from wireglass.plans.checks import CheckError, ViewPort

VIEW = schema(
    [("a_string", "rstring"), ("b_string", "ustring"), ("c_int32", "int32"), ("d_float", "float64"), ("e_boolean", "boolean")]
)
VIEW_B = schema(
    [("a_string", "rstring"), ("b_string", "ustring"), ("c_int", "int32"), ("d_float", "float64"), ("e_boolean", "boolean")]
)
PLAIN, PARTED = ViewPort(VIEW), ViewPort(VIEW, True)
OTHER, OTHER_PARTED = ViewPort(VIEW_B), ViewPort(VIEW_B, True)


@pytest.mark.parametrize(
    ("ports", "key", "by", "code", "part"),
    [
        ([PLAIN], ["a_string"], None, 3859, "'partitionKey'"),
        ([PLAIN], None, ["b_string"], 3859, "'partitionBy'"),
        ([PARTED], None, None, 3864, "not specified"),
        ([PARTED], None, ["b_string", "b_string"], 3860, "(2) must be equal the number of input ports (1)"),
        ([PARTED], ["a_string,b_string,a_string"], None, 3861, "'a_string' is duplicate for input port 0"),
        ([PARTED], ["a_string", "b_string", "a_string"], None, 3861, "'a_string'"),
        ([PARTED], None, ["a_string,b_string,a_string"], 3861, "'a_string'"),
        ([PARTED, OTHER], ["a_string,b_string"], None, 3863, "Input port 1"),
        ([PARTED, OTHER], None, ["a_string,b_string", "a_string,b_string"], 3863, "Input port 1"),
        ([PARTED, OTHER_PARTED], ["a_string,c_int32"], None, 3862, "Input port 1 has no attribute with name 'c_int32'"),
        ([PARTED, OTHER_PARTED], ["a_string", "c_int32"], None, 3862, "Input port 1"),
        ([PARTED, OTHER_PARTED], None, ["a_string,c_int32", "a_string,c_int32"], 3862, "Input port 1"),
    ],
)
def test_view_parameters(ports, key, by, code, part):
    with pytest.raises(CheckError) as caught:
        checks.check_views(ports, key, by)
    assert caught.value.code == code
    assert part in str(caught.value)


def test_view_keys_per_port():
    assert checks.check_views([PARTED, OTHER], None, ["a_string,c_int32", ""]) == [["a_string", "c_int32"], []]
    assert checks.check_views([PARTED, OTHER_PARTED], ["a_string"]) == [["a_string"], ["a_string"]]
    assert checks.check_views([PLAIN], [""]) == [[]]
    with pytest.raises(CheckError):
        checks.check_views([PARTED], ["a_string"], ["a_string"])


RESPONSE_CASES = [
    ([("string", "rstring"), ("string2", "rstring")], {}, 3856, "'key' on input port 0"),
    ([("string", "rstring"), ("key", "rstring")], {}, 3857, "'INT64' is allowed for attribute 'key'"),
    ([("string", "rstring"), ("key", "int64")], {"keyAttributeName": "myKey"}, 3856, "'myKey'"),
]
for _name, _wrong, _right, _parameter, _code in [
    ("contentType", "int32", "rstring", "responseContentTypeAttributeName", 3858),
    ("response", "int32", "rstring", "responseAttributeName", 3858),
    ("status", "rstring", "int32", "responseStatusAttributeName", 3857),
    ("header", "rstring", "map<rstring,rstring>", "responseHeaderAttributeName", 3857),
]:
    _base = [("string", "rstring"), ("key", "int64")]
    RESPONSE_CASES.append(([*_base, (_name, _wrong)], {}, _code, f"attribute '{_name}'"))
    RESPONSE_CASES.append(([*_base, (_name, _right)], {_parameter: "mine"}, 3856, f"parameter '{_parameter}'"))


@pytest.mark.parametrize(("attributes", "given", "code", "part"), RESPONSE_CASES)
def test_response_port(attributes, given, code, part):
    with pytest.raises(CheckError) as caught:
        checks.check_response_port(schema(attributes), **given)
    assert caught.value.code == code
    assert part in str(caught.value)


REQUEST_CASES = [
    ([("string", "rstring"), ("any", "rstring")], {}, 3856, "'key' on output port 0"),
    ([("string", "rstring"), ("key", "rstring")], {}, 3857, "'key'"),
    ([("string", "rstring"), ("key", "int64")], {"keyAttributeName": "myKey"}, 3856, "'myKey' on output port 0"),
]
for _name, (_parameter, _kind) in checks.REQUEST_ATTRIBUTES.items():
    _wrong = "rstring" if _kind == "MAP" else "int32"
    _right = "map<rstring,rstring>" if _kind == "MAP" else "rstring"
    _base = [("string", "rstring"), ("key", "int64")]
    REQUEST_CASES.append(([*_base, (_name, _wrong)], {}, 3857 if _kind == "MAP" else 3858, f"attribute '{_name}'"))
    REQUEST_CASES.append(([*_base, (_name, _right)], {_parameter: "mine"}, 3856, f"parameter '{_parameter}'"))


@pytest.mark.parametrize(("attributes", "given", "code", "part"), REQUEST_CASES)
def test_request_port(attributes, given, code, part):
    with pytest.raises(CheckError) as caught:
        checks.check_request_port(schema(attributes), **given)
    assert caught.value.code == code
    assert part in str(caught.value)


def test_request_port_count():
    assert len(RESPONSE_CASES) == 11
    assert len(REQUEST_CASES) == 17


@pytest.mark.parametrize(
    ("check", "attributes", "given"),
    [
        (checks.check_response_port, [("string", "rstring")], {}),
        (checks.check_request_port, [("string", "rstring")], {}),
        (checks.check_response_port, [("jsonString", "rstring")], {"responseJsonAttributeName": "myJsonString"}),
        (checks.check_request_port, [("jsonString", "rstring")], {"jsonAttributeName": "myJsonString"}),
    ],
)
def test_json_port(check, attributes, given):
    with pytest.raises(CheckError) as caught:
        check(schema(attributes), **given)
    assert caught.value.code == 3856


def test_json_mode_detection():
    one = schema([("jsonString", "rstring")])
    two = schema([("jsonString", "rstring"), ("key", "int64")])
    assert checks.is_json_port(one)
    assert not checks.is_json_port(two)
    assert checks.check_request_port(one) is None
    assert checks.check_response_port(two) == {"key": "key"}


@pytest.mark.parametrize(
    ("attributes", "message", "sender", "code"),
    [
        ([("message", "int32")], None, None, 3866),
        ([("messageAttribute", "rstring")], "myMessageAttribute", None, 3856),
        ([("messageAttribute", "int64")], "messageAttribute", None, 3866),
        ([("messageAttribute", "rstring")], "messageAttribute", "mySenderIdAttribute", 3856),
        ([("messageAttribute", "rstring"), ("s", "int64")], "messageAttribute", "s", 3858),
        ([("a", "rstring"), ("b", "rstring")], None, None, 3865),
    ],
)
def test_message_port(attributes, message, sender, code):
    with pytest.raises(CheckError) as caught:
        checks.check_message_port(schema(attributes), message, sender)
    assert caught.value.code == code


def test_message_port_sender_may_be_any_string():
    port = checks.check_message_port(schema([("m", "blob"), ("s", "ustring")]), "m", "s")
    assert port.binary and port.sender == "s"


@pytest.mark.parametrize(("kind", "binary", "code"), [("blob", "mine", 3856), ("rstring", "data", 3853)])
def test_send_port(kind, binary, code):
    with pytest.raises(CheckError) as caught:
        checks.check_send_port(schema([("data", kind)]), binary=binary)
    assert caught.value.code == code


def test_send_port_modes():
    port = schema([("text", "rstring"), ("data", "blob")])
    assert checks.check_send_port(port) == "tuple"
    assert checks.check_send_port(port, text="text") == "text"
    assert checks.check_send_port(port, binary="data") == "binary"
    with pytest.raises(CheckError):
        checks.check_send_port(port, "text", "data")


def test_inject_ports():
    assert checks.check_inject(schema([("jsonString", "rstring")]), "json") == "jsonString"
    assert checks.check_inject(schema([("a", "int32"), ("jsonString", "rstring")]), "json") == "jsonString"
    assert checks.check_inject(schema([("a", "rstring"), ("b", "int32")]), "json") == "a"
    assert checks.check_inject(schema([("data", "xml"), ("x", "rstring")]), "xml") == "data"
    assert checks.check_inject(schema([("data", "blob"), ("x", "rstring")]), "blob") == "data"
    for payload in ("json", "xml", "blob"):
        with pytest.raises(CheckError):
            checks.check_inject(schema([("a", "int32")]), payload)


def test_latest_needs_xml_and_context_is_not_empty():
    assert checks.check_latest(schema([("a", "rstring"), ("v", "xml"), ("w", "xml")])) == "v"
    with pytest.raises(CheckError) as caught:
        checks.check_latest(schema([("a", "rstring")]))
    assert caught.value.code == 3852
    with pytest.raises(CheckError) as caught:
        checks.check_context("")
    assert caught.value.code == 3855
