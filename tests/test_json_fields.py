"""Keys of JSON documents."""

import json
from collections import Counter

import pytest

from colwarden.operators.json_fields import json_contract, json_fields

DOCS = [
    '{"k": 1, "s": "x"}', '{"k": "1", "S": null}', '{"k": 1.5, "o": {"k": 2}}', '{"k": 12345678901234567890123, "a": [1]}', '{"k": true, "": 0}', '{"a b.c": -3}', "{}",
    "[1, 2]", "7", '"text"', "null", None, "", "{", '{"k": 1, "k": 2}', '{"k": 1e3}', '{"k": 2.0}', '{"a": [], "é": "ü"}',
]


def state(doc):
    if doc is None:
        return "null", {}
    try:
        pairs = json.loads(doc, object_pairs_hook=lambda p: p)
    except ValueError:
        return "unreadable", {}
    if doc.lstrip()[:1] != "{":
        return "other document", {}
    return ("unreadable", {}) if len({k for k, _ in pairs}) < len(pairs) else ("object", json.loads(doc))


def kind(v):
    return {bool: "boolean", int: "integer", float: "number", str: "text", type(None): "null", dict: "object", list: "array"}[type(v)]


def test_brute_force(spark):
    want = Counter()
    for d in DOCS * 3:
        where, keys = state(d)
        want[None, where] += 1
        want.update((k, kind(v)) for k, v in keys.items())
    got = {(r.field, r.kind): r.n for r in json_fields(spark.createDataFrame([(d,) for d in DOCS * 3], "doc STRING"), "doc").collect()}
    # a whole number with a fraction of zero is stored without it
    want["k", "number"] -= 3
    want["k", "integer"] += 3
    assert got == {k: n for k, n in want.items() if n}


def test_contract(spark):
    found = json_fields(spark.createDataFrame([(d,) for d in DOCS], "`a doc` STRING"), "a doc")
    got = {r.field: tuple(r)[1:] for r in json_contract(found, {"k": "integer", "none": "text", "a": "array"}).collect()}
    objects = sum(state(d)[0] == "object" for d in DOCS)
    assert got["none"] == ("text", 0, 0, objects) and got["a"] == ("array", 2, 0, objects - 2)
    assert sum(got["k"][1:]) == objects and got["k"][1] >= 2
    assert json_contract(found, {}).count() == 0
    with pytest.raises(ValueError, match="unknown kinds"):
        json_contract(found, {"k": "int"})


def test_empty(spark):
    found = json_fields(spark.createDataFrame([], "doc STRING"), "doc")
    assert found.count() == 0
    assert [tuple(r) for r in json_contract(found, {"k": "text"}).collect()] == [("k", "text", 0, 0, 0)]
