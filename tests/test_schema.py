"""Schemas compiled to expressions: each rule, at any depth, as a row with its path."""

import json

import pytest

from lexquarry.operators import schema

SPAN = {"type": "object", "required": ["start", "end"], "properties": {"start": {"type": "integer", "minimum": 0}, "end": {"type": "integer"}}, "additionalProperties": False}
PAGE = {
    "$defs": {"span": SPAN}, "type": "object", "required": ["ref", "links"], "additionalProperties": False,
    "properties": {
        "ref": {"type": "string", "pattern": "^[A-Z]+/Part[0-9]+", "minLength": 5}, "kind": {"enum": ["intro", "body", None, 3]}, "stamp": {"type": ["string", "null"], "format": "date-time"}, "day": {"format": "date"},
        "links": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"$ref": "#/$defs/span"}}, "grid": {"type": "array", "items": {"type": "array", "items": {"type": "number"}}}, "it's": {"const": True},
    },
}


def found(spark, *documents, rules=PAGE):
    rows = spark.createDataFrame([(i, x if x is None or isinstance(x, str) else json.dumps(x)) for i, x in enumerate(documents)], "k int, t string")
    return sorted(tuple(r) for r in schema.violations(rows, "k", "t", rules).collect())


def test_a_right_document_has_no_row(spark):
    good = {"ref": "G/Part1", "kind": None, "stamp": "2026-01-02T03:04:05+10:00", "day": "2024-02-29", "links": [{"start": 0, "end": 3}], "grid": [[1, 2.5], []], "it's": True}
    assert found(spark, good, good | {"stamp": None, "kind": 3}, {"ref": "G/Part1", "links": [{"start": 1, "end": 1}]}) == []


def test_each_rule_with_its_path(spark):
    base = {"ref": "G/Part1", "links": [{"start": 0, "end": 3}]}
    documents = [
        {}, base | {"ref": 7}, base | {"ref": "g"}, base | {"kind": "other", "more": 1}, base | {"stamp": "2026-01-02T03:04:05"}, base | {"stamp": "2026-13-02T03:04:05Z", "day": "2023-02-29"}, base | {"links": []},
        base | {"links": [{"start": -1, "end": 3}, {"start": 1.5}, {"start": -1, "end": 3}, 4]}, base | {"grid": [[1], [2, "x"], 3]}, base | {"it's": False}, [], None, "{no", "", '"text"', base | {"links": {"0": 1}},
    ]
    assert found(spark, *documents) == sorted([
        (0, "/ref", "required"), (0, "/links", "required"), (1, "/ref", "type string"), (2, "/ref", "pattern ^[A-Z]+/Part[0-9]+"), (2, "/ref", "minLength 5"), (3, "/kind", "enum"), (3, "/more", "additionalProperties"),
        (4, "/stamp", "format date-time"), (5, "/stamp", "format date-time"), (5, "/day", "format date"), (6, "/links", "minItems 1"), (7, "/links/0/start", "minimum 0"), (7, "/links/2/start", "minimum 0"), (7, "/links", "uniqueItems"),
        (7, "/links/1/start", "type integer"), (7, "/links/1/end", "required"), (7, "/links/3", "type object"), (8, "/grid/1/1", "type number"), (8, "/grid/2", "type array"), (9, "/it's", "const"),
        (10, "", "type object"), (11, "", "json"), (12, "", "json"), (13, "", "json"), (14, "", "type object"), (15, "/links", "type array")])


def test_what_is_not_known_raises(spark):
    for rules in ({"oneOf": []}, {"$ref": "#/$defs/none"}, {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}, {"format": "email"}, {"additionalProperties": {"type": "string"}}):
        with pytest.raises(schema.SchemaError):
            schema.compiled(rules, "d")
    assert found(spark, {"x": 1}, rules={}) == []
