import json
import re

import pytest
from conftest import plan, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from terrasse.functions import schemas as S
from terrasse.operators import json_rules as J


def is_type(value, name):
    number = isinstance(value, int | float) and not isinstance(value, bool)
    return {"string": isinstance(value, str), "boolean": isinstance(value, bool), "object": isinstance(value, dict), "array": isinstance(value, list), "null": value is None,
            "number": number, "integer": number and float(value).is_integer()}[name]


def brute(schema, value, path=J.ROOT, wrong="type"):
    """The same rules over parsed Python values."""
    at = lambda k: k if path == J.ROOT else f"{path}.{k}"
    names = schema.get("type")
    if names is not None and not any(is_type(value, n) for n in ([names] if isinstance(names, str) else names)):
        return [(path, wrong)]
    out = []
    if "enum" in schema and not any(type(value) is type(c) and value == c for c in schema["enum"]):
        out.append((path, "choice"))
    if "pattern" in schema and isinstance(value, str) and not re.search(schema["pattern"], value):
        out.append((path, "pattern"))
    if is_type(value, "number"):
        out += [(path, "range")] * (("minimum" in schema and value < schema["minimum"]) + ("maximum" in schema and value > schema["maximum"]))
    if isinstance(value, dict):
        out += [(at(k), "required") for k in schema.get("required", ()) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [(at(k), "unknown") for k in value if k not in schema.get("properties", {})]
        for k, inner in schema.get("properties", {}).items():
            if k in value:
                out += brute(inner, value[k], at(k))
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += brute(schema["items"], x, f"{path}[{i}]")
    return out


def check(spark, schema, docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, doc string")
    got = rows(J.violations(df, "id", "doc", schema))
    want = [(i, *v) for i, d in enumerate(docs) for v in brute(schema, d, wrong="not_an_object")]
    assert got == sorted(want, key=lambda r: tuple((True, str(v)) for v in r))
    return got


leaf = st.sampled_from([None, True, 0, 1, -1, 2.5, 3.0, 1e10, "", "low", "a.b", "1.2.3", "delta", "FULL", "x'y", "é"])
keys = st.sampled_from(["id", "name", "type", "column", "sources", "days", "strategy", "slo", "schema", "column_lineage", "contract", "retention", "tags", "other", "quality_sla", "max_null_rate", "freshness_hours"])
value = st.recursive(leaf, lambda x: st.lists(x, max_size=3) | st.dictionaries(keys, x, max_size=4), max_leaves=12)


@settings(max_examples=4, deadline=None)
@given(docs=st.lists(st.dictionaries(keys, value, max_size=6), min_size=60, max_size=60))
def test_random_documents_equal_a_plain_walk(spark, docs):
    check(spark, S.MANIFEST_SCHEMA, docs)


def test_every_kind_of_rule(spark):
    schema = {"type": "object", "properties": {
        "a": {"type": ["string", "null"], "enum": ["x", None, "y"]}, "b": {"enum": [1, "1", True]}, "c": {"minimum": 2, "maximum": 3}, "d": {"type": "integer"},
        "e": {"type": "array", "items": {"type": "array", "items": {"type": "boolean"}}}, "f": {"pattern": "^a+$"}}, "additionalProperties": True}
    docs = [{}, {"a": None}, {"a": "z"}, {"a": 1}, {"b": 1}, {"b": "1"}, {"b": True}, {"b": 2}, {"c": 1}, {"c": 2.5}, {"c": 4}, {"c": "5"}, {"d": 5.0}, {"d": 5.5}, {"d": 10**25}, {"d": "5"},
            {"e": [[True], [False, 1], "x"]}, {"e": []}, {"e": {}}, {"f": "aaa"}, {"f": "b"}, {"f": 1}, {"other": 1}, [], 5, None, "text"]
    got = check(spark, schema, docs)
    assert {r[2] for r in got} == {"choice", "type", "range", "pattern", "not_an_object"}


def test_texts_that_are_no_documents(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "{"), (4, '{"id": 1, "id": 2}'), (5, "null")], "id int, doc string")
    assert rows(J.violations(df, "id", "doc", {"type": "object"})) == [(i, "(root)", "not_an_object") for i in range(1, 6)]
    assert J.violations(df.limit(0), "id", "doc", S.MANIFEST_SCHEMA).count() == 0


def test_unknown_rules_are_refused(spark):
    df = spark.createDataFrame([(1, "{}")], "id int, doc string")
    for schema in ({"minLength": 3}, {"type": "date"}, {"additionalProperties": {"type": "string"}}, {"properties": {"a": {"oneOf": []}}}):
        with pytest.raises(ValueError):
            J.violations(df, "id", "doc", schema)


def test_one_pass_without_shuffle(spark):
    df = spark.createDataFrame([(1, "{}")], "id int, doc string")
    text = plan(J.violations(df, ["id"], "doc", S.MANIFEST_SCHEMA))
    assert "Exchange" not in text and "Python" not in text and text.count("try_parse_json") + text.count("parse_json(") <= 3
