"""JSON schemas as column expressions: every broken rule of every document as a row.

A schema is compiled once into one expression over a parsed document (`VARIANT`), so checking is one pass without
a shuffle, however many rules there are.  Types are those of the JSON text: ``"5"`` is no number, ``5.0`` is a
whole one.  A value of the wrong type breaks that rule alone; what it should hold is not checked.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROOT = "(root)"
NOTES = {"$schema", "$id", "title", "description", "default", "examples", "$comment"}
KNOWN = NOTES | {"type", "enum", "pattern", "minimum", "maximum", "required", "properties", "additionalProperties", "items"}
_NONE = "array<struct<field:string,rule:string>>"

# What `schema_of_variant` calls each JSON type.
_TYPES = {"string": "STRING", "boolean": "BOOLEAN", "object": r"OBJECT<.*", "array": r"ARRAY<.*", "null": "VOID", "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL\(.*"}


def _is_type(value: Column, name: str) -> Column:
    if name == "integer":
        n = F.try_variant_get(value, "$", "decimal(38,9)")
        return _is_type(value, "number") & (n.isNull() | (n == F.floor(n)))  # numbers beyond 38 digits are whole
    if name not in _TYPES:
        raise ValueError(f"unknown type {name!r}")
    return F.schema_of_variant(value).rlike(f"(?s)^({_TYPES[name]})$")


def _at(path: Column, key: Column) -> Column:
    return F.when(path == ROOT, key).otherwise(F.concat(path, F.lit("."), key))


def _broken(condition: Column, field: Column, rule: str) -> Column:
    row = F.struct(field.alias("field"), F.lit(rule).alias("rule"))
    return F.when(condition, F.array(row)).otherwise(F.array().cast(_NONE))


def _child(value: Column, key: str) -> Column:
    if "'" in key:
        raise ValueError(f"no quotes in keys: {key!r}")
    return F.try_variant_get(value, f"$['{key}']", "variant")


def compiled(schema: Mapping, value: Column, path: Column | None = None, wrong_type: str = "type") -> Column:
    """Broken rules of a parsed value as an array of ``field, rule``; none for a value that is not there."""
    path = F.lit(ROOT) if path is None else path
    if unknown := set(schema) - KNOWN:
        raise ValueError(f"rules that are not known: {', '.join(sorted(unknown))}")
    if schema.get("additionalProperties") not in (None, True, False):
        raise ValueError("additionalProperties is True or False")
    found, names = [], schema.get("type")
    right = F.lit(True)
    if names is not None:
        names = [names] if isinstance(names, str) else list(names)
        right = F.lit(False)
        for n in names:
            right |= _is_type(value, n)
    if "enum" in schema:
        same = F.to_json(value).isin(*[json.dumps(c, ensure_ascii=False) for c in schema["enum"]])
        found.append(_broken(~same, path, "choice"))
    if "pattern" in schema:
        found.append(_broken(_is_type(value, "string") & ~F.try_variant_get(value, "$", "string").rlike(schema["pattern"]), path, "pattern"))
    limits = [(F.try_variant_get(value, "$", "double") < schema["minimum"]) if "minimum" in schema else None,
              (F.try_variant_get(value, "$", "double") > schema["maximum"]) if "maximum" in schema else None]
    for outside in (x for x in limits if x is not None):
        found.append(_broken(_is_type(value, "number") & outside, path, "range"))
    for key in schema.get("required", ()):
        found.append(_broken(_is_type(value, "object") & _child(value, key).isNull(), _at(path, F.lit(key)), "required"))
    properties = schema.get("properties", {})
    if schema.get("additionalProperties") is False:
        keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
        extra = F.array_except(keys, F.array(*[F.lit(k) for k in properties]).cast("array<string>"))
        found.append(F.coalesce(F.transform(extra, lambda k: F.struct(_at(path, k).alias("field"), F.lit("unknown").alias("rule"))), F.array().cast(_NONE)))
    for key, inner in properties.items():
        found.append(compiled(inner, _child(value, key), _at(path, F.lit(key))))
    if "items" in schema:
        def one(x: Column, i: Column) -> Column:
            return compiled(schema["items"], x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))

        found.append(F.coalesce(F.flatten(F.transform(F.try_variant_get(value, "$", "array<variant>"), one)), F.array().cast(_NONE)))
    inside = F.concat(*found) if found else F.array().cast(_NONE)
    checked = F.when(right, inside).otherwise(_broken(F.lit(True), path, wrong_type)) if names is not None else inside
    return F.when(value.isNull(), F.array().cast(_NONE)).otherwise(checked)


def violations(df: DataFrame, keys: str | list[str], text: str, schema: Mapping) -> DataFrame:
    """``keys, field, rule`` for every rule a JSON text breaks; a missing or unreadable text is ``(root), not_an_object``.

    Items of arrays are named by their place, as in ``columns[2].name``.
    """
    keys = [keys] if isinstance(keys, str) else keys
    parsed = df.select(*keys, F.try_parse_json(F.col(text)).alias("__doc"))
    found = F.when(F.col("__doc").isNull(), _broken(F.lit(True), F.lit(ROOT), "not_an_object")).otherwise(compiled(schema, F.col("__doc"), wrong_type="not_an_object"))
    return parsed.select(*keys, F.explode(found).alias("__broken")).select(*keys, "__broken.*")
