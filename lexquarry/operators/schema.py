"""JSON Schema compiled to expressions: every broken rule of a document as a row with its path.

A schema becomes one expression over a parsed document (variant), so documents are checked in one pass over the table, in the engine,
without a library on the executors. Known are type, required, properties, additionalProperties (false), items, enum, const, pattern,
minLength, minItems, uniqueItems, minimum, format (date, date-time with a zone) and local ``$ref``; a keyword that isn't known raises, so
none is passed over. Texts that are no JSON are one row. A rule on a value of another type than it is made for doesn't apply.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = "array<struct<path:string,rule:string>>"
STAMP = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"
KNOWN = {"type", "required", "properties", "additionalProperties", "items", "enum", "const", "pattern", "minLength", "minItems", "uniqueItems", "minimum", "format", "$ref"}
NOTES = {"$schema", "$id", "$defs", "definitions", "title", "description", "$comment", "default", "examples"}


class SchemaError(ValueError):
    """A schema that can't be compiled: a keyword that isn't known, or a reference that leads nowhere or back to itself."""


def _text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kind(v: str) -> str:
    """SQL for the JSON type of a variant; a whole number is an integer."""
    kind = f"schema_of_variant({v})"
    return f"case when {kind} like 'OBJECT%' then 'object' when {kind} like 'ARRAY%' then 'array' when {kind} = 'STRING' then 'string' when {kind} = 'BOOLEAN' then 'boolean' when {kind} = 'VOID' then 'null' when {kind} = 'BIGINT' then 'integer' else 'number' end"


def _child(v: str, name: str) -> str:
    if "'" in name and '"' in name:
        raise SchemaError(f"both kinds of quotes in the name {name}")
    quote = '"' if "'" in name else "'"
    return f"variant_get({v}, {_text(f'$[{quote}{name}{quote}]')}, 'variant')"


def _each(values: str, x: str, i: str, rules: list[str]) -> str:
    """The broken rules of each of an array of variants: each is bound once with its type, as ``x.v`` and ``x.t``."""
    bound = f"transform({values}, {x}v -> named_struct('v', {x}v, 't', {_kind(x + 'v')}))"
    return f"flatten(transform({bound}, ({x}, {i}) -> concat({', '.join(rules)})))"


def _rules(schema: dict, x: str, path: str, root: dict, depth: int, above: tuple[str, ...]) -> list[str]:
    """SQL arrays of the broken rules of the value ``x.v`` of type ``x.t`` at ``path`` (SQL for text)."""
    if unknown := schema.keys() - KNOWN - NOTES:
        raise SchemaError(f"not known: {sorted(unknown)}")
    if "$ref" in schema:
        ref = schema["$ref"]
        if ref in above or not ref.startswith("#/"):
            raise SchemaError(f"{ref} leads back to itself or out of the schema")
        target = root
        for step in ref[2:].split("/"):
            if not isinstance(target, dict) or step not in target:
                raise SchemaError(f"{ref} leads nowhere")
            target = target[step]
        return _rules(target, x, path, root, depth, (*above, ref))
    v, kind, word = f"{x}.v", f"{x}.t", f"cast({x}.v as string)"
    out: list[str] = []

    def broken(when: str, rule: str, at: str = path) -> None:
        out.append(f"if({when}, array(named_struct('path', {at}, 'rule', {_text(rule)})), cast(array() as {ROWS}))")

    if "type" in schema:
        allowed = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        names = [*allowed, *(["integer"] if "number" in allowed else [])]
        broken(f"{kind} not in ({', '.join(map(_text, names))})", "type " + " or ".join(allowed))
    for rule in ("enum", "const"):
        if rule in schema:
            values = schema["enum"] if rule == "enum" else [schema["const"]]
            held = ", ".join(_text(json.dumps(x, ensure_ascii=False, separators=(",", ":"))) for x in values)
            broken(f"to_json({v}) not in ({held})", rule)
    if "pattern" in schema:
        broken(f"{kind} = 'string' and not regexp_like({word}, {_text(schema['pattern'])})", "pattern " + schema["pattern"])
    if "minLength" in schema:
        broken(f"{kind} = 'string' and length({word}) < {schema['minLength']}", f"minLength {schema['minLength']}")
    if "minimum" in schema:
        broken(f"{kind} in ('integer', 'number') and cast({v} as double) < {float(schema['minimum'])}D", f"minimum {schema['minimum']}")
    if "format" in schema:
        forms = {"date": f"{word} rlike '^\\\\d{{4}}-\\\\d\\\\d-\\\\d\\\\d$' and try_to_date({word}, 'yyyy-MM-dd') is not null", "date-time": f"{word} rlike {_text(STAMP)} and try_cast({word} as timestamp) is not null"}
        if schema["format"] not in forms:
            raise SchemaError(f"not known: format {schema['format']}")
        broken(f"{kind} = 'string' and not ({forms[schema['format']]})", f"format {schema['format']}")
    for name in schema.get("required", ()):
        broken(f"{kind} = 'object' and {_child(v, name)} is null", "required", f"concat({path}, {_text('/' + name)})")
    if schema.get("additionalProperties") is False:
        extra = f"array_except(json_object_keys(to_json({v})), array({', '.join(map(_text, schema.get('properties', {})))}))"
        out.append(f"if({kind} = 'object', transform({extra}, k{depth} -> named_struct('path', concat({path}, '/', k{depth}), 'rule', 'additionalProperties')), cast(array() as {ROWS}))")
    elif schema.get("additionalProperties") not in (None, True):
        raise SchemaError("not known: a schema of additionalProperties")
    for name, inner in schema.get("properties", {}).items():
        child, at = f"p{depth}", f"concat({path}, {_text('/' + name)})"
        if rules := _rules(inner, child, at, root, depth + 1, above):
            out.append(_each(f"filter(array({_child(v, name)}), c{depth} -> c{depth} is not null)", child, f"q{depth}", rules))
    items = f"variant_get({v}, '$', 'array<variant>')"
    if "minItems" in schema:
        broken(f"{kind} = 'array' and size({items}) < {schema['minItems']}", f"minItems {schema['minItems']}")
    if schema.get("uniqueItems"):
        texts = f"transform({items}, u{depth} -> to_json(u{depth}))"
        broken(f"{kind} = 'array' and size({texts}) <> size(array_distinct({texts}))", "uniqueItems")
    if "items" in schema:
        child, i = f"x{depth}", f"i{depth}"
        if rules := _rules(schema["items"], child, f"concat({path}, '/', {i})", root, depth + 1, above):
            out.append(f"if({kind} = 'array', {_each(items, child, i, rules)}, cast(array() as {ROWS}))")
    return out


def compiled(schema: dict, document: str) -> str:
    """SQL for the broken rules of ``document``, the name of a column of variants, as ``ROWS``."""
    rules = _rules(schema, "d", "''", schema, 0, ())
    return _each(f"array({document})", "d", "e", rules) if rules else f"cast(array() as {ROWS})"


def violations(documents: DataFrame, key: str, text: str, schema: dict) -> DataFrame:
    """(key, path, rule) of every broken rule of documents (key, text); text that is no JSON, or null, has the rule ``json`` at the root."""
    parsed = documents.select(F.col(key).alias("_key"), F.try_parse_json(F.col(text)).alias("_document"))
    found = F.when(F.col("_document").isNull(), F.array(F.struct(F.lit("").alias("path"), F.lit("json").alias("rule")))).otherwise(F.expr(compiled(schema, "_document")))
    return parsed.select("_key", F.inline(found)).withColumnRenamed("_key", key)
