"""JSON Schemas as column expressions: what breaks a schema in a parsed document, and where.

A schema is compiled once into one expression over a VARIANT column, so documents are
checked by Spark where they are, without Python and without a shuffle.  Supported:
type, enum, const, required, properties, additionalProperties, items, minItems, maxItems,
uniqueItems, pattern (found anywhere, in Java's syntax), minLength, maxLength, minimum,
maximum, exclusiveMinimum, exclusiveMaximum, multipleOf, oneOf, anyOf, allOf, not, and
$ref to definitions of the same schema.  format is an annotation.  Keywords that would
assert anything else, and schemas that refer to themselves, are errors when compiled.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: what an error says: where (a JSON pointer) and which keyword
ERRORS = "array<struct<pointer: string, rule: string>>"
_NOTES = frozenset("$schema $id $defs $comment $anchor definitions title description default examples format deprecated readOnly writeOnly".split())
#: how deep references may lead before a schema counts as one that refers to itself
_DEEP = 24


def _none() -> Column:
    return F.array().cast(ERRORS)


def _escaped(key: str) -> str:
    return key.replace("~", "~0").replace("/", "~1")


def _error(at: Column, rule: str) -> Column:
    return F.struct(at.alias("pointer"), F.lit(rule).alias("rule"))


def _unless(good: Column, at: Column, rule: str) -> Column:
    """One error where `good` is false; unknown counts as false."""
    return F.when(F.coalesce(good, F.lit(False)), _none()).otherwise(F.array(_error(at, rule)))


def _once(value: Column, found: Callable[[Column], Column]) -> Column:
    """found(value) with the value computed once a row; as plain text it would stand, and be computed, wherever found reads it."""
    return F.get(F.transform(F.array(value), lambda x: found(x)), F.lit(0))


class _Value:
    """A VARIANT column seen as each of JSON's types.

    Objects and arrays are known by what they hold: schema_of_variant spells out all below them.
    """

    def __init__(self, v: Column):
        self.v, kind = v, F.schema_of_variant(v)
        self.is_string, self.is_boolean, self.is_null = kind == "STRING", kind == "BOOLEAN", kind == "VOID"
        self.is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
        self.number = F.try_variant_get(v, "$", "double")
        self.string = F.try_variant_get(v, "$", "string")
        self.items = F.try_variant_get(v, "$", "array<variant>")
        self.members = F.try_variant_get(v, "$", "map<string,variant>")
        self.is_object, self.is_array = self.members.isNotNull(), self.items.isNotNull()
        self.text = F.to_json(v)

    def of(self, name: str) -> Column:
        return {
            "string": self.is_string, "boolean": self.is_boolean, "null": self.is_null, "object": self.is_object, "array": self.is_array,
            "number": self.is_number, "integer": self.is_number & (self.number == F.floor(self.number)),
        }[name]

    def equals(self, wanted: Any) -> Column:
        if wanted is None:
            return self.is_null
        if isinstance(wanted, bool):
            return self.is_boolean & (self.text == json.dumps(wanted))
        if isinstance(wanted, (int, float)):
            return self.is_number & (self.number == float(wanted))
        if isinstance(wanted, str):
            return self.is_string & (self.string == wanted)
        return self.text == F.to_json(F.parse_json(F.lit(json.dumps(wanted))))


def errors(schema: dict | bool, value: Column) -> Column:
    """What breaks the schema in a VARIANT column, as an array of (pointer, rule); null, which no JSON text gives, has the rule `json`."""
    return _once(value, lambda v: F.when(v.isNull(), F.array(_error(F.lit(""), "json"))).otherwise(_check(schema, schema, v, F.lit(""), 0, True)))


def errors_of_text(schema: dict | bool, text: Column) -> Column:
    """errors() of JSON text; text that is no JSON, or has a key twice in one object, has the rule `json`."""
    return errors(schema, F.try_parse_json(text))


def invalid(rows: DataFrame, schema: dict | bool, text: str = "json") -> DataFrame:
    """The columns of rows but for the text, and (pointer, rule) of each error in it."""
    kept = [c for c in rows.columns if c != text]
    return rows.select(*kept, F.explode(errors_of_text(schema, F.col(text))).alias("_e")).select(*kept, "_e.pointer", "_e.rule")


def _resolved(root: Any, ref: str) -> Any:
    if not ref.startswith("#"):
        raise ValueError(f"reference {ref!r} leads out of the schema")
    found = root
    for part in ref[1:].split("/")[1:]:
        found = found[part.replace("~1", "/").replace("~0", "~")]
    return found


def _check(schema: dict | bool, root: Any, v: Column, at: Column, depth: int, held: bool = False) -> Column:
    """held: v is computed already (see _once)."""
    if schema is True or schema == {}:
        return _none()
    if schema is False:
        return F.array(_error(at, "false"))
    if depth > _DEEP:
        raise ValueError("the schema refers to itself")
    return _broken(schema, root, v, at, depth) if held else _once(v, lambda one: _broken(schema, root, one, at, depth))


def _broken(schema: dict, root: Any, v: Column, at: Column, depth: int) -> Column:
    x, parts = _Value(v), []
    sub = lambda s, value, where: _check(s, root, value, where, depth + 1, value is v)
    holds = lambda s: F.size(sub(s, v, at)) == 0
    if unknown := set(schema) - _NOTES - set(_SIMPLE) - {"$ref", "type", "enum", "const", "required", "properties", "additionalProperties", "items", "oneOf", "anyOf", "allOf", "not"}:
        raise ValueError(f"unsupported keywords: {', '.join(sorted(unknown))}")
    if "$ref" in schema:
        parts.append(sub(_resolved(root, schema["$ref"]), v, at))
    if "type" in schema:
        names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        parts.append(_unless(_any([x.of(n) for n in names]), at, "type"))
    if "enum" in schema:
        parts.append(_unless(_any([x.equals(w) for w in schema["enum"]]), at, "enum"))
    if "const" in schema:
        parts.append(_unless(x.equals(schema["const"]), at, "const"))
    for keyword, wanted in schema.items():
        if keyword in _SIMPLE:
            concerns, good = _SIMPLE[keyword](x, wanted)
            parts.append(F.when(F.coalesce(concerns, F.lit(False)), _unless(good, at, keyword)).otherwise(_none()))
    parts += _object(schema, x, at, sub)
    if "items" in schema:
        each = F.transform(x.items, lambda item, i: sub(schema["items"], item, F.concat(at, F.lit("/"), i.cast("string"))))
        parts.append(F.when(x.is_array, F.flatten(each)).otherwise(_none()))
    if "allOf" in schema:
        parts += [sub(s, v, at) for s in schema["allOf"]]
    if "anyOf" in schema:
        parts.append(_unless(_any([holds(s) for s in schema["anyOf"]]), at, "anyOf"))
    if "oneOf" in schema:
        n = sum((holds(s).cast("int") for s in schema["oneOf"]), F.lit(0))
        parts.append(_unless(n == 1, at, "oneOf"))
    if "not" in schema:
        parts.append(_unless(~holds(schema["not"]), at, "not"))
    return F.concat(*parts) if parts else _none()


def _any(found: list[Column]) -> Column:
    out = F.lit(False)
    for one in found:
        out = out | F.coalesce(one, F.lit(False))
    return out


#: keywords that concern values of one type: whether they concern this one, and whether it is good
_SIMPLE = {
    "pattern": lambda x, w: (x.is_string, x.string.rlike(w)),
    "minLength": lambda x, w: (x.is_string, F.length(x.string) >= w),
    "maxLength": lambda x, w: (x.is_string, F.length(x.string) <= w),
    "minimum": lambda x, w: (x.is_number, x.number >= w),
    "maximum": lambda x, w: (x.is_number, x.number <= w),
    "exclusiveMinimum": lambda x, w: (x.is_number, x.number > w),
    "exclusiveMaximum": lambda x, w: (x.is_number, x.number < w),
    "multipleOf": lambda x, w: (x.is_number, F.abs(x.number / w - F.round(x.number / w)) < 1e-9),
    "minItems": lambda x, w: (x.is_array, F.size(x.items) >= w),
    "maxItems": lambda x, w: (x.is_array, F.size(x.items) <= w),
    "uniqueItems": lambda x, w: (x.is_array & F.lit(bool(w)), F.size(F.array_distinct(F.transform(x.items, lambda i: F.to_json(i)))) == F.size(x.items)),
}


def _object(schema: dict, x: _Value, at: Column, sub) -> list[Column]:
    """Errors of required, properties and additionalProperties, which concern objects."""
    if not schema.get("required") and not schema.get("properties") and schema.get("additionalProperties", True) is True:
        return []
    return [_once(x.members, lambda members: F.when(members.isNotNull(), _members(schema, members, at, sub)).otherwise(_none()))]


def _members(schema: dict, members: Column, at: Column, sub) -> Column:
    parts, named = [], schema.get("properties", {})
    member = lambda k: F.try_element_at(members, F.lit(k))
    below = lambda k: F.concat(at, F.lit("/" + _escaped(k)))
    for key in schema.get("required", []):
        parts.append(_unless(F.map_contains_key(members, F.lit(key)), below(key), "required"))
    for key, wanted in named.items():
        there = F.coalesce(F.map_contains_key(members, F.lit(key)), F.lit(False))
        parts.append(F.when(there, sub(wanted, member(key), below(key))).otherwise(_none()))
    more = schema.get("additionalProperties", True)
    if more is not True:
        others = F.filter(F.map_entries(members), lambda e: ~e["key"].isin(*named) if named else F.lit(True))
        place = lambda e: F.concat(at, F.lit("/"), F.replace(F.replace(e["key"], F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))
        each = F.transform(others, lambda e: F.array(_error(place(e), "additionalProperties")) if more is False else sub(more, e["value"], place(e)))
        parts.append(F.flatten(each))
    return F.concat(*parts)
