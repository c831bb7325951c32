"""Constraints on instance data: counts, datatypes, classes and references."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_violations(nodes: DataFrame, values: DataFrame, node: str, least: int = 0, most: int | None = None) -> DataFrame:
    """(node, n, violation) of the nodes with fewer than ``least`` or more than ``most`` values; a node without any counts 0. Values are counted
    before they meet the nodes; null nodes are none."""
    n = values.where(F.col(node).isNotNull()).groupBy(node).agg(F.count("*").alias("n"))
    x = nodes.select(node).where(F.col(node).isNotNull()).distinct().join(n, node, "left").fillna(0, ["n"])
    kind = F.when(F.col("n") < least, "minCount")
    return x.withColumn("violation", kind if most is None else kind.when(F.col("n") > most, "maxCount")).where("violation is not null")


# SQL types that hold the lexical forms of XSD types.
CASTS = {"xsd:integer": "decimal(38,0)", "xsd:long": "bigint", "xsd:short": "smallint", "xsd:byte": "tinyint", "xsd:float": "float", "xsd:double": "double", "xsd:decimal": "decimal(38,18)", "xsd:date": "date", "xsd:dateTime": "timestamp", "xsd:boolean": "boolean"}


def conforms(value: Column, xsd: str) -> Column:
    """Whether a text is a lexical form of the type; a null conforms; a type without a form here always does."""
    if xsd == "xsd:boolean":
        return F.coalesce(value.isin("true", "false", "1", "0"), F.lit(True))
    if xsd in ("xsd:integer", "xsd:long", "xsd:short", "xsd:byte"):
        return value.isNull() | (value.rlike(r"^[+-]?[0-9]+\z") & value.try_cast(CASTS[xsd]).isNotNull())
    return value.isNull() | value.try_cast(CASTS[xsd]).isNotNull() if xsd in CASTS else F.lit(True)


def datatype_violations(rows: DataFrame, value: Column, xsd: str) -> DataFrame:
    """The rows whose value is no lexical form of the type."""
    return rows.where(~conforms(value, xsd))


def class_violations(rows: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """The rows whose non-null key names no member: the target isn't of the class, or not there at all."""
    there = members.select(F.col(member_key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return rows.where(F.col(key).isNotNull()).join(there, key, "left_anti")


def document_violations(rows: DataFrame, text: str, required: list[str], types: dict[str, str]) -> DataFrame:
    """(…, violation) of JSON texts that are no object, lack a required field, have a field unknown to ``types`` (JSON types by field), or one
    of another type; a text may have several violations, null texts none."""
    v = F.try_parse_json(F.col(text))
    x = rows.where(F.col(text).isNotNull()).withColumn("_o", F.try_variant_get(v, "$", "map<string,variant>"))
    kind = lambda c: F.regexp_extract(F.schema_of_variant(c), r"^(\w+)", 1)
    of = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DECIMAL", "DOUBLE"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}
    missing = F.transform(F.filter(F.array(*[F.lit(r) for r in required]), lambda r: ~F.map_contains_key("_o", r)), lambda r: F.concat(F.lit("required "), r))
    unknown = F.transform(F.filter(F.map_keys("_o"), lambda k: ~k.isin(list(types))), lambda k: F.concat(F.lit("unknown "), k))
    value = lambda k: F.try_element_at("_o", F.lit(k))
    wrong = F.array_compact(F.array(*[F.when(value(k).isNotNull() & ~kind(value(k)).isin(of[t]), F.lit(f"type {k}")) for k, t in types.items()]))
    none = F.array().cast("array<string>")
    found = F.when(F.col("_o").isNull(), F.array(F.lit("not an object"))).otherwise(F.concat(missing if required else none, unknown, wrong if types else none))
    return x.withColumn("violation", F.explode(found)).drop("_o")


def schema_violations(rows: DataFrame, text: str, schema: dict) -> DataFrame:
    """(…, violation) of JSON texts against a JSON Schema: ``type`` (one or several), ``const``, ``enum``, ``required``, ``properties``,
    ``additionalProperties: false``, ``items``, ``anyOf`` and ``$ref`` to ``#/$defs/…``, at any depth that the schema has. A violation is the keyword and
    the place (``[]`` for items); each item that breaks a rule gives a row. A text that is no JSON breaks ``json``; null texts none. A schema that
    refers to itself is an error."""
    v = F.try_parse_json(F.col(text))
    found = F.when(v.isNull(), F.array(F.lit("json $"))).otherwise(_broken(v, schema, "$", schema.get("$defs", {}), ()))
    return rows.where(F.col(text).isNotNull()).withColumn("violation", F.explode(found))


_TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DECIMAL", "DOUBLE"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"], "null": ["VOID"]}


def _broken(v: Column, schema: dict, at: str, defs: dict, seen: tuple[str, ...]) -> Column:
    """The violations of a value, an array of texts."""
    none = F.array().cast("array<string>")
    if ref := schema.get("$ref"):
        name = ref.removeprefix("#/$defs/")
        if name in seen or name not in defs:
            raise ValueError(f"{ref}: refers to itself" if name in seen else f"{ref}: not there")
        return _broken(v, defs[name], at, defs, (*seen, name))
    parts = []
    kind = F.regexp_extract(F.schema_of_variant(v), r"^(\w+)", 1)
    if kinds := schema.get("type"):
        fit = [k for t in ([kinds] if isinstance(kinds, str) else kinds) for k in _TYPES[t]]
        parts.append(F.when(kind.isin(fit), none).otherwise(F.array(F.lit(f"type {at}"))))
    for word in ("const", "enum"):
        if word in schema:
            values = [F.to_json(F.parse_json(F.lit(json.dumps(x)))) for x in ([schema[word]] if word == "const" else schema[word])]
            parts.append(F.when(F.to_json(v).isin(*values), none).otherwise(F.array(F.lit(f"{word} {at}"))))
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    known = schema.get("properties", {})
    for k in schema.get("required", ()):
        parts.append(F.when(fields.isNotNull() & ~F.map_contains_key(fields, F.lit(k)), F.array(F.lit(f"required {at}.{k}"))).otherwise(none))
    if schema.get("additionalProperties") is False:
        parts.append(F.coalesce(F.transform(F.filter(F.map_keys(fields), lambda k: ~k.isin(list(known))), lambda k: F.concat(F.lit(f"additionalProperties {at}."), k)), none))
    for k, inner in known.items():
        there = F.coalesce(F.map_contains_key(fields, F.lit(k)), F.lit(False))
        parts.append(F.when(there, _broken(F.try_element_at(fields, F.lit(k)), inner, f"{at}.{k}", defs, seen)).otherwise(none))
    if "items" in schema:
        parts.append(F.coalesce(F.flatten(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: _broken(x, schema["items"], f"{at}[]", defs, seen))), none))
    if "anyOf" in schema:
        some = [F.size(_broken(v, s, at, defs, seen)) == 0 for s in schema["anyOf"]]
        parts.append(F.when(reduce(Column.__or__, some), none).otherwise(F.array(F.lit(f"anyOf {at}"))))
    return F.concat(*parts) if parts else none
