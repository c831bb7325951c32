"""Names of data types: spellings to XSD, and XSD to the types of each output."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import blank, strip

# Spellings of a type, without and with the prefix ``xsd:``.
BARE = {
    "string": "string", "int": "integer", "integer": "integer", "long": "long", "float": "float", "double": "double", "decimal": "decimal",
    "boolean": "boolean", "bool": "boolean", "date": "date", "time": "time", "datetime": "dateTime", "datetimestamp": "dateTimeStamp",
    "datetimeinterval": "dateTime", "duration": "duration", "uri": "anyURI", "anyuri": "anyURI", "binary": "base64Binary",
}
PREFIXED = {k: v for k, v in BARE.items() if k != "datetimeinterval"} | {"short": "short", "byte": "byte"}
# Types of the outputs; whatever is missing here is a string.
JSON_TYPE = {
    "xsd:string": "string", "xsd:integer": "integer", "xsd:int": "integer", "xsd:long": "integer", "xsd:float": "number", "xsd:double": "number",
    "xsd:decimal": "number", "xsd:boolean": "boolean", "xsd:date": "string", "xsd:dateTime": "string", "xsd:time": "string", "xsd:duration": "string", "xsd:anyURI": "string",
}
JSON_FORMAT = {"xsd:date": "date", "xsd:time": "time", "xsd:dateTime": "date-time", "xsd:duration": "duration", "xsd:anyURI": "uri"}
JSON_ENCODING = {"xsd:base64Binary": "base64"}
PYTHON_TYPE = {
    "xsd:string": "str", "xsd:integer": "int", "xsd:int": "int", "xsd:long": "int", "xsd:float": "float", "xsd:double": "float", "xsd:decimal": "float",
    "xsd:boolean": "bool", "xsd:date": "str", "xsd:dateTime": "str", "xsd:time": "str", "xsd:duration": "str", "xsd:anyURI": "str",
}
RANGE = {
    "string": "string", "str": "string", "float": "float", "double": "double", "int": "integer", "integer": "integer", "long": "integer",
    "boolean": "boolean", "bool": "boolean", "date": "date", "datetime": "dateTime", "decimal": "decimal",
}
MODEL_TYPE = {"xsd:string": "string", "xsd:integer": "integer", "xsd:int": "integer", "xsd:float": "decimal", "xsd:double": "decimal", "xsd:decimal": "decimal", "xsd:boolean": "boolean", "xsd:date": "date", "xsd:dateTime": "datetime"}


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*table.items())]), key)


def normalize_xsd(c: Column) -> Column:
    """``xsd:`` with the standard name; a blank type is a string; an unknown one stays as it is, trimmed."""
    s = strip(c)
    low = F.lower(s)
    suffix = F.substring(low, 5, 2**31 - 1)
    prefixed = F.concat(F.lit("xsd:"), F.coalesce(_lookup(PREFIXED, suffix), suffix))
    bare = F.coalesce(F.concat(F.lit("xsd:"), _lookup(BARE, low)), s)
    return F.when(blank(c), "xsd:string").when(low.startswith("xsd:"), prefixed).otherwise(bare)


def xsd_range(c: Column, keep_prefixed: bool = True) -> Column:
    """Range of a datatype property: an IRI as it is, a known spelling as XSD, else a string. ``keep_prefixed=False`` also makes those with
    prefix strings, as the model's first publisher did."""
    s = strip(c)
    bare = F.concat(F.lit("xsd:"), _lookup(RANGE, F.lower(s)))
    known = F.when(F.lower(s).startswith("xsd:") & F.lit(keep_prefixed), normalize_xsd(c))
    return F.when(blank(c), "xsd:string").when(s.rlike("^https?://"), s).otherwise(F.coalesce(bare, known, F.lit("xsd:string")))


def json_type(c: Column) -> Column:
    return F.coalesce(_lookup(JSON_TYPE, normalize_xsd(c)), F.lit("string"))


def json_kind(c: Column) -> list[Column]:
    """The keywords of a JSON Schema that say what a value is: ``type``, and ``format`` or ``contentEncoding`` where it has one."""
    s = normalize_xsd(c)
    return [json_type(c).alias("type"), _lookup(JSON_FORMAT, s).alias("format"), _lookup(JSON_ENCODING, s).alias("contentEncoding")]


def python_type(c: Column) -> Column:
    return F.coalesce(_lookup(PYTHON_TYPE, normalize_xsd(c)), F.lit("str"))


def model_type(c: Column) -> Column:
    return F.coalesce(_lookup(MODEL_TYPE, c), F.lit("string"))
