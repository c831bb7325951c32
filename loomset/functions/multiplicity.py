"""Multiplicities as columns: STRUCT<min INT, max INT, raw STRING>, max null for many."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import blank, strip

TYPE = "struct<min:int,max:int,raw:string>"


def parse(raw: Column) -> Column:
    """The multiplicity, or null if ``raw`` is none: ``a..b`` or ``a..*`` after typesetting is taken off; ``many``, ``n``, ``*``, ``0..n`` and
    ``1..n`` stand for many. A number alone is none; min may exceed max."""
    s = strip(F.regexp_replace(F.regexp_replace(strip(raw), r"\$", ""), r"\\mathcal\{[A-Z]+\}", ""))
    s = F.when(s.isin("many", "n", "*", "0..n"), "0..*").when(s == "1..n", "1..*").otherwise(s)
    part = lambda k: F.regexp_extract(s, r"^(\d+)\.\.(\d+|\*)\z", k)
    of = F.struct(part(1).try_cast("int").alias("min"), F.when(part(2) != "*", part(2).try_cast("int")).alias("max"), s.alias("raw"))
    return F.when(F.coalesce(part(1).try_cast("int").isNotNull() & ((part(2) == "*") | part(2).try_cast("int").isNotNull()), F.lit(False)), of)


def parse_or_optional(raw: Column) -> Column:
    """As ``parse``; what is none becomes 0..1 and keeps its text."""
    text = F.when(F.coalesce(raw, F.lit("")) == "", "0..1").otherwise(raw)
    return F.coalesce(parse(text), F.struct(F.lit(0).alias("min"), F.lit(1).alias("max"), text.alias("raw")))


def is_many(m: Column) -> Column:
    return m["max"].isNull() | (m["max"] > 1)


def text(m: Column) -> Column:
    return F.coalesce(F.when(~blank(m["raw"]), m["raw"]), F.lit("0..1"))


def from_counts(lo: Column, hi: Column) -> Column:
    """``1``, ``0..1``, ``1..*`` or ``lo..hi``; a null lo is 0, a null hi many."""
    low, high = F.coalesce(lo.cast("int"), F.lit(0)), F.coalesce(hi.cast("int").cast("string"), F.lit("*"))
    return F.when((low == 1) & (high == "1"), "1").otherwise(F.concat(low.cast("string"), F.lit(".."), high))
