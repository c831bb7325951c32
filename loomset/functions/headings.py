"""Headings, titles of tables and HTML tables in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import clean_inline, strip

# How headings and titles of tables are written.
CLASS_HEADING = r"(?U)^(\p{Nd}+(?:\.\p{Nd}+){0,3})\s+Class(?:\s*[:：])?\s+([\p{L}\p{N}_]+)(?:\s+\(([\p{L}\p{N}_]+)\))?"
PATH = r"^((?:[A-Z]\.)?\p{Nd}+(?:\.\p{Nd}+){0,4})"
BRACKETED_NAME = r"[\(（]([A-Za-z][A-Za-z0-9_]+)[\)）]"
TABLE_TITLE = r"(?U)(?<![A-Za-z])表\s*\d+\s+([A-Z][A-Za-z0-9]*)::([A-Z][A-Za-z0-9]+)\s*的属性"
INHERITED = r"(?U)继承\s*自\s*[：:]\s*([A-Z][A-Za-z0-9]+)"


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def parse_heading(c: Column) -> Column:
    """STRUCT<path, class_name, stereotype>: a heading ``path Class: Name (Stereotype)``, else a path and the last ASCII name in brackets
    behind it, else a path alone; path is empty if there is none."""
    s = strip(c)
    is_class = F.coalesce(s.rlike(CLASS_HEADING), F.lit(False))
    path = F.coalesce(F.regexp_extract(s, PATH, 1), F.lit(""))
    names = F.regexp_extract_all(F.substring(s, F.length(path) + 1, F.length(s)), F.lit(BRACKETED_NAME), F.lit(1))
    last = F.when((path != "") & (F.size(names) > 0), F.element_at(names, -1))
    return F.struct(
        F.when(is_class, F.regexp_extract(s, CLASS_HEADING, 1)).otherwise(path).alias("path"),
        F.when(is_class, F.regexp_extract(s, CLASS_HEADING, 2)).otherwise(last).alias("class_name"),
        F.when(is_class, _some(F.regexp_extract(s, CLASS_HEADING, 3))).alias("stereotype"),
    )


def table_titles(c: Column) -> Column:
    """ARRAY<STRUCT<package, class_name, title, tail>> of the titles in a paragraph, each with the text up to the next one."""
    titles = F.regexp_extract_all(c, F.lit(TABLE_TITLE), F.lit(0))
    parts = F.split(c, TABLE_TITLE)
    return F.transform(titles, lambda t, k: F.struct(F.regexp_extract(t, TABLE_TITLE, 1).alias("package"), F.regexp_extract(t, TABLE_TITLE, 2).alias("class_name"), strip(t).alias("title"), strip(F.get(parts, k + 1)).alias("tail")))


def before_titles(c: Column) -> Column:
    """The text before the first title."""
    return strip(F.get(F.split(c, TABLE_TITLE, 2), F.lit(0)))


def inherited_from(description: Column) -> Column:
    return _some(F.regexp_extract(description, INHERITED, 1))


def html_table(c: Column) -> Column:
    """The first table of an HTML text as lines of cells joined with ``|``; rows without cells are left out; empty if there is no table."""
    body = F.regexp_extract(c, r"(?is)<table[^>]*>(.*?)</table>", 1)
    rows = F.transform(F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1)), lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[hd][^>]*>(.*?)</t[hd]>"), F.lit(1)), lambda x: clean_inline(F.regexp_replace(x, r"<[^>]+>", ""))))
    return F.array_join(F.transform(F.filter(rows, lambda r: F.size(r) > 0), lambda r: F.array_join(r, "|")), "\n")


def section_depth(heading: Column) -> Column:
    """STRUCT<depth, confidence>: a numbered heading by the parts of its number (four at most), ``Class: Name`` as 3, anything else as 2."""
    s = strip(heading)
    number = F.regexp_extract(s, r"^(\p{Nd}+(?:\.\p{Nd}+){0,3})", 1)
    named = F.coalesce(s.rlike(r"(?U)^Class\s*[:：]\s*[\p{L}\p{N}_]+"), F.lit(False))
    depth = F.when(number != "", F.size(F.split(number, r"\."))).when(named, 3).otherwise(2)
    sure = F.when(number != "", 0.9).when(named, 0.7).otherwise(0.3)
    return F.struct(depth.alias("depth"), sure.cast("double").alias("confidence"))
