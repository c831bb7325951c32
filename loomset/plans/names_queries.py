"""Queries on names, types, multiplicities, headings and prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import table
from ..functions import datatypes as D
from ..functions import headings as H
from ..functions import multiplicity as M
from ..functions import names as N
from ..operators import resolve
from .registry import Registry

query = Registry()
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"


def STRIP(c: str) -> str:  # noqa: N802
    """SQL of ``names.strip``."""
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


NOISE = "|".join(N.NOISE)
# The rules of data types, stated in SQL by themselves: the same name in lower case but for some, and what has no name of its own.
_OWN = "CASE WHEN {0} IN ('string', 'integer', 'long', 'float', 'double', 'decimal', 'boolean', 'date', 'time', 'duration') THEN {0} WHEN {0} = 'int' THEN 'integer' WHEN {0} = 'bool' THEN 'boolean' WHEN {0} = 'datetime' THEN 'dateTime' WHEN {0} = 'datetimestamp' THEN 'dateTimeStamp' WHEN {0} IN ('uri', 'anyuri') THEN 'anyURI' WHEN {0} = 'binary' THEN 'base64Binary' END".format
_NORM = f"CASE WHEN coalesce(s, '') = '' THEN 'xsd:string' WHEN lower(s) LIKE 'xsd:%' THEN 'xsd:' || coalesce({_OWN('lower(s)[5:]')}, lower(s)[5:]) WHEN lower(s) = 'datetimeinterval' THEN 'xsd:dateTime' ELSE coalesce('xsd:' || {_OWN('lower(s)')}, s) END"
_RANGE = "CASE WHEN coalesce(s, '') = '' THEN 'xsd:string' WHEN regexp_matches(s, '^https?://') THEN s WHEN lower(s) IN ('string', 'float', 'double', 'integer', 'boolean', 'date', 'decimal') THEN 'xsd:' || lower(s) WHEN lower(s) = 'str' THEN 'xsd:string' WHEN lower(s) IN ('int', 'long') THEN 'xsd:integer' WHEN lower(s) = 'bool' THEN 'xsd:boolean' WHEN lower(s) = 'datetime' THEN 'xsd:dateTime' WHEN lower(s) LIKE 'xsd:%' THEN {0} ELSE 'xsd:string' END".format
_JSON = "CASE WHEN {0} IN ('xsd:integer', 'xsd:int', 'xsd:long') THEN 'integer' WHEN {0} IN ('xsd:float', 'xsd:double', 'xsd:decimal') THEN 'number' WHEN {0} = 'xsd:boolean' THEN 'boolean' ELSE 'string' END".format
_FORMAT = "CASE {0} WHEN 'xsd:date' THEN 'date' WHEN 'xsd:time' THEN 'time' WHEN 'xsd:dateTime' THEN 'date-time' WHEN 'xsd:duration' THEN 'duration' WHEN 'xsd:anyURI' THEN 'uri' END".format
_PY = "CASE WHEN {0} IN ('xsd:integer', 'xsd:int', 'xsd:long') THEN 'int' WHEN {0} IN ('xsd:float', 'xsd:double', 'xsd:decimal') THEN 'float' WHEN {0} = 'xsd:boolean' THEN 'bool' ELSE 'str' END".format
_MODEL = "CASE WHEN {0} IN ('xsd:integer', 'xsd:int') THEN 'integer' WHEN {0} IN ('xsd:float', 'xsd:double', 'xsd:decimal') THEN 'decimal' WHEN {0} = 'xsd:boolean' THEN 'boolean' WHEN {0} = 'xsd:date' THEN 'date' WHEN {0} = 'xsd:dateTime' THEN 'datetime' ELSE 'string' END".format


@query(f"SELECT tok_id, regexp_replace(regexp_replace(content, '{WS}+', ' ', 'g'), '^ | $', '', 'g') AS inline FROM md_token")
def clean_inline(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "md_token").select("tok_id", N.clean_inline(F.col("content")).alias("inline"))


_SEPARATOR = "coalesce({0} <> '' AND ({1} = '' OR regexp_matches({1}, '^[-:|]*-[-:|]*$')), false)".format


@query(
    rf"""SELECT case_id, regexp_matches(s, '{N.SAFE_PART.replace(chr(92) + "z", "$")}') AS safe, regexp_matches(s, '{N.IDENTIFIER.replace(chr(92) + "z", "$")}') AS identifier,
    regexp_matches(raw_text, '{NOISE}') AS noisy, {_SEPARATOR("raw_text", "s")} AS rule, regexp_matches(s, '^[A-Z][A-Za-z0-9]+$') AS camel
    FROM (SELECT DISTINCT case_id, raw_text, {STRIP("raw_text")} AS s FROM ocr_noise_samples WHERE raw_text IS NOT NULL)"""
)
def identifier_checks(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("raw_text")
    x = table(spark, sf, "ocr_noise_samples").where("raw_text is not null").select("case_id", "raw_text").distinct()
    return x.select("case_id", N.is_safe_iri_part(c).alias("safe"), N.is_identifier(c).alias("identifier"), N.has_ocr_noise(c).alias("noisy"), N.is_separator(c).alias("rule"), N.camel_case(c).alias("camel"))


_KIND = f"""CASE WHEN coalesce(s, '') = '' THEN NULL WHEN {_SEPARATOR("s", "s")} THEN 'separator' WHEN regexp_matches(s, '[$\\\\]') THEN 'latex'
    WHEN NOT regexp_matches(s, '[\\x00-\\x7f]') THEN 'cjk' WHEN regexp_matches(s, '{N.NOISY_ATTRIBUTE}') THEN 'mixed_punct' END"""


@query(
    f"""SELECT coalesce({_KIND}, 'kept') AS outcome, count(*) AS n FROM (SELECT {STRIP("name")} AS s FROM data_property UNION ALL SELECT {STRIP("raw_text")} FROM ocr_noise_samples) GROUP BY 1"""
)
def attr_noise_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Kinds of noise among the attribute names of both tables, kept ones counted as such."""
    x = table(spark, sf, "data_property").select("name").unionAll(table(spark, sf, "ocr_noise_samples").select("raw_text"))
    return x.groupBy(F.coalesce(N.attribute_noise(F.col("name")), F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))


@query(
    rf"""SELECT ref_id, (coalesce(s, '') = '' OR {_SEPARATOR("s", "s")} OR NOT regexp_matches(s, '[\x00-\x7f]') OR regexp_matches(s, '^\d+\.\.|^\p{{Nd}}+$') OR regexp_matches(s, '{N.NOISY_TARGET}')) AS noise
    FROM (SELECT DISTINCT ref_id, {STRIP("class_name")} AS s FROM class_ref)"""
)
def target_noise(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "class_ref").select("ref_id", "class_name").distinct().select("ref_id", N.is_noisy_target(F.col("class_name")).alias("noise"))


@query(
    rf"""SELECT attr_id, CASE WHEN coalesce(s, '') = '' OR regexp_matches(s, '{NOISE}') THEN '{N.PLACEHOLDER}' ELSE left(regexp_replace(s, '[^A-Za-z0-9._]', '_', 'g'), 64) END AS slug,
    CASE WHEN s <> '' AND NOT regexp_matches(s, '{NOISE}') AND regexp_matches(s, '^[A-Za-z_][A-Za-z0-9_]*$') THEN 'cim:' || class_name || '.' || left(s, 64) END AS iri
    FROM (SELECT DISTINCT attr_id, class_name, {STRIP("name")} AS s FROM data_property)"""
)
def attribute_identifiers(spark: SparkSession, sf: str) -> DataFrame:
    x = table(spark, sf, "data_property").select("attr_id", "class_name", "name").distinct()
    return x.select("attr_id", N.attribute_slug(F.col("name")).alias("slug"), N.property_iri(F.col("class_name"), F.col("name")).alias("iri"))


@query(
    f"""WITH t AS (SELECT DISTINCT data_type, {STRIP("data_type")} AS s FROM data_property), x AS (SELECT *, {_NORM} AS xsd FROM t)
    SELECT data_type, xsd, {_RANGE("xsd")} AS range, {_JSON("xsd")} AS json_type, {_FORMAT("xsd")} AS json_format, CASE WHEN xsd = 'xsd:base64Binary' THEN 'base64' END AS json_encoding, {_PY("xsd")} AS python_type, {_MODEL("data_type")} AS model_type FROM x"""
)
def datatype_names(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("data_type")
    x = table(spark, sf, "data_property").select("data_type").distinct()
    return x.select("data_type", D.normalize_xsd(c).alias("xsd"), D.xsd_range(c).alias("range"), *[k.alias(n) for k, n in zip(D.json_kind(c), ("json_type", "json_format", "json_encoding"))], D.python_type(c).alias("python_type"), D.model_type(c).alias("model_type"))


@query(
    rf"""WITH t AS (SELECT DISTINCT raw, {STRIP("regexp_replace(replace(" + STRIP("raw") + ", '$', ''), '\\\\mathcal\\{[A-Z]+\\}', '', 'g')")} AS s FROM (SELECT multiplicity.raw AS raw FROM data_property UNION SELECT raw_text FROM ocr_noise_samples) WHERE raw IS NOT NULL),
    x AS (SELECT raw, CASE WHEN s IN ('many', 'n', '*', '0..n') THEN '0..*' WHEN s = '1..n' THEN '1..*' ELSE s END AS s FROM t)
    SELECT raw, TRY_CAST(regexp_extract(s, '^(\d+)\.\.(\d+|\*)$', 1) AS INT) AS least, TRY_CAST(nullif(regexp_extract(s, '^(\d+)\.\.(\d+|\*)$', 2), '*') AS INT) AS most, CASE WHEN regexp_matches(s, '^\d+\.\.(\d+|\*)$') THEN s END AS normal FROM x"""
)
def multiplicity_parsed(spark: SparkSession, sf: str) -> DataFrame:
    x = table(spark, sf, "data_property").select(F.col("multiplicity.raw").alias("raw")).union(table(spark, sf, "ocr_noise_samples").select("raw_text")).where("raw is not null").distinct()
    m = M.parse(F.col("raw"))
    return x.select("raw", m["min"].alias("least"), m["max"].alias("most"), m["raw"].alias("normal"))


@query(
    """WITH n AS (SELECT o_custkey, min(n) AS lo, max(n) AS hi FROM (SELECT o_custkey, o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) GROUP BY 1)
    SELECT o_custkey, CASE WHEN lo = 1 AND hi = 1 THEN '1' ELSE lo || '..' || hi END AS multiplicity FROM n"""
)
def multiplicity_from_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many line items a customer's orders have, as a multiplicity."""
    n = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    x = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(n, "o_orderkey", "left").fillna(0, ["n"]).groupBy("o_custkey").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    return x.select("o_custkey", M.from_counts(F.col("lo"), F.col("hi")).alias("multiplicity"))


_W = r"[\p{L}\p{N}_]"


@query(
    rf"""WITH t AS (SELECT sec_id, {STRIP("heading")} AS s FROM section_row), c AS (SELECT *, regexp_matches(s, '^\p{{Nd}}+(?:\.\p{{Nd}}+){{0,3}}{WS}+Class(?:{WS}*[:：])?{WS}+{_W}+') AS k, regexp_extract(s, '^((?:[A-Z]\.)?\p{{Nd}}+(?:\.\p{{Nd}}+){{0,4}})', 1) AS p FROM t)
    SELECT sec_id, CASE WHEN k THEN regexp_extract(s, '^(\p{{Nd}}+(?:\.\p{{Nd}}+){{0,3}})', 1) ELSE coalesce(p, '') END AS path,
    CASE WHEN k THEN regexp_extract(s, '^\p{{Nd}}+(?:\.\p{{Nd}}+){{0,3}}{WS}+Class(?:{WS}*[:：])?{WS}+({_W}+)', 1) WHEN p <> '' THEN list_last(regexp_extract_all(s[length(p) + 1:], '[(（]([A-Za-z][A-Za-z0-9_]+)[)）]', 1)) END AS class_name,
    CASE WHEN k THEN nullif(regexp_extract(s, '^\p{{Nd}}+(?:\.\p{{Nd}}+){{0,3}}{WS}+Class(?:{WS}*[:：])?{WS}+{_W}+{WS}+\(({_W}+)\)', 1), '') END AS stereotype FROM c"""
)
def heading_parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "section_row").select("sec_id", H.parse_heading(F.col("heading")).alias("h")).select("sec_id", "h.*")


@query(
    rf"""WITH t AS (SELECT sec_id, {STRIP("heading")} AS s FROM section_row), n AS (SELECT *, regexp_extract(s, '^(\p{{Nd}}+(?:\.\p{{Nd}}+){{0,3}})', 1) AS num, coalesce(regexp_matches(s, '^Class{WS}*[:：]{WS}*{_W}+'), false) AS c FROM t)
    SELECT sec_id, CASE WHEN num <> '' THEN len(string_split(num, '.')) WHEN c THEN 3 ELSE 2 END AS depth, CASE WHEN num <> '' THEN 0.9::DOUBLE WHEN c THEN 0.7 ELSE 0.3 END AS confidence FROM n"""
)
def section_depths(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "section_row").select("sec_id", H.section_depth(F.col("heading")).alias("d")).select("sec_id", "d.*")


@query(
    rf"""SELECT 'section_row' AS source_table, sec_id AS row_id, m[1] AS package, m[2] AS class_name, i AS ord FROM (SELECT sec_id, regexp_extract_all(heading, '(?:^|[^A-Za-z])(表{WS}*\p{{Nd}}+{WS}+[A-Z][A-Za-z0-9]*::[A-Z][A-Za-z0-9]+{WS}*的属性)', 1) AS l FROM section_row),
    unnest(range(len(l))) AS t(i), LATERAL (SELECT [regexp_extract(l[i + 1], '([A-Z][A-Za-z0-9]*)::', 1), regexp_extract(l[i + 1], '::([A-Z][A-Za-z0-9]+)', 1)] AS m)"""
)
def table_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Titles of tables in headings."""
    x = table(spark, sf, "section_row").select(F.lit("section_row").alias("source_table"), F.col("sec_id").alias("row_id"), F.posexplode(H.table_titles(F.col("heading"))).alias("ord", "t"))
    return x.select("source_table", "row_id", "t.package", "t.class_name", "ord")


@query(
    r"""SELECT prefix, count(*) AS n FROM (SELECT unnest(regexp_extract_all(raw_text, '(?:^|[^0-9A-Za-z_])([a-z]+):[A-Z]\w', 1)) AS prefix FROM ocr_noise_samples
    UNION ALL SELECT unnest(regexp_extract_all(data_type, '(?:^|[^0-9A-Za-z_])([a-z]+):[A-Z]\w', 1)) FROM data_property) GROUP BY 1"""
)
def alias_frequency(spark: SparkSession, sf: str) -> DataFrame:
    """Namespace prefixes in use, with how often."""
    x = table(spark, sf, "ocr_noise_samples").select("raw_text").unionAll(table(spark, sf, "data_property").select("data_type"))
    return x.select(F.explode(N.prefixes(F.col("raw_text"))).alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n"))


_CANON = "(VALUES " + ", ".join(f"('{c}', {k})" for k, c in enumerate(resolve.CANONICAL_PREFIXES)) + ") AS c(nearest, k)"


@query(
    f"""WITH p AS (SELECT DISTINCT lower(regexp_extract(data_type, '^([A-Za-z0-9]+):', 1)) AS prefix FROM data_property WHERE regexp_matches(data_type, '^[A-Za-z0-9]+:')
    UNION SELECT lower(regexp_extract(raw_text, '^([A-Za-z0-9]+):', 1)) FROM ocr_noise_samples WHERE regexp_matches(raw_text, '^[A-Za-z0-9]+:'))
    SELECT prefix, arg_min(nearest, levenshtein(prefix, nearest) * 100 + k) AS nearest FROM p, {_CANON} GROUP BY 1 HAVING min(levenshtein(prefix, nearest)) BETWEEN 1 AND 2"""
)
def nearest_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Misspelled prefixes with the canonical one they stand for."""
    x = table(spark, sf, "data_property").select(F.col("data_type").alias("s")).union(table(spark, sf, "ocr_noise_samples").select("raw_text"))
    return resolve.nearest_prefix(x.where(F.col("s").rlike("^[A-Za-z0-9]+:")).select(F.lower(F.regexp_extract("s", "^([A-Za-z0-9]+):", 1)).alias("prefix")))


@query(
    """WITH k AS (SELECT DISTINCT name FROM class_def WHERE name IS NOT NULL), x AS (SELECT DISTINCT raw_text AS name FROM ocr_noise_samples WHERE raw_text IS NOT NULL),
    f AS (SELECT * FROM (VALUES """
    + ", ".join(f"('{a}', '{b}')" for a, b in resolve.CORRECTIONS.items())
    + """) AS f(name, fixed)),
    d AS (SELECT x.name, list(k.name ORDER BY levenshtein(x.name, k.name), k.name)[1:3] AS near FROM x JOIN k ON abs(length(x.name) - length(k.name)) <= 2 AND levenshtein(x.name, k.name) <= 2 GROUP BY 1)
    SELECT x.name, coalesce(fixed, x.name) AS value, fixed IS NOT NULL AS correction_applied, CASE WHEN fixed IS NULL AND k.name IS NULL THEN CASE WHEN near IS NOT NULL THEN 'possible_typo' ELSE 'class_unknown' END END AS uncertainty_reason,
    CASE WHEN fixed IS NULL AND k.name IS NULL THEN coalesce(near, []) ELSE [] END AS suggestions FROM x LEFT JOIN k USING (name) LEFT JOIN f USING (name) LEFT JOIN d USING (name)"""
)
def clean_class_names(spark: SparkSession, sf: str) -> DataFrame:
    """Class names as scanned against the known ones. (DuckDB's distance counts bytes: of ASCII names, as the tables have, it is the same.)"""
    x = table(spark, sf, "ocr_noise_samples").select(F.col("raw_text").alias("name"))
    return resolve.clean_class_names(x, table(spark, sf, "class_def").where("name is not null").select("name"))


@query(f"SELECT class_id, regexp_extract(regexp_extract(iri, '([^#]*)$', 1), '([^/]*)$', 1) AS local, regexp_replace(regexp_replace(lower(regexp_replace(description, '[^\\p{{L}}\\p{{Nl}}\\p{{Nd}}]+', '-', 'g')), '^-+', ''), '-+$', '') AS slug FROM (SELECT DISTINCT class_id, iri, description FROM class_def)")
def local_names(spark: SparkSession, sf: str) -> DataFrame:
    """Local part of each class's IRI, and its description as a slug."""
    x = table(spark, sf, "class_def").select("class_id", "iri", "description").distinct()
    return x.select("class_id", N.local_name(F.col("iri")).alias("local"), N.slug(F.col("description")).alias("slug"))
