"""Queries on instance data: shapes, metrics, the response cache and review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import table
from ..operators import consistency, metrics, resolve, review, validate
from .registry import Registry

query = Registry()
LEAST, MOST = 1, 6


@query(
    f"""SELECT o_orderkey, n, CASE WHEN n < {LEAST} THEN 'minCount' ELSE 'maxCount' END AS violation FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) WHERE n < {LEAST} OR n > {MOST}"""
)
def shape_min_max_count(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with fewer or more line items than their shape allows."""
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return validate.count_violations(table(spark, sf, "orders"), items, "o_orderkey", LEAST, MOST)


@query("SELECT event_id, event_type FROM events WHERE event_type IS NOT NULL AND TRY_CAST(props ->> '$.k' AS BIGINT) IS NULL AND (props ->> '$.k') IS NOT NULL UNION ALL SELECT event_id, event_type FROM events WHERE TRY_CAST(event_type AS BIGINT) IS NULL AND event_type IS NOT NULL")
def shape_datatype(spark: SparkSession, sf: str) -> DataFrame:
    """Values that are no integers: of a JSON field, and of the types of events."""
    e = table(spark, sf, "events")
    a = validate.datatype_violations(e, F.get_json_object("props", "$.k"), "xsd:integer")
    b = validate.datatype_violations(e, F.col("event_type"), "xsd:integer")
    return a.select("event_id", "event_type").unionAll(b.select("event_id", "event_type"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)")
def shape_class(spark: SparkSession, sf: str) -> DataFrame:
    """Line items whose part isn't one of the class of larger parts."""
    members = table(spark, sf, "part").where("p_size > 5")
    return validate.class_violations(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", members, "p_partkey")


@query(
    """SELECT feed_id, 'required schema_version' AS violation FROM ir_feed WHERE json_type(TRY_CAST(payload AS JSON)) = 'OBJECT' AND NOT json_exists(TRY_CAST(payload AS JSON), '$.schema_version')
    UNION ALL SELECT feed_id, 'required packages' FROM ir_feed WHERE json_type(TRY_CAST(payload AS JSON)) = 'OBJECT' AND NOT json_exists(TRY_CAST(payload AS JSON), '$.packages')
    UNION ALL SELECT feed_id, 'unknown ' || k FROM (SELECT feed_id, unnest(json_keys(TRY_CAST(payload AS JSON))) AS k FROM ir_feed WHERE json_type(TRY_CAST(payload AS JSON)) = 'OBJECT') WHERE k NOT IN ('schema_version', 'packages', 'stats')
    UNION ALL SELECT feed_id, 'type packages' FROM ir_feed WHERE json_type(TRY_CAST(payload AS JSON)) = 'OBJECT' AND json_type(TRY_CAST(payload AS JSON) -> 'packages') <> 'ARRAY'
    UNION ALL SELECT feed_id, 'not an object' FROM ir_feed WHERE payload IS NOT NULL AND coalesce(json_type(TRY_CAST(payload AS JSON)), '') <> 'OBJECT'"""
)
def document_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Extractions that break the schema of an extraction."""
    x = table(spark, sf, "ir_feed").select("feed_id", "payload")
    return validate.document_violations(x, "payload", ["schema_version", "packages"], {"schema_version": "string", "packages": "array", "stats": "object"}).select("feed_id", "violation")


_SCHEMA = {
    "type": "object",
    "required": ["packages"],
    "additionalProperties": False,
    "properties": {
        "schema_version": {"const": "1.0"},
        "stats": {"type": ["object", "null"]},
        "packages": {"type": "array", "items": {"anyOf": [{"type": "null"}, {"$ref": "#/$defs/package"}]}},
    },
    "$defs": {"package": {"type": "object", "required": ["name", "iri"], "properties": {"name": {"type": "string"}, "version": {"type": "string"}, "classes": {"type": ["array", "null"]}}}},
}


@query(
    """WITH v AS (SELECT feed_id, TRY_CAST(payload AS JSON) AS j FROM ir_feed WHERE payload IS NOT NULL), o AS (SELECT * FROM v WHERE json_type(j) = 'OBJECT'),
    p AS (SELECT feed_id, unnest((j -> 'packages')::JSON[]) AS n FROM o WHERE json_type(j -> 'packages') = 'ARRAY'),
    x AS (SELECT feed_id, 'json $' AS violation FROM v WHERE j IS NULL UNION ALL SELECT feed_id, 'type $' FROM v WHERE json_type(j) <> 'OBJECT' UNION ALL SELECT feed_id, 'required $.packages' FROM o WHERE NOT list_contains(json_keys(j), 'packages')
    UNION ALL SELECT feed_id, 'additionalProperties $.' || k FROM (SELECT feed_id, unnest(json_keys(j)) AS k FROM o) WHERE k NOT IN ('schema_version', 'stats', 'packages') UNION ALL SELECT feed_id, 'const $.schema_version' FROM o WHERE (j -> 'schema_version')::VARCHAR <> '"1.0"'
    UNION ALL SELECT feed_id, 'type $.stats' FROM o WHERE json_type(j -> 'stats') NOT IN ('OBJECT', 'NULL') UNION ALL SELECT feed_id, 'type $.packages' FROM o WHERE json_type(j -> 'packages') <> 'ARRAY'
    UNION ALL SELECT feed_id, 'anyOf $.packages[]' FROM p WHERE json_type(n) <> 'NULL' AND NOT (json_type(n) = 'OBJECT' AND coalesce(json_type(n -> 'name'), '') = 'VARCHAR' AND json_exists(n, '$.iri') AND coalesce(json_type(n -> 'version'), 'VARCHAR') = 'VARCHAR' AND coalesce(json_type(n -> 'classes'), 'NULL') IN ('ARRAY', 'NULL')))
    SELECT feed_id, violation, count(*) AS n FROM x GROUP BY ALL"""
)
def schema_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Extractions against a nested schema, with how often each rule is broken."""
    x = validate.schema_violations(table(spark, sf, "ir_feed").select("feed_id", "payload"), "payload", _SCHEMA)
    return x.groupBy("feed_id", "violation").agg(F.count("*").alias("n"))


@query("SELECT name, package, row_number() OVER (ORDER BY first, name) - 1 AS place FROM (SELECT name, arg_max({'p': package}, {'l': loaded_at, 'c': class_id}).p AS package, min({'l': loaded_at, 'c': class_id}) AS first FROM class_def WHERE name IS NOT NULL GROUP BY 1)")
def class_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Names of classes as a registry has them: the last package of each, in the order in which names came first."""
    return resolve.class_registry(table(spark, sf, "class_def").select("name", "package", "loaded_at", "class_id"), "loaded_at", "class_id")


_PREFIXED = "SELECT DISTINCT regexp_extract(data_type, '^([A-Za-z0-9]+):', 1) || ':' AS prefix FROM data_property WHERE regexp_matches(data_type, '^[A-Za-z0-9]+:')"


@query(
    f"""SELECT prefix, CASE rtrim(prefix, ':') WHEN 'cim' THEN 'http://iec.ch/TC57/2024/CIM-schema-cim17#' WHEN 'cin' THEN 'http://iec.ch/TC57/2024/CIM-schema-cim17#' WHEN 'eu' THEN 'http://iec.ch/TC57/NonStandard/UML#' WHEN 'rdf' THEN 'http://www.w3.org/1999/02/22-rdf-syntax-ns#' WHEN 'rdfs' THEN 'http://www.w3.org/2000/01/rdf-schema#'
    WHEN 'xsd' THEN 'http://www.w3.org/2001/XMLSchema#' WHEN 'owl' THEN 'http://www.w3.org/2002/07/owl#' WHEN 'sh' THEN 'http://www.w3.org/ns/shacl#' WHEN 'skos' THEN 'http://www.w3.org/2004/02/skos/core#' END AS iri FROM ({_PREFIXED})"""
)
def namespace_iris(spark: SparkSession, sf: str) -> DataFrame:
    """Prefixes in use with their namespaces; one alias is known."""
    x = table(spark, sf, "data_property").where(F.col("data_type").rlike("^[A-Za-z0-9]+:")).select(F.concat(F.regexp_extract("data_type", "^([A-Za-z0-9]+):", 1), F.lit(":")).alias("prefix")).distinct()
    return x.select("prefix", resolve.namespace_iri(F.col("prefix"), {"cin": "cim"}, strict=False).alias("iri"))


_EVENTS = "SELECT CASE WHEN event_type IN ('click', 'view') THEN 'counter' WHEN value >= 0 THEN 'histogram' ELSE 'gauge' END AS kind, event_type AS name, 'user=' || user_id % 5 AS labels, abs(value) + 1 AS value, ts, event_id FROM events"


@query(
    f"""SELECT kind, name, labels, CASE WHEN kind = 'histogram' THEN count(*) END AS count, CASE WHEN kind <> 'gauge' THEN sum(value) END AS sum, CASE WHEN kind = 'histogram' THEN min(value) END AS min,
    CASE WHEN kind = 'histogram' THEN max(value) END AS max, CASE WHEN kind = 'histogram' THEN avg(value) END AS mean, CASE WHEN kind = 'gauge' THEN last(value ORDER BY ts, event_id) END AS last FROM ({_EVENTS}) WHERE name IS NOT NULL AND value IS NOT NULL GROUP BY kind, name, labels"""
)
def metrics_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Events as metrics: counters, histograms and gauges by label."""
    kind = F.when(F.col("event_type").isin("click", "view"), "counter").when(F.col("value") >= 0, "histogram").otherwise("gauge")
    e = table(spark, sf, "events").select(kind.alias("kind"), F.col("event_type").alias("name"), F.create_map(F.lit("user"), (F.col("user_id") % 5).cast("string")).alias("labels"), (F.abs("value") + 1).alias("value"), F.struct("ts", "event_id").alias("ord"))
    return metrics.snapshot(e)


@query("SELECT user_id, event_type, last(event_id ORDER BY ts, event_id) AS event_id, last(value ORDER BY ts, event_id) AS value FROM events GROUP BY 1, 2")
def cache_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The last event of each user and type: an upsert log read back."""
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return resolve.last_by_key(e, ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")


_ENTRIES = "(SELECT DISTINCT case_id, source_table, package, raw_text, rule_attempt, uncertainty_reason, context_snippet FROM ocr_noise_samples)"
_CACHE = "(SELECT case_id, max(created_at) AS created_at, last(cleaned.value ORDER BY created_at, cleaned.value) AS response FROM ocr_noise_samples WHERE cleaned.value IS NOT NULL GROUP BY 1)"


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    x = table(spark, sf, "ocr_noise_samples").select("case_id", "source_table", "package", "raw_text", F.array_sort(F.map_entries("rule_attempt")).alias("r"), "uncertainty_reason", "context_snippet")
    return x.distinct().withColumn("r", F.map_from_entries("r")).withColumnRenamed("r", "rule_attempt")


def _cache(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "ocr_noise_samples").where("cleaned.value is not null").select("case_id", F.col("cleaned.value").alias("response"), "created_at")


@query(f"SELECT e.case_id, c.response IS NOT NULL AS hit, c.response FROM {_ENTRIES} e LEFT JOIN {_CACHE} c USING (case_id)")
def cache_split(spark: SparkSession, sf: str) -> DataFrame:
    """Entries with a cached response, and those to be asked."""
    hit, miss = review.split_by_cache(_entries(spark, sf), _cache(spark, sf))
    return hit.select("case_id", F.lit(True).alias("hit"), "response").unionByName(miss.select("case_id", F.lit(False).alias("hit"), F.lit(None).cast("string").alias("response")))


@query(f"SELECT package, case_id, ((row_number() OVER (PARTITION BY package ORDER BY case_id) - 1) // 14)::INT AS batch FROM {_ENTRIES}")
def batching(spark: SparkSession, sf: str) -> DataFrame:
    """Entries in batches of 14 within their packages."""
    return review.batches(_entries(spark, sf), 14, ["package"]).select("package", "case_id", "batch")


_ATTEMPT = "list_aggregate(list_transform(list_sort(map_entries(rule_attempt)), lambda e: e.key || '=' || coalesce(e.value, '')), 'string_agg', '; ')"
_ASK = f"'Package: ' || coalesce(package, '') || chr(10) || 'Table: ' || coalesce(source_table::VARCHAR, '') || chr(10) || 'Raw text: ' || coalesce(raw_text, '') || chr(10) || 'Reason: ' || coalesce(uncertainty_reason, '') || chr(10) || 'Context: ' || left(coalesce(context_snippet, ''), 200) || chr(10) || 'First attempt: ' || coalesce({_ATTEMPT}, '')"
_QUOTED = lambda s: "'" + s.replace("'", "''") + "'"


@query(
    f"""WITH b AS (SELECT *, ((row_number() OVER (PARTITION BY package ORDER BY case_id) - 1) // 14)::INT AS batch, {_ASK} AS q FROM {_ENTRIES})
    SELECT package, batch, count(*)::INT AS cases, string_agg(case_id, '|' ORDER BY case_id) AS batch_key, string_agg('case_id: ' || case_id || chr(10) || q, chr(10) || chr(10) ORDER BY case_id) || chr(10) || chr(10) || {_QUOTED(review.MANY)} AS prompt FROM b GROUP BY 1, 2"""
)
def batch_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return review.batch_prompts(review.batches(_entries(spark, sf), 14, ["package"]), ["package", "batch"])


_ANSWERS = """(SELECT case_id, raw_text, CASE WHEN category = 'typo' THEN 'no json' WHEN category = 'latex_artifact' THEN '[1]' WHEN category = 'case_error' THEN '{"corrected": {}, "confidence": 0.9}' ELSE '{"corrected": {"class_name": "' || raw_ok || '"}, "confidence": 0.8}' END AS response
    FROM (SELECT DISTINCT case_id, raw_text, category, regexp_replace(raw_text, '[^A-Za-z0-9]', '', 'g') AS raw_ok FROM ocr_noise_samples WHERE raw_text IS NOT NULL))"""


@query(
    f"""WITH a AS (SELECT *, CASE WHEN json_type(TRY_CAST(response AS JSON)) = 'OBJECT' THEN TRY_CAST(response AS JSON) END AS r FROM {_ANSWERS}), k AS (SELECT DISTINCT name FROM class_def)
    SELECT case_id, CASE WHEN r IS NULL THEN 'json_invalid' WHEN coalesce(r ->> '$.corrected.class_name', '') = '' THEN 'confirmed' WHEN k.name IS NOT NULL THEN 'corrected' ELSE 'business_invalid' END AS outcome, k.name AS corrected
    FROM a LEFT JOIN k ON k.name = r ->> '$.corrected.class_name'"""
)
def review_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What responses change: only objects count, and only names that are known."""
    x = table(spark, sf, "ocr_noise_samples").where("raw_text is not null").select("case_id", "raw_text", "category").distinct()
    ok = F.regexp_replace("raw_text", "[^A-Za-z0-9]", "")
    said = F.when(F.col("category") == "typo", "no json").when(F.col("category") == "latex_artifact", "[1]").when(F.col("category") == "case_error", '{"corrected": {}, "confidence": 0.9}').otherwise(F.concat(F.lit('{"corrected": {"class_name": "'), ok, F.lit('"}, "confidence": 0.8}')))
    return review.decided(x.withColumn("response", said), table(spark, sf, "class_def").select("name")).select("case_id", "outcome", "corrected")


@query("SELECT form, count(*) FILTER (side = 'b') AS files_before, count(*) FILTER (side = 'a') AS files_after, coalesce(sum(n) FILTER (side = 'b'), 0) AS bytes_before, coalesce(sum(n) FILTER (side = 'a'), 0) AS bytes_after FROM (SELECT 'b' AS side, source AS form, n_chars AS n FROM documents WHERE version = 1 UNION ALL SELECT 'a', source, n_chars FROM documents WHERE version > 1) GROUP BY 1")
def compared_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """First versions of documents against later ones, by source."""
    d = table(spark, sf, "documents").select(F.col("source").alias("form"), F.col("title").alias("path"), F.col("n_chars").alias("bytes"), "version")
    return consistency.compared_outputs(d.where("version = 1"), d.where("version > 1")).drop("files_delta", "bytes_delta")


@query("SELECT doc_id, 'urn:onto:' || doc_id AS s, unnest(['source', 'lang', 'title']) AS p, unnest([source, lang, title]) AS o FROM documents")
def unpivoted(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a table as subject, property and value."""
    d = table(spark, sf, "documents")
    pairs = F.array(*[F.struct(F.lit(c).alias("p"), F.col(c).alias("o")) for c in ("source", "lang", "title")])
    return d.select("doc_id", F.concat(F.lit("urn:onto:"), F.col("doc_id").cast("string")).alias("s"), F.inline(pairs))
