"""Queries on tokens of documents, and on semantic packages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import table
from ..operators import resolve
from ..sources import markdown
from .model_queries import MODEL_SQL, model
from .names_queries import STRIP, WS
from .names_queries import query as names_query
from .package import Packages
from .registry import Registry

query = Registry()


def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "md_token").where("content is not null").select(F.xxhash64("std_doc").alias("doc_id"), "std_doc", "tok_ord", "type", "level", "content")


@query("SELECT std_doc, tok_ord, type, sum((type = 'heading' AND level = 2)::INT) OVER (PARTITION BY std_doc ORDER BY tok_ord) AS section FROM (SELECT *, max(CASE WHEN type = 'heading' AND level = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY std_doc ORDER BY tok_ord) AS begun FROM md_token WHERE content IS NOT NULL) WHERE begun = 1")
def section_assign(spark: SparkSession, sf: str) -> DataFrame:
    """The section of each token: a running count of headings of level 2, what comes before the first left out."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("tok_ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = _tokens(spark, sf).withColumn("section", F.sum(((F.col("type") == "heading") & (F.col("level") == 2)).cast("int")).over(w))
    return x.where("section > 0").select("std_doc", "tok_ord", "type", "section")


_TITLE = rf"表{WS}*\p{{Nd}}+{WS}+[A-Z][A-Za-z0-9]*::[A-Z][A-Za-z0-9]+{WS}*的属性"
_PARSED = names_query.sql["heading_parts"].replace("SELECT sec_id, " + STRIP("heading") + " AS s FROM section_row", "SELECT tok_id AS sec_id, " + STRIP("content") + " AS s FROM md_token WHERE type = 'heading' AND level = 2 AND content IS NOT NULL")


@query(
    f"""WITH hp AS ({_PARSED}), k AS (SELECT * FROM md_token WHERE content IS NOT NULL),
    ev AS (SELECT std_doc, tok_ord, tok_id, 0 AS pos, content AS heading, true AS h2 FROM k WHERE type = 'heading' AND level = 2
      UNION ALL SELECT std_doc, tok_ord, tok_id, i, l[i], false FROM (SELECT *, regexp_extract_all(content, '(?:^|[^A-Za-z])({_TITLE})', 1) AS l FROM k WHERE type = 'paragraph'), unnest(range(1, len(l) + 1)) AS t(i)),
    o AS (SELECT ev.*, hp.path, hp.class_name AS own, hp.stereotype, count(*) FILTER (h2) OVER w AS g FROM ev LEFT JOIN hp ON ev.h2 AND hp.sec_id = ev.tok_id WINDOW w AS (PARTITION BY std_doc ORDER BY tok_ord, pos)),
    s AS (SELECT *, first(path) OVER v AS p, first(stereotype) OVER v AS st, row_number() OVER (PARTITION BY std_doc ORDER BY tok_ord, pos) - 1 AS sec_ord FROM o WHERE g > 0 WINDOW v AS (PARTITION BY std_doc, g ORDER BY tok_ord, pos))
    SELECT std_doc, sec_ord, p AS path, heading, CASE WHEN h2 THEN own ELSE regexp_extract(heading, '::([A-Z][A-Za-z0-9]+)', 1) END AS class_name, st AS stereotype, CASE WHEN NOT h2 THEN regexp_extract(heading, '([A-Z][A-Za-z0-9]*)::', 1) END AS package FROM s
    UNION ALL SELECT std_doc, 0, '0', '', NULL, NULL, NULL FROM k GROUP BY std_doc HAVING count(*) FILTER (type = 'heading' AND level = 2) = 0"""
)
def md_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Sections of all documents, those that titles of tables begin among them."""
    t = _tokens(spark, sf)
    found, _ = markdown.sections(t)
    return found.join(t.select("doc_id", "std_doc").distinct(), "doc_id").drop("doc_id")


@query(
    f"""WITH l AS (SELECT tok_id, list_filter(list_transform(string_split(content, chr(10)), lambda x: {STRIP("x")}), lambda x: x <> '' AND NOT regexp_full_match(replace(x, '|', ''), '[-:]+')) AS x FROM md_token WHERE type = 'table' AND content <> '')
    SELECT tok_id, len(x) - 1 AS n_rows, len(string_split(x[1], '|')) AS n_cols FROM l WHERE len(x) > 0"""
)
def md_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and columns of every table."""
    t = table(spark, sf, "md_token").where("type = 'table' and content <> ''")
    x = t.select(F.col("tok_id").alias("doc_id"), F.lit(0).alias("sec_ord"), "tok_ord", "type", "content")
    return markdown.tables(x).select(F.col("doc_id").alias("tok_id"), F.size("rows").alias("n_rows"), F.size("headers").alias("n_cols"))


def _as_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """One document of each row of ``class_def``'s package: a section a class with the table of its attributes."""
    a = table(spark, sf, "data_property").select("class_id", "attr_id", "attr_ord", "name", "data_type", F.col("multiplicity.raw").alias("raw"), "inherited_from").distinct()
    line = F.concat_ws(" | ", F.coalesce("name", F.lit("")), F.coalesce("raw", F.lit("")), F.coalesce("data_type", F.lit("")), F.concat(F.lit("继承自："), F.coalesce("inherited_from", F.lit("-"))))
    rows = a.groupBy("class_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("attr_ord", "attr_id", F.concat(F.lit("| "), F.regexp_replace(line, r"[\r\n]+", " "), F.lit(" |")).alias("l")))), lambda r: r["l"]), "\n").alias("rows"))
    c = table(spark, sf, "class_def").select("class_id", "package", "name", "stereotype").distinct().join(rows, "class_id", "left")
    head = F.concat(F.lit("## 1."), F.col("class_id").cast("string"), F.lit(" Class: "), "name", F.coalesce(F.concat(F.lit(" ("), F.nullif("stereotype", F.lit("")), F.lit(")")), F.lit("")))
    text = F.concat(head, F.lit("\n\n| 名字 | 重数 | 类型 | 描述 |\n|---|---|---|---|\n"), F.coalesce("rows", F.lit("")), F.lit("\n"))
    salt = F.floor(F.col("class_id") / 50)  # documents of bounded length
    return c.groupBy(F.xxhash64("package", salt).alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("class_id", text.alias("t")))), lambda r: r["t"]), "\n").alias("text"))


@query("SELECT name, CASE WHEN stereotype <> '' THEN stereotype END AS stereotype, coalesce(n, 0) AS n_attributes FROM (SELECT DISTINCT class_id, name, stereotype FROM class_def) LEFT JOIN (SELECT class_id, count(*) AS n FROM (SELECT DISTINCT class_id, attr_id FROM data_property) GROUP BY 1) USING (class_id)")
def ingested_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The classes read back from documents written of all of them, with their attributes counted."""
    m, _ = markdown.model(_as_markdown(spark, sf), keep_empty=True)
    key = ["doc_id", "pkg_ord", "cls_ord"]
    n = m.attribute.groupBy(*key).agg(F.count("*").alias("n_attributes"))
    return m.classes.join(n, key, "left").select("name", "stereotype", F.coalesce("n_attributes", F.lit(0)).alias("n_attributes"))


_SEEDS = "(VALUES " + ", ".join(f"('{s}')" for s in resolve.SEED_CLASSES) + ") AS k(name)"
_FIXED = ", ".join(f"'{s}'" for s in [*resolve.SEED_CLASSES, *resolve.CORRECTIONS])


@query(
    f"""WITH n AS (SELECT class_id, regexp_extract(name, '^([A-Za-z0-9_]+)', 1) AS w FROM (SELECT DISTINCT class_id, package, name, stereotype FROM class_def)), d AS (SELECT w, min(levenshtein(w, k.name)) AS d FROM (SELECT DISTINCT w FROM n), {_SEEDS} GROUP BY 1)
    SELECT 'A.' || class_id || '::' || w AS case_id, 'Core' AS package, w AS raw_text, CASE WHEN d <= 2 THEN 'possible_typo' ELSE 'class_unknown' END AS uncertainty_reason, 'A.' || class_id || '（' || w || '）' AS context_snippet FROM n JOIN d USING (w) WHERE regexp_full_match(w, '[A-Za-z][A-Za-z0-9_]+') AND w NOT IN ({_FIXED})"""
)
def md_uncertain(spark: SparkSession, sf: str) -> DataFrame:
    """Entries to be reviewed, of documents whose sections are not numbered."""
    docs = _as_markdown(spark, sf).withColumn("text", F.regexp_replace("text", r"(?m)^## 1\.(\d+) Class: (\w+).*$", "## A.$1（$2）"))
    return markdown.model(docs)[1].drop("doc_id")


def _packages(spark: SparkSession, sf: str) -> Packages:
    return Packages(model(spark, sf), check=False)


_PKG = MODEL_SQL + ", p AS (SELECT doc_id, pkg_ord, n.package_id AS package_id, rtrim(n.iri, '/') || '/' AS ns FROM pk WHERE trim(n.package_id) <> '')"


@query(_PKG + " SELECT doc_id, p.package_id || '.' || name AS id, name, ns || name AS iri, n.description AS description FROM cl JOIN p USING (doc_id, pkg_ord)")
def package_entities(spark: SparkSession, sf: str) -> DataFrame:
    return _packages(spark, sf).entities().select("doc_id", "id", "name", "iri", "description")


@query(
    _PKG
    + """ SELECT doc_id, package_id || '.' || name AS id, package_id || '.' || holder AS entity_id, CASE n.data_type WHEN 'xsd:integer' THEN 'integer' WHEN 'xsd:int' THEN 'integer' WHEN 'xsd:float' THEN 'decimal' WHEN 'xsd:double' THEN 'decimal' WHEN 'xsd:decimal' THEN 'decimal' WHEN 'xsd:boolean' THEN 'boolean' WHEN 'xsd:date' THEN 'date' WHEN 'xsd:dateTime' THEN 'datetime' ELSE 'string' END AS type,
    coalesce(nullif(n.data_type, ''), 'xsd:string') AS xsd, coalesce(n.required, false) AS required, CASE WHEN trim(n.multiplicity.raw) <> '' THEN n.multiplicity.raw ELSE '0..1' END AS multiplicity FROM atr JOIN p USING (doc_id, pkg_ord)"""
)
def package_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return _packages(spark, sf).attributes().select("doc_id", "id", "entity_id", "type", "xsd", "required", "multiplicity")


@query(_PKG + ", f AS (SELECT doc_id, package, arg_min({'i': n.package_id}, pkg_ord).i AS to_id FROM pk WHERE package IS NOT NULL GROUP BY ALL) SELECT s.doc_id, p.package_id || '.' || s.name AS id, p.package_id || '.' || s.holder AS entity_id, CASE WHEN f.to_id IS NOT NULL AND s.class_name IS NOT NULL THEN f.to_id || '.' || s.class_name END AS target_id, CASE WHEN trim(s.n.multiplicity.raw) <> '' THEN s.n.multiplicity.raw ELSE '0..1' END AS multiplicity FROM sc s JOIN p USING (doc_id, pkg_ord) LEFT JOIN f ON f.doc_id = s.doc_id AND f.package = s.n.target.package")
def package_relations(spark: SparkSession, sf: str) -> DataFrame:
    return _packages(spark, sf).relations().select("doc_id", "id", "entity_id", "target_id", "multiplicity")


_SLUGGED = ", s AS (SELECT p.*, pk.n.version AS version, regexp_replace(regexp_replace(lower(regexp_replace(p.package_id, '[^A-Za-z0-9]+', '-', 'g')), '^-+', ''), '-+$', '') AS slug FROM p JOIN pk USING (doc_id, pkg_ord))"


@query(
    _PKG
    + _SLUGGED
    + """, f AS (SELECT doc_id, pkg_ord, package_id, slug, version, unnest(['manifest.yaml', 'README.md', 'semantic-model/entities.yaml', 'semantic-model/attributes.yaml', 'semantic-model/relations.yaml', 'ontology/' || slug || '.owl', 'jsonld/' || slug || '-context.jsonld', 'jsonschema/' || slug || '.schema.json', 'python/' || replace(slug, '-', '_') || '_types.py', 'mappings/mapping-template.yaml', 'tests/package-cts.yaml']) AS path FROM s
    UNION ALL SELECT doc_id, pkg_ord, package_id, slug, version, 'semantic-model/enumerations.yaml' FROM s WHERE EXISTS (FROM pk WHERE pk.doc_id = s.doc_id AND pk.pkg_ord = s.pkg_ord AND len(list_filter(pk.n.enumerations, lambda e: e IS NOT NULL)) > 0)
    UNION ALL SELECT doc_id, pkg_ord, package_id, slug, version, unnest(['constraints/' || slug || '.shacl', 'examples/' || slug || '-instance.jsonld']) FROM s WHERE EXISTS (FROM cl WHERE cl.doc_id = s.doc_id AND cl.pkg_ord = s.pkg_ord AND cl.name IS NOT NULL))
    SELECT doc_id, package_id, slug || '-' || coalesce(version, '0.1.0') || '/' || path AS path, true AS readable FROM f"""
)
def package_files(spark: SparkSession, sf: str) -> DataFrame:
    """All files of all packages, and whether those in JSON can be read."""
    f = _packages(spark, sf).files()
    json = F.col("path").rlike(r"\.(yaml|jsonld|json)$")
    return f.select("doc_id", "package_id", "path", (F.col("content").isNotNull() & (~json | F.try_parse_json("content").isNotNull())).alias("readable"))
