"""Queries that drive further operators over whole tables: kinds and columns of tables, packages, corrections, review and files read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..frames import folder, table
from ..functions import headings as H
from ..functions import names as N
from ..operators import review
from ..plans import emit
from ..sources import markdown, models
from ..sources.providers import Fixed
from .data_queries import _CACHE, _ENTRIES, _cache, _entries
from .document_queries import _PKG, _packages
from .model_queries import _BLANK, MODEL_SQL, TIDY_SQL, model
from .names_queries import STRIP
from .registry import Registry

query = Registry()

# The header of every table, as md_tables reads it: cells without tags, in lower case.
_HEADS = f"""WITH l AS (SELECT tok_id, list_filter(list_transform(string_split(content, chr(10)), lambda x: {STRIP("x")}), lambda x: x <> '' AND NOT regexp_full_match(replace(x, '|', ''), '[-:]+')) AS x FROM md_token WHERE type = 'table' AND content <> ''),
h AS (SELECT tok_id, list_transform(string_split(x[1], '|'), lambda c: {STRIP("regexp_replace(c, '<[^>]*>', '', 'g')")}) AS h FROM l WHERE len(x) > 0), k AS (SELECT tok_id, h, list_transform(h, lambda c: lower(c)) AS low, lower(h[1]) AS f FROM h)"""
_HAS = lambda *w: "len(list_filter(low, lambda c: " + " OR ".join(f"contains(c, '{x}')" for x in w) + ")) > 0"
_FIRST = lambda *w: "(" + " OR ".join(f"contains(f, '{x}')" for x in w) + ")"


def _headers(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "md_token").where("type = 'table' and content <> ''")
    return markdown.tables(t.select(F.col("tok_id").alias("doc_id"), F.lit(0).alias("sec_ord"), "tok_ord", "type", "content"))


@query(
    _HEADS
    + f""" SELECT tok_id, CASE WHEN {_FIRST("属性", "property", "attribute")} OR f IN ('名字', '名称', 'name', '属性名', '字段') OR ({_FIRST("名字", "名称")} AND {_HAS("类型", "重数")}) THEN 'property' WHEN {_FIRST("关联端", "association", "关联")} OR contains(f, '重数自') OR {_HAS("重数到")} OR (len(h) = 4 AND contains(f, '重数') AND {_HAS("目标", "target")}) THEN 'association'
    WHEN {_FIRST("字面量", "literal", "枚举")} THEN 'enumeration' WHEN {_FIRST("继承", "父类", "super")} THEN 'inheritance' ELSE 'unknown' END AS kind FROM k"""
)
def table_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """What each table holds, by its headers."""
    return _headers(spark, sf).select(F.col("doc_id").alias("tok_id"), "kind")


_NOISY = "regexp_matches({0}, '\\$|\\\\|\\^\\s*\\{{')".format
_PLACE = lambda w: f"nullif(list_position(h, '{w}'), 0) - 1, list_filter(list_transform(range(len(h)), lambda i: CASE WHEN contains(h[i + 1], '{w}') AND NOT {_NOISY('h[i + 1]')} THEN i END), lambda i: i IS NOT NULL)[1]"


@query(_HEADS + " SELECT tok_id, coalesce(" + ", ".join(map(_PLACE, ["名字", "名称", "name", "property", "属性"])) + ")::INT AS name_at, coalesce(" + ", ".join(map(_PLACE, ["类型", "type"])) + ")::INT AS type_at FROM k")
def table_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Where each table has its names and types: a header that equals a keyword, else one without noise that contains it."""
    at = lambda c: markdown.column(F.col("headers"), markdown.COLUMNS["property"][c])
    return _headers(spark, sf).select(F.col("doc_id").alias("tok_id"), at("name").cast("int").alias("name_at"), at("type").cast("int").alias("type_at"))


@query(_HEADS + f" SELECT tok_id, len(list_filter(h, lambda c: {_NOISY('c')}))::INT AS noisy FROM k")
def noisy_headers(spark: SparkSession, sf: str) -> DataFrame:
    """How many headers of each table are noise."""
    return _headers(spark, sf).select(F.col("doc_id").alias("tok_id"), F.size(F.filter("headers", N.is_noisy_header)).alias("noisy"))


@query("SELECT DISTINCT attr_id, inherited_from FROM data_property WHERE inherited_from IS NOT NULL AND regexp_full_match(inherited_from, '[A-Z][A-Za-z0-9]+')")
def inherited_from(spark: SparkSession, sf: str) -> DataFrame:
    """The class that a description says an attribute comes from."""
    x = table(spark, sf, "data_property").where(F.col("inherited_from").isNotNull()).select("attr_id", F.concat(F.lit("说明，继承 自 ："), "inherited_from", F.lit("。")).alias("d")).distinct()
    return x.select("attr_id", H.inherited_from(F.col("d")).alias("inherited_from")).where("inherited_from is not null")


@query("SELECT class_id, list_aggregate(list_transform(a, lambda x: coalesce(x.n, '') || '|' || coalesce(x.t, '')), 'string_agg', chr(10)) AS rows FROM (SELECT class_id, list({'o': attr_ord, 'i': attr_id, 'n': name, 't': data_type} ORDER BY attr_ord, attr_id) AS a FROM (SELECT DISTINCT class_id, attr_ord, attr_id, " + STRIP("regexp_replace(name, '[<>]|" + r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+" + "', ' ', 'g')") + " AS name, " + STRIP("regexp_replace(data_type, '[<>]|" + r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+" + "', ' ', 'g')") + " AS data_type FROM data_property) GROUP BY 1)")
def html_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables of attributes written as HTML and read again."""
    clean = lambda c: F.coalesce(N.strip(F.regexp_replace(c, r"(?U)[<>]|\s+", " ")), F.lit(""))
    a = table(spark, sf, "data_property").select("class_id", "attr_ord", "attr_id", clean(F.col("name")).alias("n"), clean(F.col("data_type")).alias("t")).distinct()
    row = F.concat(F.lit("<TR><td class='n'><b>"), "n", F.lit("</b></td>\n<th> "), "t", F.lit(" </th></tr>"))
    x = a.groupBy("class_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("attr_ord", "attr_id", row.alias("r")))), lambda v: v["r"]), "\n").alias("rows"))
    return x.select("class_id", H.html_table(F.concat(F.lit("text <table border=1>"), "rows", F.lit("<tr></tr></table> after"))).alias("rows"))


@query(_PKG + ", f AS (SELECT doc_id, package, arg_min({'i': n.package_id}, pkg_ord).i AS to_id FROM pk WHERE package IS NOT NULL GROUP BY ALL), r AS (SELECT doc_id, pkg_ord, package AS to_package FROM pa WHERE class_name IS NOT NULL UNION SELECT doc_id, pkg_ord, n.target.package FROM sc), d AS (SELECT r.doc_id, r.pkg_ord, f.to_id FROM r JOIN f ON f.doc_id = r.doc_id AND f.package = r.to_package) SELECT p.doc_id, p.package_id, coalesce(string_agg(DISTINCT to_id, ', ' ORDER BY to_id) FILTER (to_id <> p.package_id), '') AS dependencies FROM p LEFT JOIN d USING (doc_id, pkg_ord) GROUP BY p.doc_id, p.pkg_ord, p.package_id")
def package_dependencies(spark: SparkSession, sf: str) -> DataFrame:
    """The ids of the packages that each package's references lead to."""
    return _packages(spark, sf).dependencies().select("doc_id", "package_id", F.array_join("dependencies", ", ").alias("dependencies"))


@query(_PKG + ", e AS (SELECT doc_id, pkg_ord, (i - 1)::INT AS enum_ord, n.enumerations[i] AS n FROM pk, unnest(range(1, len(n.enumerations) + 1)) AS t(i) WHERE n.enumerations[i] IS NOT NULL) SELECT doc_id, enum_ord, concat_ws('.', package_id, e.n.name) AS id, len(e.n.values)::INT AS n_values, list_aggregate(e.n.values, 'string_agg', '|') AS labels FROM e JOIN p USING (doc_id, pkg_ord)")
def package_enumerations(spark: SparkSession, sf: str) -> DataFrame:
    x = _packages(spark, sf).enumerations()
    return x.select("doc_id", "enum_ord", "id", F.when(F.col("values").isNotNull(), F.size("values")).alias("n_values"), F.nullif(F.array_join(F.transform("values", lambda v: v["label"]), "|"), F.lit("")).alias("labels"))


_CASES = "[{'i': 'CTS-TP-001', 'n': 'Package Metadata', 'c': 2, 't': 'manifest.yaml exists; manifest.yaml schema valid'}, {'i': 'CTS-TP-004', 'n': 'Artifact Generation', 'c': 4, 't': 'OWL file exists and parses; SHACL file exists and parses; JSON-LD context exists and parses; JSON Schema exists and validates example'}, {'i': 'CTS-TP-005', 'n': 'Runtime Loading', 'c': 3, 't': 'Package loads without error; All classes have IRI; All relations resolve target'}]"


@query(
    _PKG
    + f""" SELECT doc_id, p.pkg_ord, c.i AS case_id, c.n AS name, c.c::INT AS checks, c.t AS "check" FROM p, (SELECT unnest({_CASES}) AS c)
    UNION ALL SELECT doc_id, pkg_ord, 'CTS-TP-002', 'Entity Completeness', count(cl.cls_ord)::INT, coalesce(string_agg(cl.name || ' exists', '; ' ORDER BY cls_ord), '') FROM p LEFT JOIN cl USING (doc_id, pkg_ord) GROUP BY ALL UNION ALL SELECT doc_id, pkg_ord, 'CTS-TP-003', 'Relation Integrity', count(sc.ord)::INT, coalesce(string_agg(concat_ws(' ', holder, sc.name, class_name), '; ' ORDER BY cls_ord, ord) FILTER (sc.ord IS NOT NULL), '') FROM p LEFT JOIN sc USING (doc_id, pkg_ord) GROUP BY ALL"""
)
def package_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The checks of each conformance case of each package."""
    return _packages(spark, sf).checks().select("doc_id", "pkg_ord", "case_id", "name", F.size("check").alias("checks"), F.array_join("check", "; ").alias("check"))


@query(TIDY_SQL + f", og AS (SELECT doc_id, cname FROM md WHERE NOT {_BLANK} GROUP BY ALL), ix AS (SELECT doc_id, name, arg_max(cname, canon * 100000 + place) AS of FROM md JOIN og USING (doc_id, cname) WHERE name IS NOT NULL GROUP BY ALL)" + """,
    ks AS (SELECT doc_id, pkg_ord, cls_ord, cname FROM md JOIN og USING (doc_id, cname)), rf AS (SELECT doc_id, ks.cname AS own, class_name FROM pa JOIN ks USING (doc_id, pkg_ord, cls_ord) WHERE holder IS NOT NULL UNION SELECT doc_id, ks.cname, class_name FROM sc JOIN ks USING (doc_id, pkg_ord, cls_ord) WHERE holder IS NOT NULL)
    SELECT DISTINCT rf.doc_id, rf.own AS package, ix.of AS imported FROM rf JOIN ix ON ix.doc_id = rf.doc_id AND ix.name = rf.class_name WHERE rf.class_name <> '' AND rf.own <> ix.of""")
def owl_imports(spark: SparkSession, sf: str) -> DataFrame:
    """The packages that each emitted graph imports."""
    from ..operators import triples

    start = len(triples.NS) + 1
    x = triples.match(emit.owl_graphs(model(spark, sf)), p=triples.OWL + "imports")
    return x.select("doc_id", F.col("graph").alias("package"), F.substring("o", start, 2**31 - 1).alias("imported")).distinct()


@query(f"SELECT e.case_id, CASE WHEN c.response IS NULL THEN 'confirmed' WHEN json_type(TRY_CAST(c.response AS JSON)) = 'OBJECT' THEN 'confirmed' ELSE 'json_invalid' END AS outcome FROM {_ENTRIES} e LEFT JOIN {_CACHE} c USING (case_id)")
def reviewed_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries reviewed one by one: cached responses, which are no JSON, and a reviewer who confirms the rest."""
    known = table(spark, sf, "class_def").select("name")
    return review.reviewed(_entries(spark, sf), _cache(spark, sf), Fixed('{"corrected": {}, "confidence": 0.9}'), known)[0].select("case_id", "outcome")


@query(f"SELECT e.case_id, CASE WHEN c.response IS NULL OR json_type(TRY_CAST(c.response AS JSON)) IS NULL OR json_type(TRY_CAST(c.response AS JSON)) <> 'OBJECT' THEN CASE WHEN c.response IS NULL THEN 'missing_entry' ELSE 'json_invalid' END ELSE 'confirmed' END AS outcome FROM {_ENTRIES} e LEFT JOIN {_CACHE} c USING (case_id)")
def reviewed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Entries reviewed in batches by a reviewer who answers another case only: each entry that isn't cached is missing in its answer."""
    known = table(spark, sf, "class_def").select("name")
    return review.reviewed_in_batches(_entries(spark, sf), _cache(spark, sf), Fixed('[{"case_id": "another", "corrected": {}}]'), known)[0].select("case_id", "outcome")


@query(MODEL_SQL + ", w AS (SELECT doc_id, name, max({'p': pkg_ord, 'c': cls_ord}) AS k FROM cl WHERE name IS NOT NULL GROUP BY ALL) SELECT cl.doc_id, pkg_ord, cls_ord, CASE WHEN w.k IS NOT NULL THEN 'New' || cl.name ELSE cl.name END AS name FROM cl LEFT JOIN w ON w.doc_id = cl.doc_id AND w.name = cl.name AND w.k.p = pkg_ord AND w.k.c = cls_ord")
def corrected_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The classes after a correction of every name: the last class of a name in each document is renamed."""
    m = model(spark, sf)
    fix = m.classes.where("name is not null").select("doc_id", F.col("name").alias("raw_text"), F.concat(F.lit("New"), "name").alias("corrected"), F.lit("1").alias("case_id")).distinct()
    return review.corrected_classes(m.classes, fix).select("doc_id", "pkg_ord", "cls_ord", "name")


@query("SELECT e.case_id, coalesce((SELECT 'inside ' || min(label) FROM canon_entry WHERE label IS NOT NULL AND contains(e.raw_text, label) AND label <> ''), 'default') AS response FROM (SELECT DISTINCT case_id, raw_text FROM ocr_noise_samples) e")
def fixture_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Responses of fixtures named after the canonical labels, by what stands in the entries."""
    labels = table(spark, sf, "canon_entry").where("label <> ''").select(F.col("label").alias("stem"), F.concat(F.lit("inside "), "label").alias("body")).distinct()
    fixtures = labels.unionByName(spark.createDataFrame([("default", "default")], "stem string, body string"))
    return review.fixture_responses(table(spark, sf, "ocr_noise_samples").select("case_id", "raw_text").distinct(), fixtures)


@query(f"SELECT DISTINCT {STRIP('name')} AS name FROM class_def WHERE coalesce({STRIP('name')}, '') <> '' AND NOT starts_with({STRIP('name')}, '#')")
def known_list(spark: SparkSession, sf: str) -> DataFrame:
    """Class names written as a list and read again."""
    path = folder(spark)
    lines = table(spark, sf, "class_def").where("name is not null").select(F.concat(F.lit(" "), F.regexp_replace("name", r"[\r\n]+", " "), F.lit("\t")).alias("value"))
    lines.unionAll(spark.createDataFrame([("# a remark",), ("",)], "value string")).write.text(path)
    return models.known_classes(spark, path)


@query(MODEL_SQL + " SELECT doc_id, count(*) AS package_count, coalesce(any_value(c), 0) AS class_count, coalesce(any_value(a), 0) AS attribute_count, coalesce(any_value(s), 0) AS association_count FROM pk LEFT JOIN (SELECT doc_id, count(*) AS c FROM cl GROUP BY 1) USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS a FROM atr GROUP BY 1) USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS s FROM sc GROUP BY 1) USING (doc_id) GROUP BY 1")
def ir_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """The model written as IR documents, one file each, and read again: its counts."""
    path = folder(spark)
    sinks.write_files(models.ir_json(model(spark, sf)).withColumn("path", F.concat(F.col("doc_id").cast("string"), F.lit(".json"))), path.removeprefix("file:")).count()
    own = spark.read.text(path, wholetext=True).select(F.xxhash64(F.input_file_name()).alias("hash"), F.regexp_extract(F.input_file_name(), r"(-?\d+)\.json$", 1).cast("bigint").alias("id"))
    return models.ir_documents(spark, path).stats().join(own, F.col("doc_id") == F.col("hash")).drop("doc_id", "hash").withColumnRenamed("id", "doc_id")
