"""Queries on the nested model of ``ontology_ir``, each document on its own, and on the classes of ``class_def``."""

from __future__ import annotations

import re
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import frames
from ..frames import table
from ..operators import consistency, graph, resolve, triples
from . import emit
from .model import Model, nested
from .names_queries import _FORMAT, _JSON, _NORM, _RANGE, NOISE, STRIP
from .registry import Registry

query = Registry()
MODEL_SQL = """WITH RECURSIVE
pk AS (SELECT ir_id AS doc_id, (i - 1)::INT AS pkg_ord, packages[i] AS n, packages[i].name AS package FROM ontology_ir, unnest(range(1, len(packages) + 1)) AS t(i) WHERE packages[i] IS NOT NULL),
cl AS (SELECT doc_id, pkg_ord, package, (i - 1)::INT AS cls_ord, n.classes[i] AS n, n.classes[i].name AS name FROM pk, unnest(range(1, len(n.classes) + 1)) AS t(i) WHERE n.classes[i] IS NOT NULL),
pa AS (SELECT doc_id, pkg_ord, cls_ord, package AS own, name AS holder, (i - 1)::INT AS ord, n.parents[i].package AS package, n.parents[i].class_name AS class_name FROM cl, unnest(range(1, len(n.parents) + 1)) AS t(i) WHERE n.parents[i] IS NOT NULL),
atr AS (SELECT doc_id, pkg_ord, cls_ord, package AS own, name AS holder, (i - 1)::INT AS ord, n.attributes[i] AS n, n.attributes[i].name AS name FROM cl, unnest(range(1, len(n.attributes) + 1)) AS t(i) WHERE n.attributes[i] IS NOT NULL),
sc AS (SELECT doc_id, pkg_ord, cls_ord, package AS own, name AS holder, (i - 1)::INT AS ord, n.associations[i] AS n, n.associations[i].name AS name, n.associations[i].target.class_name AS class_name FROM cl, unnest(range(1, len(n.associations) + 1)) AS t(i) WHERE n.associations[i] IS NOT NULL)"""

CORPUS_SQL = MODEL_SQL.replace("ir_id AS doc_id, (i - 1)::INT AS pkg_ord", "0::BIGINT AS doc_id, ir_id * 1048576 + (i - 1) AS pkg_ord")


def model(spark: SparkSession, sf: str) -> Model:
    return nested(table(spark, sf, "ontology_ir"))


def corpus(spark: SparkSession, sf: str) -> Model:
    """All documents as one, whose packages and classes repeat."""
    return model(spark, sf).corpus()


@query(
    MODEL_SQL
    + """ SELECT doc_id, count(*) AS package_count, coalesce(any_value(c), 0) AS class_count, coalesce(any_value(a), 0) AS attribute_count, coalesce(any_value(s), 0) AS association_count FROM pk
    LEFT JOIN (SELECT doc_id, count(*) AS c FROM cl GROUP BY 1) USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS a FROM atr GROUP BY 1) USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS s FROM sc GROUP BY 1) USING (doc_id) GROUP BY 1"""
)
def ir_stats(spark: SparkSession, sf: str) -> DataFrame:
    return model(spark, sf).stats()


@query("SELECT coalesce(nullif(package, ''), 'Core') AS package, count(*) AS n_classes, min(class_id) AS first_id FROM (SELECT DISTINCT class_id, package FROM class_def) GROUP BY 1")
def classes_by_package(spark: SparkSession, sf: str) -> DataFrame:
    """Classes grouped by package; those without one go to Core."""
    x = table(spark, sf, "class_def").select("class_id", "package").distinct()
    return x.groupBy(F.coalesce(F.nullif("package", F.lit("")), F.lit("Core")).alias("package")).agg(F.count("*").alias("n_classes"), F.min("class_id").alias("first_id"))


@query(MODEL_SQL + " SELECT doc_id, name, pkg_ord, cls_ord, description FROM (SELECT *, n.description AS description, row_number() OVER (PARTITION BY doc_id, name ORDER BY pkg_ord, cls_ord) AS r FROM cl) WHERE r = 1 AND name IS NOT NULL")
def first_class(spark: SparkSession, sf: str) -> DataFrame:
    """Lookup of classes by name: the first one of each name in each document."""
    return model(spark, sf).first_classes().select("doc_id", "name", "pkg_ord", "cls_ord", "description")


_WANTED = STRIP("class_name")


_TARGETS = (
    CORPUS_SQL
    + f""", k AS (SELECT DISTINCT doc_id, name FROM cl WHERE name IS NOT NULL), s AS (SELECT *, {_WANTED} AS w FROM sc),
    m AS (SELECT s.doc_id, s.w, count(*) AS fits, min(k.name) AS single FROM (SELECT DISTINCT doc_id, w FROM s WHERE w <> '') s JOIN k ON k.doc_id = s.doc_id AND suffix(k.name, s.w) AND k.name <> s.w GROUP BY ALL)
    SELECT s.doc_id, s.pkg_ord, s.cls_ord, s.ord AS assoc_ord, CASE WHEN coalesce(s.w, '') = '' OR NOT regexp_matches(s.w, '[\\x00-\\x7f]') OR regexp_matches(s.w, '^[-:|]*-[-:|]*$|^\\d+\\.\\.|^\\p{{Nd}}+$|[：—（]') THEN 'noise_dropped' WHEN k.name IS NOT NULL THEN 'kept_exact' WHEN fits = 1 THEN 'fuzzy_resolved' WHEN fits > 1 THEN 'ambiguous_kept' ELSE 'unresolved_kept' END AS outcome,
    CASE WHEN coalesce(s.w, '') = '' OR NOT regexp_matches(s.w, '[\\x00-\\x7f]') OR regexp_matches(s.w, '^[-:|]*-[-:|]*$|^\\d+\\.\\.|^\\p{{Nd}}+$|[：—（]') THEN NULL WHEN k.name IS NULL AND fits = 1 THEN single ELSE s.class_name END AS class_name
    FROM s LEFT JOIN k ON k.doc_id = s.doc_id AND k.name = s.w LEFT JOIN m ON m.doc_id = s.doc_id AND m.w = s.w"""
)


@query(_TARGETS)
def resolved_targets(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolved_targets(corpus(spark, sf)).select("doc_id", "pkg_ord", "cls_ord", "assoc_ord", "outcome", "class_name")


@query("SELECT " + ", ".join(f"count_if(outcome = '{k}') AS {k}" for k in ("noise_dropped", "kept_exact", "fuzzy_resolved", "ambiguous_kept", "unresolved_kept")) + f" FROM ({_TARGETS})")
def target_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many targets are kept, repaired or dropped."""
    return resolve.target_counts(resolve.resolved_targets(corpus(spark, sf)))


@query("SELECT w AS short, count(*) AS fits, min(name) AS single FROM (SELECT DISTINCT name FROM class_def WHERE name IS NOT NULL) k JOIN (SELECT DISTINCT substr(class_name, 4) AS w FROM class_ref WHERE length(class_name) > 3 UNION SELECT class_name FROM class_ref WHERE class_name <> '') s ON suffix(k.name, s.w) AND k.name <> s.w GROUP BY 1")
def suffix_repair(spark: SparkSession, sf: str) -> DataFrame:
    """The known names that end with each name referred to, as it stands and without its first three letters, which scans lose."""
    k = table(spark, sf, "class_def").select("name")
    r = table(spark, sf, "class_ref").select("class_name")
    s = r.union(r.select(F.expr("substring(class_name, 4)"))).select(F.col("class_name").alias("wanted"))
    return resolve.ending_with(s, k).withColumnsRenamed({"wanted": "short", "only": "single"})


@query(
    CORPUS_SQL
    + """, ix AS (SELECT doc_id, name, arg_max(package, pkg_ord * 100000 + cls_ord) AS to_package FROM cl WHERE name IS NOT NULL GROUP BY ALL),
    r AS (SELECT doc_id, pkg_ord, cls_ord, 0 AS phase, ord, own, class_name, 'parent:' || holder AS via FROM pa WHERE holder IS NOT NULL UNION ALL SELECT doc_id, pkg_ord, cls_ord, 1, ord, own, class_name, name FROM sc WHERE holder IS NOT NULL)
    SELECT doc_id, own AS from_package, to_package, class_name AS via_class, last(via ORDER BY pkg_ord, cls_ord, phase, ord) AS via_property FROM r JOIN ix ON ix.doc_id = r.doc_id AND ix.name = r.class_name WHERE class_name <> '' AND own <> to_package GROUP BY ALL""".replace("SELECT doc_id, own AS from_package", "SELECT r.doc_id, own AS from_package")
)
def cross_package_refs(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.cross_package_refs(corpus(spark, sf))


_RICHEST = (
    CORPUS_SQL
    + """, q AS (SELECT doc_id, name, pkg_ord, cls_ord, len(list_filter(n.attributes, lambda x: x IS NOT NULL)) AS n_attr, len(list_filter(n.associations, lambda x: x IS NOT NULL)) AS n_assoc, len(list_filter(n.parents, lambda x: x IS NOT NULL)) AS n_parent, """
    + f"coalesce({STRIP('n.description')}, '') <> '' AS d FROM cl WHERE name IS NOT NULL), "
    + """w AS (SELECT doc_id, name, pkg_ord, cls_ord, coalesce(n_attr, 0) AS n_attr, coalesce(n_assoc, 0) AS n_assoc, coalesce(n_parent, 0) AS n_parent, row_number() OVER (PARTITION BY doc_id, name ORDER BY coalesce(n_attr, 0) DESC, coalesce(n_assoc, 0) DESC, coalesce(n_parent, 0) DESC, d DESC, pkg_ord, cls_ord) AS r, count(*) OVER (PARTITION BY doc_id, name) AS copies FROM q)"""
)


@query(_RICHEST + " SELECT doc_id, name, pkg_ord, cls_ord, n_attr, n_assoc, n_parent, copies FROM w WHERE r = 1")
def richest_wins(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.richest(corpus(spark, sf))


@query(_RICHEST + " SELECT doc_id, count(*) AS dup_groups, sum(copies) AS total, sum(copies - 1) AS dropped FROM w WHERE r = 1 AND copies > 1 GROUP BY 1")
def duplicate_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of classes of one name, and how many are dropped."""
    x = resolve.richest(corpus(spark, sf)).where("copies > 1")
    return x.groupBy("doc_id").agg(F.count("*").alias("dup_groups"), F.sum("copies").alias("total"), F.sum(F.col("copies") - 1).alias("dropped"))


@query("SELECT package, name, arg_min(class_id, class_id) AS class_id, count(*) AS n FROM class_def GROUP BY ALL")
def merge_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "class_def").groupBy("package", "name").agg(F.min("class_id").alias("class_id"), F.count("*").alias("n"))


_FUZZY = """a.package < b.package AND length(a.package) >= 5 AND length(b.package) >= 5 AND abs(length(a.package) - length(b.package)) BETWEEN 1 AND 3 AND levenshtein(a.package, b.package) <= least(6, greatest(2, greatest(length(a.package), length(b.package)) // 3))"""


@query(CORPUS_SQL + f", nm AS (SELECT DISTINCT doc_id, package FROM pk WHERE package IS NOT NULL) SELECT a.doc_id, a.package AS a, b.package AS b, levenshtein(a.package, b.package) AS distance FROM nm a JOIN nm b ON a.doc_id = b.doc_id AND {_FUZZY}")
def fuzzy_package_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.fuzzy_pairs(corpus(spark, sf))


_PARTS = "(SELECT DISTINCT p_name AS package FROM part)"


@query(f"SELECT a.package AS a, b.package AS b, levenshtein(a.package, b.package) AS distance FROM {_PARTS} a JOIN {_PARTS} b ON {_FUZZY}")
def fuzzy_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The same rule on names of parts, which have more near ones."""
    return _fuzzy_parts(spark, sf).select("a", "b", "distance")


def _part_model(spark: SparkSession, sf: str) -> Model:
    p = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").cast("int").alias("pkg_ord"))
    return Model(*[p.select(F.lit(0).cast("bigint").alias("doc_id"), "pkg_ord", F.col("p_name").alias("name"))] * 6)


def _fuzzy_parts(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.fuzzy_pairs(_part_model(spark, sf))


@query(
    f"""WITH RECURSIVE nm AS (SELECT p_name AS package, min(p_partkey) AS ord FROM part GROUP BY 1), e AS (SELECT a.package AS a, b.package AS b FROM nm a JOIN nm b ON {_FUZZY}), b2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    r AS (SELECT package AS x, package AS y FROM nm UNION SELECT r.x, b2.b FROM r JOIN b2 ON b2.a = r.y), g AS (SELECT x, min(y) AS c FROM r GROUP BY 1)
    SELECT x AS name, (SELECT arg_max(n2.package, length(n2.package) * 1000000000 - n2.ord) FROM g g2 JOIN nm n2 ON n2.package = g2.x WHERE g2.c = g.c) AS canonical FROM g"""
)
def fuzzy_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Connected groups of near names, under the longest name of each (the earliest of several)."""
    m = _part_model(spark, sf)
    return resolve.merged_names(m).join(m.package, ["doc_id", "pkg_ord"]).select("name", "canonical")


@query(
    CORPUS_SQL
    + """, th AS (SELECT DISTINCT doc_id, package, name FROM cl), r AS (SELECT doc_id, 'parent' AS kind, pkg_ord, cls_ord, ord, package, class_name FROM pa UNION ALL SELECT doc_id, 'target', pkg_ord, cls_ord, ord, n.target.package, class_name FROM sc)
    SELECT r.* FROM r WHERE class_name IS NOT NULL AND NOT EXISTS (FROM th WHERE th.doc_id = r.doc_id AND th.package = r.package AND th.name = r.class_name)"""
)
def dangling_refs(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.dangling_refs(corpus(spark, sf))


_EDGES = "SELECT DISTINCT from_package AS a, to_package AS b FROM cross_package_ref WHERE from_package <> to_package"


def _package_edges(spark: SparkSession, sf: str) -> DataFrame:
    x = table(spark, sf, "cross_package_ref").where("from_package <> to_package")
    return x.select(F.col("from_package").alias("a"), F.col("to_package").alias("b")).distinct()


@query(
    f"""WITH RECURSIVE e AS ({_EDGES}), n AS (SELECT a AS id FROM e UNION SELECT b FROM e), r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
    bad AS (SELECT a AS id FROM r WHERE a = b UNION SELECT r.b FROM r WHERE r.a IN (SELECT a FROM r WHERE a = b)), f AS (SELECT * FROM e WHERE b NOT IN (SELECT id FROM bad)),
    l AS (SELECT id, 0 AS level FROM n WHERE id NOT IN (SELECT b FROM e) UNION SELECT f.b, l.level + 1 FROM l JOIN f ON f.a = l.id) SELECT n.id, max(level)::INT AS level FROM n LEFT JOIN l USING (id) GROUP BY 1"""
)
def topo_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Levels of packages by dependency; null for packages on or behind a loop."""
    e = _package_edges(spark, sf)
    return graph.levels(e.select(F.col("a").alias("id")).union(e.select("b")), e)


@query("SELECT DISTINCT from_package, to_package, count(*) OVER (PARTITION BY from_package, to_package) AS n FROM (SELECT DISTINCT xref_id, from_package, to_package FROM cross_package_ref) WHERE from_package <> to_package")
def dependency_edges(spark: SparkSession, sf: str) -> DataFrame:
    x = table(spark, sf, "cross_package_ref").select("xref_id", "from_package", "to_package").distinct().where("from_package <> to_package")
    return x.groupBy("from_package", "to_package").agg(F.count("*").alias("n"))


@query(MODEL_SQL + ", e AS (SELECT DISTINCT doc_id, holder AS a, class_name AS b FROM pa WHERE holder IS NOT NULL AND class_name IS NOT NULL UNION SELECT doc_id, holder, class_name FROM sc WHERE holder IS NOT NULL AND class_name IS NOT NULL), r AS (SELECT doc_id, a, b FROM e UNION SELECT r.doc_id, r.a, e.b FROM r JOIN e ON e.doc_id = r.doc_id AND e.a = r.b) SELECT * FROM r")
def reference_closure(spark: SparkSession, sf: str) -> DataFrame:
    """All classes that each class leads to through parents and targets, in each document."""
    m = model(spark, sf)
    own = m.classes.select("doc_id", "pkg_ord", "cls_ord", F.col("name").alias("a"))
    refs = m.parent.select("doc_id", "pkg_ord", "cls_ord", F.col("class_name").alias("b")).unionByName(m.association.select("doc_id", "pkg_ord", "cls_ord", F.col("target.class_name").alias("b")))
    return graph.transitive_closure(refs.join(own, ["doc_id", "pkg_ord", "cls_ord"]).select("doc_id", "a", "b"), ["doc_id"])


@query(
    """WITH RECURSIVE c AS (SELECT DISTINCT {'p': package, 'n': name} AS b, {'p': p.package, 'n': p.class_name} AS a FROM (SELECT package, name, unnest(parents) AS p FROM class_def) WHERE p.class_name IS NOT NULL),
    r AS (SELECT b, a FROM c UNION SELECT r.b, c.a FROM r JOIN c ON c.b = r.a) SELECT concat_ws('.', b.p, b.n) AS sub, concat_ws('.', a.p, a.n) AS super FROM r"""
)
def subclass_closure(spark: SparkSession, sf: str) -> DataFrame:
    """The subclass relation of all parent links, within packages and across them, closed; classes are told apart by package and name."""
    x = table(spark, sf, "class_def").select("package", "name", F.explode("parents").alias("p")).where("p.class_name is not null")
    key = lambda package, name: F.struct(F.col(package).alias("package"), F.col(name).alias("name"))
    c = graph.transitive_closure(x.select(key("package", "name").alias("a"), key("p.package", "p.class_name").alias("b")))
    return c.select(F.concat_ws(".", "a.package", "a.name").alias("sub"), F.concat_ws(".", "b.package", "b.name").alias("super"))


_T = triples
_P = f"'{_T.NS}'"
_IDENT = "regexp_matches({0}, '^[A-Za-z_][A-Za-z0-9_]*$')".format
_PROP = f"CASE WHEN {_IDENT(STRIP('name'))} THEN {_P} || holder || '.' || left({STRIP('name')}, 64) END"


@query(
    MODEL_SQL
    + f""", ok AS (SELECT *, {_PROP} AS s FROM atr WHERE holder IS NOT NULL), os AS (SELECT *, {_PROP} AS s FROM sc WHERE holder IS NOT NULL),
    t AS (SELECT doc_id, package AS graph, {_P} || name AS s, 'type' AS p, 'Class' AS o FROM cl WHERE name IS NOT NULL
    UNION SELECT doc_id, package, {_P} || name, 'label', name FROM cl WHERE name IS NOT NULL
    UNION SELECT doc_id, package, {_P} || name, 'comment', n.description FROM cl WHERE name IS NOT NULL AND n.description <> ''
    UNION SELECT doc_id, package, {_P} || name, 'comment', 'stereotype: ' || n.stereotype FROM cl WHERE name IS NOT NULL AND n.stereotype <> ''
    UNION SELECT doc_id, own, {_P} || holder, 'subClassOf', class_name FROM pa WHERE holder IS NOT NULL AND class_name <> ''
    UNION SELECT doc_id, own, s, 'type', 'DatatypeProperty' FROM ok UNION SELECT doc_id, own, s, 'type', 'ObjectProperty' FROM os
    UNION SELECT doc_id, own, s, 'domain', holder FROM ok UNION SELECT doc_id, own, s, 'domain', holder FROM os
    UNION SELECT doc_id, own, s, 'label', left(name, 64) FROM ok UNION SELECT doc_id, own, s, 'label', left(name, 64) FROM os
    UNION SELECT doc_id, own, s, 'comment', 'required (min >= 1)' FROM ok WHERE n.required
    UNION SELECT doc_id, own, s, 'range', class_name FROM os WHERE {_IDENT('class_name')})
    SELECT * FROM t WHERE s IS NOT NULL AND graph IS NOT NULL"""
)
def owl_triples(spark: SparkSession, sf: str) -> DataFrame:
    """The triples of the model, with local names (ranges of attributes and isDefinedBy apart)."""
    from ..functions.names import local_name

    x = triples.owl(model(spark, sf)).where(~F.col("p").endswith("isDefinedBy") & ~((F.col("p") == triples.RDFS + "range") & F.col("o").startswith(triples.XSD)) & F.col("graph").isNotNull())
    o = F.when(F.col("o_kind") == "iri", local_name(F.col("o"))).otherwise(F.col("o"))
    return x.select("doc_id", "graph", "s", local_name(F.col("p")).alias("p"), o.alias("o")).distinct()




def _SAFE(c: str) -> str:  # noqa: N802
    return f"regexp_matches({STRIP(c)}, '^[A-Za-z0-9._\\-]+$')"




@query(
    MODEL_SQL
    + f""", c AS (SELECT * FROM cl WHERE {_SAFE('name')}), a AS (SELECT doc_id, 'shape_' || holder || '_' || name AS s, n FROM atr WHERE {_SAFE('holder')} AND {_SAFE('name')}),
    b AS (SELECT doc_id, 'shape_' || holder || '_' || name AS s, n, class_name FROM sc WHERE {_SAFE('holder')} AND {_SAFE('name')} AND {_SAFE('class_name')})
    SELECT doc_id, 'shape_' || name AS s, 'targetClass' AS p, name AS o FROM c UNION SELECT doc_id, s, 'minCount', '1' FROM a WHERE n.required UNION SELECT doc_id, s, 'maxCount', n.multiplicity.max::VARCHAR FROM a WHERE n.multiplicity.max IS NOT NULL
    UNION SELECT doc_id, s, 'minCount', n.multiplicity.min::VARCHAR FROM b WHERE n.multiplicity.min IS NOT NULL UNION SELECT doc_id, s, 'maxCount', n.multiplicity.max::VARCHAR FROM b WHERE n.multiplicity.max IS NOT NULL UNION SELECT doc_id, s, 'class', class_name FROM b"""
)
def shacl_triples(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.names import local_name

    x = triples.shacl(model(spark, sf)).withColumn("p", local_name(F.col("p"))).where(F.col("p").isin("targetClass", "minCount", "maxCount", "class"))
    return x.select("doc_id", local_name(F.col("s")).alias("s"), "p", F.when(F.col("o_kind") == "iri", local_name(F.col("o"))).otherwise(F.col("o")).alias("o")).distinct()


@query(MODEL_SQL + f" SELECT DISTINCT doc_id, name AS class_name FROM cl WHERE name IS NOT NULL AND package IS NOT NULL")
def triple_match(spark: SparkSession, sf: str) -> DataFrame:
    """Subjects that are classes, by a pattern."""
    from ..functions.names import local_name

    x = triples.match(triples.owl(model(spark, sf)), p=triples.RDF + "type", o=triples.OWL + "Class").where("graph is not null")
    return x.select("doc_id", local_name(F.col("s")).alias("class_name")).distinct()


@query("SELECT 0::BIGINT AS doc_id, '' AS graph, '' AS s, '' AS p, '' AS o, '' AS o_kind, '' AS o_lang, '' AS o_datatype WHERE false")
def triples_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """The triples written as lines and read again: what is lost or changed, nothing if all is well."""
    t = triples.owl(model(spark, sf)).where("graph is not null")
    cols = ["doc_id", "graph", "s", "p", "o", "o_kind", "o_lang", "o_datatype"]
    return triples.parsed(triples.lines(t)).select(*cols).exceptAll(t.select(*cols))


@query("SELECT 0::BIGINT AS doc_id, '' AS graph, '' AS s, '' AS p, '' AS o, '' AS o_kind, '' AS o_lang, '' AS o_datatype WHERE false")
def turtle_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """The triples written as Turtle and read again: what is lost or changed, nothing if all is well."""
    t = triples.owl(model(spark, sf)).unionByName(triples.shacl(model(spark, sf))).where("graph is not null")
    cols = ["doc_id", "graph", "s", "p", "o", "o_kind", "o_lang", "o_datatype"]
    return triples.turtle_parsed(triples.turtle_lines(t)).select(*cols).exceptAll(t.select(*cols))


def _tidy(spark: SparkSession, sf: str) -> Model:
    return emit.tidy(model(spark, sf))


_COUNT = "len(list_filter(n.{0}, lambda x: x IS NOT NULL))".format


@query(
    CORPUS_SQL
    + f""", ca AS (SELECT package, min(pkg_ord) AS canon FROM pk WHERE package IS NOT NULL GROUP BY 1), c AS (SELECT cl.*, canon FROM cl JOIN ca USING (package)),
    k AS (SELECT *, row_number() OVER (PARTITION BY canon, name ORDER BY pkg_ord <> canon, pkg_ord, cls_ord) AS r FROM c), m AS (SELECT *, row_number() OVER (PARTITION BY canon ORDER BY pkg_ord, cls_ord) AS at FROM k WHERE pkg_ord = canon OR r = 1),
    q AS (SELECT package, name, canon, at, coalesce({_COUNT("attributes")}, 0) AS n_attr, coalesce({_COUNT("associations")}, 0) AS n_assoc, coalesce({_COUNT("parents")}, 0) AS n_parent, coalesce({STRIP("n.description")}, '') <> '' AS d FROM m),
    w AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n_attr DESC, n_assoc DESC, n_parent DESC, d DESC, canon, at) AS r FROM q)
    SELECT package, name, canon AS pkg_ord, n_attr FROM w WHERE r = 1 OR name IS NULL""".replace(" AS at ", " AS place ").replace(", at,", ", place,").replace("canon, at)", "canon, place)")
)
def merged_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The classes of all documents as one, packages of a name merged, the richest class of each name kept."""
    m = emit.tidy(corpus(spark, sf))
    n = m.attribute.groupBy("doc_id", "pkg_ord", "cls_ord").agg(F.count("*").alias("n_attr"))
    x = m.named().join(n, ["doc_id", "pkg_ord", "cls_ord"], "left")
    return x.select("package", "name", "pkg_ord", F.coalesce("n_attr", F.lit(0)).alias("n_attr"))


# The model with packages merged and classes deduplicated, in SQL: md has the classes of merged packages, td those of each name's best; the tables
# of members follow with their new keys.
TIDY_SQL = (
    MODEL_SQL
    + f""", nm AS (SELECT doc_id, package, min(pkg_ord) AS ord FROM pk WHERE package IS NOT NULL GROUP BY ALL),
    fz AS (SELECT a.doc_id, a.package AS a, b.package AS b FROM nm a JOIN nm b ON a.doc_id = b.doc_id AND {_FUZZY}), f2 AS (SELECT doc_id, a, b FROM fz UNION SELECT doc_id, b, a FROM fz),
    rr AS (SELECT doc_id, package AS x, package AS y FROM nm UNION SELECT rr.doc_id, rr.x, f2.b FROM rr JOIN f2 ON f2.doc_id = rr.doc_id AND f2.a = rr.y), gr AS (SELECT doc_id, x AS package, min(y) AS c FROM rr GROUP BY ALL),
    cg AS (SELECT doc_id, c, min(ord) AS canon, arg_max(package, length(package) * 1000000000 - ord) AS cname FROM gr JOIN nm USING (doc_id, package) GROUP BY ALL), ca AS (SELECT doc_id, package, canon, cname FROM gr JOIN cg USING (doc_id, c)),
    mk AS (SELECT *, row_number() OVER (PARTITION BY doc_id, canon, name ORDER BY pkg_ord <> canon, pkg_ord, cls_ord) AS r FROM cl JOIN ca USING (doc_id, package)),
    md AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, canon ORDER BY pkg_ord, cls_ord) - 1)::INT AS place FROM mk WHERE pkg_ord = canon OR r = 1),
    mq AS (SELECT *, coalesce({_COUNT("attributes")}, 0) AS n_attr, coalesce({_COUNT("associations")}, 0) AS n_assoc, coalesce({_COUNT("parents")}, 0) AS n_parent, coalesce({STRIP("n.description")}, '') <> '' AS d FROM md),
    mr AS (SELECT *, row_number() OVER (PARTITION BY doc_id, name ORDER BY n_attr DESC, n_assoc DESC, n_parent DESC, d DESC, canon, place) AS best FROM mq), td AS (SELECT * FROM mr WHERE best = 1 OR name IS NULL),
    ky AS (SELECT doc_id, pkg_ord, cls_ord, canon, place, cname FROM td), cl_t AS (SELECT doc_id, canon AS pkg_ord, place AS cls_ord, cname AS package, n, name FROM td),
    pa_t AS (SELECT doc_id, canon AS pkg_ord, place AS cls_ord, cname AS own, holder, ord, class_name FROM pa JOIN ky USING (doc_id, pkg_ord, cls_ord)), atr_t AS (SELECT doc_id, canon AS pkg_ord, place AS cls_ord, cname AS own, holder, ord, n, name FROM atr JOIN ky USING (doc_id, pkg_ord, cls_ord)),
    sc_t AS (SELECT doc_id, canon AS pkg_ord, place AS cls_ord, cname AS own, holder, ord, n, name, class_name FROM sc JOIN ky USING (doc_id, pkg_ord, cls_ord))"""
)


def _of_tidy(sql: str) -> str:
    """A query on the model as delivered, put to the tidy one."""
    return TIDY_SQL + re.sub(r"\b(FROM|JOIN) (cl|pa|atr|sc)\b", r"\1 \2_t", sql.removeprefix(MODEL_SQL))


@query(TIDY_SQL + " SELECT doc_id, cname AS package, name, place AS cls_ord FROM td")
def tidy_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The classes left when packages are merged and classes deduplicated."""
    return _tidy(spark, sf).named().select("doc_id", "package", "name", "cls_ord")


_NAMED_XSD = f"(SELECT *, {STRIP('n.data_type')} AS s, {STRIP('name')} AS t FROM atr WHERE holder IS NOT NULL)"
_UPPER = "regexp_matches(class_name, '^\\p{Lu}')"


_CONTEXT = (
    MODEL_SQL
    + f""", x AS (SELECT doc_id, pkg_ord, cls_ord, own AS package, 0 AS top, 0 AS phase, ord, name AS term, 'cim:' || holder || '.' || name AS id, {_NORM} AS kind FROM {_NAMED_XSD} WHERE t <> '' AND NOT regexp_matches(name, '{NOISE}') AND regexp_matches(name, '[\\x00-\\x7f]')
    UNION ALL SELECT doc_id, pkg_ord, cls_ord, own, 0, 1, ord, name, 'cim:' || holder || '.' || name, '@id' FROM sc WHERE holder IS NOT NULL AND name IS NOT NULL AND {_UPPER}
    UNION ALL SELECT doc_id, pkg_ord, cls_ord, package, 1, 2, 0, name, 'cim:' || name, '@id' FROM cl WHERE name <> '' AND NOT regexp_matches(name, '{NOISE}')),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, pkg_ord, term ORDER BY top DESC, cls_ord DESC, phase DESC, ord DESC) AS r FROM x) SELECT doc_id, pkg_ord, package, term, id, kind FROM r WHERE r = 1"""
)


@query(_CONTEXT)
def context_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Terms of each package's context as delivered: classes above members, later members above earlier ones."""
    return emit.context_terms(model(spark, sf)).select("doc_id", "pkg_ord", "package", "term", "id", "kind")


_SLUG = f"CASE WHEN coalesce(t, '') = '' OR regexp_matches(t, '{NOISE}') THEN 'ocr_noise_attr' ELSE left(regexp_replace(t, '[^A-Za-z0-9._]', '_', 'g'), 64) END"
_RULE = "NOT coalesce(name <> '' AND (t = '' OR regexp_matches(t, '^[-:|]*-[-:|]*$')), false)"


_FIELDS = (
    MODEL_SQL
    + f""", a AS (SELECT doc_id, pkg_ord, cls_ord, 0 AS phase, ord, {_SLUG} AS slug, {_NORM} AS xsd, coalesce(n.required, false) AS required, NULL::VARCHAR AS ref, nullif(n.description, '') AS about FROM (SELECT *, {STRIP('n.data_type')} AS s, {STRIP('name')} AS t FROM atr) WHERE {_RULE}
    UNION ALL SELECT doc_id, pkg_ord, cls_ord, 1, ord, {_SLUG}, NULL::VARCHAR, false, '#/properties/' || class_name, NULL FROM (SELECT *, {STRIP('name')} AS t FROM sc) WHERE {_RULE} AND {_UPPER}),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, pkg_ord, cls_ord, slug ORDER BY phase DESC, ord DESC) AS r, bool_or(required) OVER (PARTITION BY doc_id, pkg_ord, cls_ord, slug) AS needed FROM a)
    SELECT doc_id, pkg_ord, cls_ord, slug, CASE WHEN ref IS NULL THEN {_JSON('xsd')} END AS type, {_FORMAT('xsd')} AS format, CASE WHEN xsd = 'xsd:base64Binary' THEN 'base64' END AS encoding, about AS description, ref, needed AS required FROM r WHERE r = 1"""
)


@query(_FIELDS)
def schema_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of each class's schema as delivered."""
    x = emit.schema_fields(model(spark, sf))
    return _field_parts(x)


def _field_parts(x: DataFrame) -> DataFrame:
    part = lambda k: F.get_json_object("value", f"$['{k}']")
    return x.select("doc_id", "pkg_ord", "cls_ord", "slug", part("type").alias("type"), part("format").alias("format"), part("contentEncoding").alias("encoding"), part("description").alias("description"), part("$ref").alias("ref"), "required")


@query(f"SELECT doc_id, package, term, id, kind FROM ({_of_tidy(_CONTEXT)})")
def jsonld_terms(spark: SparkSession, sf: str) -> DataFrame:
    return emit.context_terms(_tidy(spark, sf)).select("doc_id", "package", "term", "id", "kind")


@query(_of_tidy(_FIELDS))
def json_schema_fields(spark: SparkSession, sf: str) -> DataFrame:
    return _field_parts(emit.schema_fields(_tidy(spark, sf)))


_FIT = f"(regexp_matches({STRIP('name')}, '^[A-Za-z_][A-Za-z0-9_]*$') AND NOT regexp_matches(name, '{NOISE}'))"
_BLANK = f"coalesce({STRIP('name')}, '') = ''"


@query(
    _of_tidy(_CONTEXT).rsplit(" SELECT doc_id, pkg_ord", 1)[0]
    + f""", og AS (SELECT doc_id, cname FROM md WHERE NOT {_BLANK} GROUP BY ALL), oc AS (SELECT DISTINCT doc_id, cname, name FROM md JOIN og USING (doc_id, cname) WHERE name IS NOT NULL)
    SELECT doc_id, 'owl' AS form, 'cim17_' || cname || '.nt' AS path, count(*) AS things FROM oc GROUP BY ALL UNION ALL SELECT doc_id, 'owl', 'cim17_full.nt', count(DISTINCT name) FROM oc GROUP BY ALL
    UNION ALL SELECT doc_id, 'shacl', 'cim17_shapes.nt', count(DISTINCT {STRIP("name")}) FROM cl WHERE {_SAFE("name")} GROUP BY ALL
    UNION ALL SELECT doc_id, 'jsonld-context', cname || '_context.jsonld', 4 + count(term) FROM cg LEFT JOIN (SELECT doc_id, pkg_ord AS canon, term FROM r WHERE r = 1) USING (doc_id, canon) GROUP BY doc_id, canon, cname
    UNION ALL SELECT doc_id, 'json-schema', cname || '_schema.json', count(name) FROM cg LEFT JOIN (SELECT doc_id, canon, name FROM td) USING (doc_id, canon) GROUP BY doc_id, canon, cname
    UNION ALL SELECT doc_id, 'python-types', cname || '_types.py', count(name) FROM cg LEFT JOIN (SELECT doc_id, canon, name FROM td WHERE {_FIT}) USING (doc_id, canon) GROUP BY doc_id, canon, cname"""
)
def emitted_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every file of every form, with the number of classes, terms or properties in it."""
    x = emit.emitted(model(spark, sf))
    json = lambda k: F.size(F.map_keys(F.try_variant_get(F.try_parse_json("content"), f"$['{k}']", "map<string,variant>")))
    lines = lambda p: F.size(F.filter(F.split("content", "\n"), lambda l: l.rlike(p)))
    kinds = {"owl": lines("22-rdf-syntax-ns#type> <[^>]*owl#Class> "), "shacl": lines("22-rdf-syntax-ns#type> <[^>]*shacl#NodeShape> "), "jsonld-context": json("@context"), "json-schema": json("properties"), "python-types": lines("^class ")}
    things = F.coalesce(*[F.when(F.col("form") == k, c) for k, c in kinds.items()])
    return x.select("doc_id", "form", "path", things.cast("bigint").alias("things"))


@query("SELECT 0::BIGINT AS doc_id, '' AS form, '' AS path, '' AS issue WHERE false")
def verify_files(spark: SparkSession, sf: str) -> DataFrame:
    """Emitted files that can't be read back: there are none."""
    return emit.verified(emit.emitted(model(spark, sf)))


@query(
    TIDY_SQL
    + """, ix AS (SELECT doc_id, name, arg_max(cname, canon * 100000 + place) AS of FROM td WHERE name IS NOT NULL GROUP BY ALL), rf AS (SELECT doc_id, own, class_name FROM pa_t WHERE holder IS NOT NULL UNION SELECT doc_id, own, class_name FROM sc_t WHERE holder IS NOT NULL),
    e AS (SELECT DISTINCT rf.doc_id, ix.of AS a, rf.own AS b FROM rf JOIN ix ON ix.doc_id = rf.doc_id AND ix.name = rf.class_name WHERE rf.class_name <> '' AND rf.own <> ix.of),
    ch AS (SELECT * FROM e UNION SELECT ch.doc_id, ch.a, e.b FROM ch JOIN e ON e.doc_id = ch.doc_id AND e.a = ch.b), lp AS (SELECT DISTINCT doc_id FROM ch WHERE a = b), nd AS (SELECT doc_id, cname AS id, min(canon) AS ord FROM cg GROUP BY ALL),
    lv AS (SELECT doc_id, id, 0 AS level FROM nd WHERE doc_id NOT IN (FROM lp) UNION SELECT lv.doc_id, e.b, lv.level + 1 FROM lv JOIN e ON e.doc_id = lv.doc_id AND e.a = lv.id), l AS (SELECT doc_id, id, max(level) AS level FROM lv GROUP BY ALL)
    SELECT doc_id, id, row_number() OVER (PARTITION BY doc_id ORDER BY level NULLS FIRST, CASE WHEN level IS NOT NULL THEN ord END, id)::INT AS rank FROM nd LEFT JOIN l USING (doc_id, id)"""
)
def module_order(spark: SparkSession, sf: str) -> DataFrame:
    return emit.module_order(model(spark, sf))


def _probes(spark: SparkSession, sf: str) -> DataFrame:
    m = model(spark, sf)
    emit.tidy(m)  # what several forms share comes first
    forms = {"owl": lambda: consistency.triples_classes(triples.owl(m), "owl"), "shacl": lambda: consistency.triples_classes(triples.shacl(m), "shacl")}
    forms |= {f: partial(lambda f: consistency.text_classes(emit.get_adapter(f)(m), f), f) for f in ("json-schema", "jsonld-context", "python-types")}
    present = reduce(DataFrame.unionByName, frames.together(*[partial(lambda x: frames.written(x()), x) for x in forms.values()]))  # each form has a plan of its own
    sample = m.named().where("package is not null").select("doc_id", "package", F.col("name").alias("class_name")).distinct()
    return consistency.probed(consistency.stratified_sample(sample, "package", "class_name"), present)


@query(
    TIDY_SQL
    + """, og AS (SELECT doc_id, cname FROM md WHERE NOT """ + _BLANK + """ GROUP BY ALL), cb AS (SELECT row_number() OVER (PARTITION BY doc_id ORDER BY cname <> 'Core', canon) AS rank, doc_id, cname FROM og JOIN cg USING (doc_id, cname))
    SELECT doc_id, cname AS package, (rank - 1)::INT AS rank FROM cb"""
)
def package_order(spark: SparkSession, sf: str) -> DataFrame:
    """Packages in the order they are emitted in: Core first."""
    return emit.package_order(model(spark, sf))


_PROBED = f""", sm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY md5('42:' || name), name) AS k FROM (SELECT DISTINCT doc_id, package, name FROM cl WHERE package IS NOT NULL AND NOT {_BLANK}))  WHERE k <= 25),
    pr AS (SELECT sm.*, EXISTS (FROM cl WHERE cl.doc_id = sm.doc_id AND cl.name = sm.name) AS owl, {_SAFE("sm.name")} AS shacl, EXISTS (FROM td WHERE td.doc_id = sm.doc_id AND td.name = sm.name) AS json_schema,
    EXISTS (FROM td WHERE td.doc_id = sm.doc_id AND td.name = sm.name AND NOT regexp_matches(td.name, '{NOISE}')) OR EXISTS (FROM atr_t a WHERE a.doc_id = sm.doc_id AND a.name = sm.name) OR EXISTS (FROM sc_t a WHERE a.doc_id = sm.doc_id AND a.name = sm.name) AS jsonld_context,
    EXISTS (FROM td WHERE td.doc_id = sm.doc_id AND td.name = sm.name AND {_FIT.replace("name", "td.name")}) AS python_types FROM sm)"""
_ALL = "owl AND shacl AND json_schema AND jsonld_context AND python_types"


@query(TIDY_SQL + _PROBED + f" SELECT package, count(*) AS samples, count_if({_ALL}) AS passed, " + ", ".join(f"count_if({c}) AS {c}" for c in _ALL.split(" AND ")) + f", count_if({_ALL}) / count(*) AS pass_rate FROM pr GROUP BY 1")
def consistency_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled classes of each package that each form holds."""
    return consistency.matrix(_probes(spark, sf))


@query(TIDY_SQL + _PROBED + f" SELECT name AS class_name FROM pr GROUP BY 1 HAVING bool_and({_ALL})")
def consistent_names(spark: SparkSession, sf: str) -> DataFrame:
    return consistency.passed_names(_probes(spark, sf))


@query(
    MODEL_SQL
    + f""", x AS (SELECT doc_id, own, holder || '.' || left({STRIP('name')}, 64) AS s, 'DatatypeProperty' AS kind, list_last(string_split(list_last(string_split(replace({_RANGE(_NORM)}, 'xsd:', 'x#'), '#')), '/')) AS value FROM {_NAMED_XSD} WHERE {_IDENT(STRIP('name'))} AND NOT regexp_matches(t, '{NOISE}')
    UNION ALL SELECT doc_id, own, holder || '.' || left({STRIP('name')}, 64), 'ObjectProperty', CASE WHEN {_IDENT('class_name')} THEN class_name END FROM sc WHERE holder IS NOT NULL AND {_IDENT(STRIP('name'))}),
    g AS (SELECT doc_id, own, s, max(kind) AS kind, max(value) AS value FROM x GROUP BY ALL)
    SELECT DISTINCT doc_id, split_part(s, '.', 1) AS class_name, CASE kind WHEN 'DatatypeProperty' THEN 'attribute' ELSE 'association' END AS kind, s[instr(s, '.') + 1:] AS name, value FROM g"""
)
def owl_members(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes and associations read back from OWL triples."""
    return consistency.triples_members(triples.owl(model(spark, sf)), triples.NS)


_SAID = """CASE class_id % 5 WHEN 0 THEN 'no json' WHEN 1 THEN '{"consistent": true, "confidence": 0.9}' WHEN 2 THEN '{"missing_attrs": {}, "missing_assocs": {}, "confidence": 0.25, "notes": "unsure"}'
    WHEN 3 THEN '{"consistent": true, "missing_attrs": {}, "missing_assocs": {}, "confidence": 0.75}' ELSE '{"class_iri": "' || iri || '", "consistent": false, "missing_attrs": {"owl": ["' || name || '", "b"]}, "missing_assocs": {"shacl": ["c"]}, "confidence": 0.5, "notes": "lacks"}' END"""


@query(
    f"""WITH a AS (SELECT DISTINCT class_id, iri, {_SAID} AS response FROM class_def WHERE iri IS NOT NULL AND name IS NOT NULL), j AS (SELECT *, TRY_CAST(response AS JSON) AS v FROM a), x AS (SELECT *, CASE WHEN v IS NULL THEN 'json_invalid' WHEN NOT json_exists(v, '$.missing_attrs') OR NOT json_exists(v, '$.missing_assocs') THEN 'invalid_format' WHEN (v ->> '$.confidence')::DOUBLE < 0.5 THEN 'low_confidence' ELSE 'ok' END AS outcome FROM j)
    SELECT iri AS class_iri, outcome, (v ->> '$.consistent')::BOOLEAN AS consistent, coalesce((v ->> '$.confidence')::DOUBLE, 0.0) AS confidence, v ->> '$.notes' AS notes, v ->> '$.missing_attrs.owl[0]' AS lacks, (json_array_length(v, '$.missing_assocs.shacl'))::INT AS lacking_assocs FROM x"""
)
def semantic_findings(spark: SparkSession, sf: str) -> DataFrame:
    """What answers about classes say: outcome, and what the forms lack."""
    x = table(spark, sf, "class_def").where("iri is not null and name is not null").select("class_id", "iri", F.expr(_SAID).alias("response")).distinct()
    f = consistency.semantic_findings(x.select(F.col("iri").alias("class_iri"), "response"))
    return f.select("class_iri", "outcome", "consistent", "confidence", "notes", F.get(F.try_element_at("missing_attrs", F.lit("owl")), F.lit(0)).alias("lacks"), F.nullif(F.size(F.try_element_at("missing_assocs", F.lit("shacl"))), F.lit(-1)).alias("lacking_assocs"))


@query(
    MODEL_SQL
    + f""", a AS (SELECT doc_id, holder AS class_name, 'attribute' AS kind, name, CASE WHEN n.data_type LIKE 'xsd:%' THEN n.data_type[5:] WHEN {_SAFE("n.data_type")} THEN n.data_type END AS value, CASE WHEN n.required THEN 1 END AS lo, n.multiplicity.max AS hi FROM atr WHERE {_SAFE('holder')} AND {_SAFE('name')}
    UNION ALL SELECT doc_id, holder, 'association', name, class_name, n.multiplicity.min, n.multiplicity.max FROM sc WHERE {_SAFE('holder')} AND {_SAFE('name')} AND {_SAFE('class_name')}),
    g AS (SELECT doc_id, class_name, name, max(kind) AS k, max(CASE WHEN kind = 'association' THEN value END) AS c, max(CASE WHEN kind = 'attribute' THEN value END) AS d, bool_or(kind = 'association') AS linked, max(lo::VARCHAR) AS lo, max(hi::VARCHAR) AS hi FROM a GROUP BY ALL)
    SELECT doc_id, class_name, CASE WHEN linked THEN 'association' ELSE 'attribute' END AS kind, name, coalesce(c, d) AS value FROM g"""
)
def shape_members(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes and associations read back from shapes."""
    return consistency.shape_members(triples.shacl(model(spark, sf))).drop("multiplicity").distinct()


_NAMED_FIELDS = TIDY_SQL + ", f AS (" + _of_tidy(_FIELDS).removeprefix(TIDY_SQL).lstrip(", \n").replace("a AS (SELECT", "WITH a AS (SELECT", 1) + ")"


@query(_NAMED_FIELDS + " SELECT DISTINCT doc_id, t.name AS class_name, CASE WHEN f.ref IS NULL THEN 'attribute' ELSE 'association' END AS kind, f.slug AS name, coalesce(list_last(string_split(f.ref, '/')), f.type) AS value FROM f JOIN cl_t t USING (doc_id, pkg_ord, cls_ord) WHERE t.name IS NOT NULL")
def schema_members(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes and associations read back from JSON schemas."""
    return consistency.schema_members(emit.json_schema(model(spark, sf)))


@query("SELECT package, class_id, name FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY md5('42:' || name), name) AS r FROM (SELECT DISTINCT package, class_id, name FROM class_def WHERE name IS NOT NULL AND trim(name) <> '')) WHERE r <= 25")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    """25 classes of each package, by hash."""
    x = table(spark, sf, "class_def").select("package", "class_id", "name").distinct()
    return consistency.stratified_sample(x, "package", "name")
