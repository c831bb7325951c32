"""Queries on nested records, hierarchies and references, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import table
from ..operators.flatten import Flattened
from ..operators.hierarchy import class_links, cycles, descendants, hierarchy
from ..operators.orphans import all_references, replayed

#: node_kind of each child table.
NODE_KINDS = {"packages": "package", "packages.classes": "class", "packages.classes.attributes": "attribute", "packages.classes.associations": "association"}
#: The columns of each child table that its query gives, as text; a source that lacks one has nulls.
COLUMNS = {
    "packages": ("name", "iri", "package_id", "version"),
    "packages.classes": ("name", "iri", "description", "stereotype", "source_table"),
    "packages.classes.attributes": ("name", "data_type", "description", "required", "multiplicity_min", "multiplicity_max", "multiplicity_raw"),
    "packages.classes.associations": ("name", "target_package", "target_class_name", "inverse_name", "multiplicity_min", "multiplicity_max", "multiplicity_raw"),
}

#: A field of the nodes that is named like a key of the result.
RENAMED = {"source_table": "from_table"}


def _flattened(spark: SparkSession, sf: str) -> dict[str, Flattened]:
    return {
        "ontology_ir": Flattened.typed(table(spark, sf, "ontology_ir"), "ir_id", "packages"),
        "ir_feed": Flattened.text(table(spark, sf, "ir_feed"), "feed_id", "payload", "packages"),
    }


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Ids are unique in both sources, so that no node comes twice."""
    ord_ = lambda k: F.coalesce(F.get("path", F.lit(k)), F.lit(-1))
    kind = F.create_map(*[F.lit(x) for pair in NODE_KINDS.items() for x in pair])
    parts = [flat.keys().where(F.col("table").isin(*NODE_KINDS)).select(F.lit(name).alias("source_table"), "*") for name, flat in _flattened(spark, sf).items()]
    return parts[0].unionByName(parts[1]).select("source_table", "rec_id", ord_(0).alias("pkg_ord"), ord_(1).alias("cls_ord"), kind[F.col("table")].alias("node_kind"), ord_(2).alias("item_ord"))


def _child_table(path: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        parts = []
        for name, flat in _flattened(spark, sf).items():
            if path in flat:
                t = flat.table(path)
                cols = [(F.col(c) if c in t.columns else F.lit(None)).cast("string").alias(RENAMED.get(c, c)) for c in COLUMNS[path]]
                parts.append(t.select(F.lit(name).alias("source_table"), "node_key", "parent_key", "ord", *cols))
        return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]

    query.__doc__ = f"The table {path} of both sources, with keys of node and parent."
    return query


P2_TABLES = {f"p2_{path.split('.')[-1]}": path for path in COLUMNS}


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy(class_links(table(spark, sf, "class_def"), table(spark, sf, "data_property")))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).select(F.col("id").alias("class_id"), F.col("root").alias("root_id"), "depth", "path")


def p4_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """Every class with each class below it and how far below."""
    return descendants(_paths(spark, sf)).select(F.col("id").alias("class_id"), F.col("descendant").alias("descendant_id"), "distance")


def p4_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """The loops: every class on one, its parent there, and whether this link closes the loop."""
    x = cycles(class_links(table(spark, sf, "class_def"), table(spark, sf, "data_property")))
    return x.select(F.col("loop").alias("loop_id"), F.col("id").alias("class_id"), F.col("parent").alias("parent_id"), "closes")


def _state(spark: SparkSession, sf: str):
    return replayed(all_references(table(spark, sf, "class_ref"), table(spark, sf, "cross_package_ref")), table(spark, sf, "class_def"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, sf).orphans()


def p5_report(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans counted by table, period and reason."""
    return _state(spark, sf).snapshot()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {f.__name__: f for f in (p2_found, p4_found, p4_descendants, p4_cycles, p5_found, p5_report)}
    return own | {name: _child_table(path) for name, path in P2_TABLES.items()}


_P2 = """
WITH RECURSIVE
raw AS (SELECT feed_id, TRY_CAST(payload AS JSON) AS v, []::VARCHAR[] AS way FROM ir_feed
  UNION ALL
  SELECT feed_id, x.v, list_append(way, x.k) FROM (
    SELECT feed_id, way, unnest(CASE json_type(v) WHEN 'VARCHAR' THEN [{'k': '', 'v': TRY_CAST(v ->> '$' AS JSON)}]
      ELSE list_transform(json_keys(v), lambda k: {'k': k, 'v': json_extract(v, '/' || replace(replace(k, '~', '~0'), '/', '~1'))}) END) AS x
    FROM raw WHERE v IS NOT NULL AND (json_type(v) = 'VARCHAR' OR (json_type(v) = 'OBJECT' AND NOT list_contains(json_keys(v), 'packages'))))),
best AS (SELECT feed_id, v FROM raw WHERE json_type(v) = 'OBJECT' AND list_contains(json_keys(v), 'packages') QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY len(way), way) = 1),
top AS (SELECT feed_id, v -> 'packages' AS l FROM best),
fp AS (SELECT feed_id, (i - 1)::INT AS p, x[i] AS n FROM (SELECT feed_id, CASE json_type(l) WHEN 'ARRAY' THEN l::JSON[] WHEN 'OBJECT' THEN [l] END AS x FROM top), unnest(range(1, len(x) + 1)) AS t(i)),
fc AS (SELECT feed_id, p, (i - 1)::INT AS c, x[i] AS n FROM (SELECT feed_id, p, CASE json_type(n -> 'classes') WHEN 'ARRAY' THEN (n -> 'classes')::JSON[] WHEN 'OBJECT' THEN [n -> 'classes'] END AS x FROM fp), unnest(range(1, len(x) + 1)) AS t(i)),
fi AS (SELECT feed_id, p, c, kind, (i - 1)::INT AS k, x[i] AS n FROM (
  SELECT feed_id, p, c, kind, CASE json_type(l) WHEN 'ARRAY' THEN l::JSON[] WHEN 'OBJECT' THEN [l] END AS x
  FROM (SELECT feed_id, p, c, 'attribute' AS kind, n -> 'attributes' AS l FROM fc UNION ALL SELECT feed_id, p, c, 'association', n -> 'associations' FROM fc)), unnest(range(1, len(x) + 1)) AS t(i)),
op AS (SELECT ir_id, (i - 1)::INT AS p, packages[i] AS n FROM ontology_ir, unnest(range(1, len(packages) + 1)) AS t(i)),
oc AS (SELECT ir_id, p, (i - 1)::INT AS c, n.classes[i] AS n FROM op, unnest(range(1, len(n.classes) + 1)) AS t(i)),
oa AS (SELECT ir_id, p, c, (i - 1)::INT AS k, n.attributes[i] AS n FROM oc, unnest(range(1, len(n.attributes) + 1)) AS t(i)),
os AS (SELECT ir_id, p, c, (i - 1)::INT AS k, n.associations[i] AS n FROM oc, unnest(range(1, len(n.associations) + 1)) AS t(i))
"""

ORACLE = {
    "p2_found": _P2
    + """
SELECT 'ir_feed' AS source_table, feed_id AS rec_id, p AS pkg_ord, -1 AS cls_ord, 'package' AS node_kind, -1 AS item_ord FROM fp WHERE json_type(n) = 'OBJECT'
UNION SELECT 'ir_feed', feed_id, p, c, 'class', -1 FROM fc WHERE json_type(n) = 'OBJECT'
UNION SELECT 'ir_feed', feed_id, p, c, kind, k FROM fi WHERE json_type(n) = 'OBJECT'
UNION SELECT 'ontology_ir', ir_id, p, -1, 'package', -1 FROM op WHERE n IS NOT NULL
UNION SELECT 'ontology_ir', ir_id, p, c, 'class', -1 FROM oc WHERE n IS NOT NULL
UNION SELECT 'ontology_ir', ir_id, p, c, 'attribute', k FROM oa WHERE n IS NOT NULL
UNION SELECT 'ontology_ir', ir_id, p, c, 'association', k FROM os WHERE n IS NOT NULL""",
}

_FEED = {"packages": ("fp", "feed_id, p", ""), "packages.classes": ("fc", "feed_id, p, c", ""), "packages.classes.attributes": ("fi", "feed_id, p, c, k", " AND kind = 'attribute'"), "packages.classes.associations": ("fi", "feed_id, p, c, k", " AND kind = 'association'")}
_TYPED = {"packages": ("op", "ir_id, p"), "packages.classes": ("oc", "ir_id, p, c"), "packages.classes.attributes": ("oa", "ir_id, p, c, k"), "packages.classes.associations": ("os", "ir_id, p, c, k")}
#: Columns that lie in an object of the node.
_INNER = {x: x.split("_", 1) for x in ("multiplicity_min", "multiplicity_max", "multiplicity_raw", "target_package", "target_class_name")}


def _table_sql(path: str) -> str:
    keys = lambda k: f"concat_ws('/', {k}) AS node_key, concat_ws('/', {k.rsplit(', ', 1)[0]}) AS parent_key, {k.rsplit(', ', 1)[1]} AS ord"
    feed, key, more = _FEED[path]
    typed, own = _TYPED[path]
    a = ", ".join(f"n ->> '$.{'.'.join(_INNER.get(c, [c]))}' AS {RENAMED.get(c, c)}" for c in COLUMNS[path])
    lacking = {"packages.classes": ("iri",)}.get(path, ())
    b = ", ".join("NULL" if c in lacking else f"n.{'.'.join(_INNER.get(c, [c]))}::VARCHAR" for c in COLUMNS[path])
    return _P2 + f"SELECT 'ir_feed' AS source_table, {keys(key)}, {a} FROM {feed} WHERE json_type(n) = 'OBJECT'{more} UNION ALL SELECT 'ontology_ir', {keys(own)}, {b} FROM {typed} WHERE n IS NOT NULL"


ORACLE |= {name: _table_sql(path) for name, path in P2_TABLES.items()}

_P4 = """
WITH RECURSIVE
c AS (SELECT class_id, arg_max({'package': package, 'name': name, 'parents': parents}, loaded_at) AS r FROM class_def GROUP BY 1),
own AS (SELECT class_id, r.package AS package, r.name AS name, list_filter(r.parents, lambda x: x.class_name IS NOT NULL AND NOT coalesce(x.is_external, false))[1] AS e FROM c),
heir AS (SELECT class_id, arg_min(inherited_from, {'o': attr_ord, 'i': attr_id}) AS name FROM data_property WHERE inherited_from IS NOT NULL GROUP BY 1),
link AS (SELECT a.class_id, CASE WHEN a.e IS NOT NULL THEN b.class_id ELSE d.class_id END AS parent FROM own a
  LEFT JOIN own b ON b.package = a.e.package AND b.name = a.e.class_name
  LEFT JOIN heir h ON h.class_id = a.class_id LEFT JOIN own d ON d.name = h.name),
tree AS (SELECT class_id, class_id AS root_id, 0 AS depth, class_id::VARCHAR AS path FROM link WHERE parent IS NULL
  UNION ALL SELECT l.class_id, t.root_id, t.depth + 1, t.path || '/' || l.class_id FROM tree t JOIN link l ON l.parent = t.class_id),
rest AS (SELECT * FROM link WHERE class_id NOT IN (SELECT class_id FROM tree)),
reach AS (SELECT class_id, parent AS top FROM rest UNION SELECT r.class_id, l.parent FROM reach r JOIN rest l ON l.class_id = r.top),
ring AS (SELECT DISTINCT class_id FROM reach WHERE class_id = top)
"""

ORACLE["p4_found"] = (
    _P4
    + """
SELECT class_id, root_id, depth, path FROM tree
UNION ALL SELECT class_id, 0, -1, CASE WHEN class_id IN (SELECT class_id FROM ring) THEN 'cycle' ELSE 'below cycle' END FROM rest"""
)
ORACLE["p4_descendants"] = (
    _P4
    + """, up AS (SELECT class_id AS descendant_id, parent AS class_id, 1 AS distance FROM link WHERE parent IS NOT NULL AND class_id IN (SELECT class_id FROM tree)
  UNION ALL SELECT u.descendant_id, l.parent, u.distance + 1 FROM up u JOIN link l ON l.class_id = u.class_id WHERE l.parent IS NOT NULL)
SELECT class_id, descendant_id, distance FROM up"""
)
ORACLE["p4_cycles"] = _P4 + "SELECT min(r.top) AS loop_id, class_id, l.parent AS parent_id, min(r.top) = l.parent AS closes FROM reach r JOIN ring USING (class_id) JOIN link l USING (class_id) GROUP BY class_id, l.parent"
ORACLE["p5_found"] = """
WITH c AS (SELECT package, name, min(created_at) AS born, max(deleted_at) AS gone FROM class_def GROUP BY ALL),
r AS (SELECT 'class_ref' AS source_table, ref_id, package, class_name AS name, ref_at FROM class_ref WHERE class_name IS NOT NULL AND NOT coalesce(is_external, false)
  UNION SELECT 'cross_package_ref', xref_id, to_package, via_class, ref_at FROM cross_package_ref WHERE via_class IS NOT NULL),
x AS (SELECT r.*, CASE WHEN c.name IS NULL THEN 'missing' WHEN born > ref_at THEN 'late' WHEN gone <= ref_at THEN 'deleted' END AS reason FROM r LEFT JOIN c USING (package, name))
SELECT source_table, ref_id, reason, strftime(ref_at AT TIME ZONE 'UTC', '%Y-%m') AS period FROM x WHERE reason IS NOT NULL"""
ORACLE["p5_report"] = f"SELECT source_table, period, reason, count(*) AS orphans FROM ({ORACLE['p5_found']}) GROUP BY ALL"


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
