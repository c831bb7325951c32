"""The semantic model as related tables. Ordinals are part of every key, as "first wins" and "last wins" are decided by position.

package(doc_id, pkg_ord, iri, name, package_id, version), class(…, cls_ord, name, description, stereotype, source_table),
parent(…, par_ord, package, class_name, iri, is_external), attribute(…, attr_ord, name, data_type, multiplicity, description, required,
inherited_from), association(…, assoc_ord, name, target STRUCT, multiplicity, inverse_name, inherited_from),
enumeration(doc_id, pkg_ord, enum_ord, name, values).
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import ranked, together, unbroadcast, written
from ..operators.flatten import Flattened

CLASS_KEY = ["doc_id", "pkg_ord", "cls_ord"]


@dataclass(frozen=True)
class Model:
    package: DataFrame
    classes: DataFrame
    parent: DataFrame
    attribute: DataFrame
    association: DataFrame
    enumeration: DataFrame

    def with_(self, **tables: DataFrame) -> Model:
        return replace(self, **tables)

    def corpus(self) -> Model:
        """All documents as one, number 0: packages are numbered by document and place. Ids that leave no room for the place, such as hashes, are
        numbered in their order first."""
        own = self
        if self.package.where(F.abs("doc_id") >= 1 << 42).limit(1).count():
            number = ranked(self.package.select("doc_id").distinct(), [], ["doc_id"], "_n")
            own = Model(**{f.name: getattr(self, f.name).join(number, "doc_id").withColumn("doc_id", F.col("_n").cast("bigint")).drop("_n") for f in fields(self)})
        one = lambda t: t.withColumn("pkg_ord", F.col("doc_id") * 1048576 + F.col("pkg_ord")).withColumn("doc_id", F.lit(0).cast("bigint"))
        return Model(**{f.name: one(getattr(own, f.name)) for f in fields(self)})

    def named(self) -> DataFrame:
        """Every class with the name of its package."""
        return self.classes.join(self.package.select("doc_id", "pkg_ord", F.col("name").alias("package")), ["doc_id", "pkg_ord"])

    def get_class(self, name: str) -> DataFrame:
        """The first class of that name in each document."""
        return self.first_classes().where(F.col("name") == name)

    def first_classes(self) -> DataFrame:
        """The first class of each name in each document."""
        rest = [c for c in self.classes.columns if c not in ("doc_id", "name")]
        return self.classes.where("name is not null").groupBy("doc_id", "name").agg(F.min_by(F.struct(*rest), F.struct("pkg_ord", "cls_ord")).alias("c")).select("doc_id", "name", "c.*")

    def get_package(self, name: str) -> DataFrame:
        """The first package of that name in each document."""
        return self.package.where(F.col("name") == name).groupBy("doc_id").agg(F.min_by(F.struct(*[c for c in self.package.columns if c != "doc_id"]), "pkg_ord").alias("p")).select("doc_id", "p.*")

    def stats(self) -> DataFrame:
        """Counts of each document's packages, classes, attributes and associations."""
        parts = [t.groupBy("doc_id").agg(F.count("*").alias(n)) for t, n in ((self.package, "package_count"), (self.classes, "class_count"), (self.attribute, "attribute_count"), (self.association, "association_count"))]
        out = parts[0]
        for p in parts[1:]:
            out = out.join(p, "doc_id", "left")
        return out.fillna(0)


def nested(df: DataFrame, id_col: str = "ir_id", packages: str = "packages") -> Model:
    """The model from a column of nested packages; null lists and null elements have no rows, elements keep their positions."""
    flat = Flattened.typed(df.select(id_col, packages), id_col, packages)
    at = lambda name, *ords: [F.col("rec_id").alias("doc_id"), *[F.get("path", F.lit(k)).alias(o) for k, o in enumerate(ords)]]
    node = lambda *cols: [F.col(f"node.{c}").alias(c) for c in cols]
    t = {k.removeprefix(packages).lstrip("."): v for k, v in flat.nodes.items()}
    optional = F.col("node.multiplicity")
    none = F.lit(None).cast("string")
    return _stored(Model(
        t[""].select(*at("", "pkg_ord"), *node("iri", "name", "package_id", "version")),
        t["classes"].select(*at("", "pkg_ord", "cls_ord"), *node("name", "description", "stereotype", "source_table")),
        t["classes.parents"].select(*at("", "pkg_ord", "cls_ord", "par_ord"), *node("package", "class_name", "iri", "is_external")),
        t["classes.attributes"].select(*at("", "pkg_ord", "cls_ord", "attr_ord"), *node("name", "data_type"), optional.alias("multiplicity"), *node("description", "required"), none.alias("inherited_from")),
        t["classes.associations"].select(*at("", "pkg_ord", "cls_ord", "assoc_ord"), *node("name", "target"), optional.alias("multiplicity"), *node("inverse_name"), none.alias("inherited_from")),
        t["enumerations"].select(*at("", "pkg_ord", "enum_ord"), *node("name", "values")),
    ))


def _stored(m: Model) -> Model:
    """``m``, whose tables are read from Parquet files. Those are many times smaller than what they hold, as keys and texts repeat, and Spark takes a
    table for as large as its files: none is broadcast."""
    m = Model(*[unbroadcast(getattr(m, f.name)) for f in fields(m)])
    object.__setattr__(m, "stored", True)
    return m


def materialised(m: Model) -> Model:
    """The model with its tables written to the shared folder once, for several uses; one that is read from such tables as it is."""
    return m if getattr(m, "stored", False) else _stored(Model(*together(*[partial(written, getattr(m, f.name)) for f in fields(m)])))


def position(*ords: str) -> Column:
    """The place of a row in its document, to order by."""
    return F.struct(*ords)
