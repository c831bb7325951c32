"""Semantic packages: of every package with an id, the files of its model, its constraints, its schema, types, an example and its checks.

Each file is one row (doc_id, package_id, path, content); structured files are JSON, which is YAML too. References
that don't resolve are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import datatypes as D
from ..functions import multiplicity as M
from ..functions import names as N
from ..operators import resolve, triples
from .emit import _object, _pair, _quoted
from .model import CLASS_KEY, Model

KEY = ["doc_id", "pkg_ord"]
# Types of the outputs of packages; whatever is missing is a string.
JSON = {"xsd:integer": '{"type":"integer"}', "xsd:int": '{"type":"integer"}', "xsd:double": '{"type":"number"}', "xsd:decimal": '{"type":"number"}', "xsd:boolean": '{"type":"boolean"}'}
RANGES = ["string", "boolean", "integer", "double", "decimal", "date", "dateTime", "anyURI"]
EXAMPLE = {"xsd:integer": "1", "xsd:int": "1", "xsd:double": "1.0", "xsd:decimal": "1.0", "xsd:boolean": "true"}
PYTHON = {"xsd:boolean": "bool", "xsd:integer": "int", "xsd:int": "int", "xsd:double": "float", "xsd:decimal": "float"}


def _pick(table: dict[str, str], c: Column, other: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c), other)


def _list(rows: DataFrame, keys: list[str], order: list[str], item: Column) -> DataFrame:
    """(…keys, items): the items of each key in order."""
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, item.alias("_i")))), lambda x: x["_i"]).alias("items"))


def _struct(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"})


class Packages:
    """The tables and files of all packages with an id. ``producer`` and ``compatibility`` (what the packages work with, by name) stand in their
    manifests."""

    def __init__(self, m: Model, check: bool = True, producer: str = "loomset", compatibility: dict[str, str] | None = None):
        self.m, self.producer, self.compatibility = m, producer, compatibility or {}
        p = m.package.where(~N.blank(F.col("package_id"))).withColumn("ns", F.concat(F.rtrim(F.col("iri"), F.lit("/")), F.lit("/")))
        if check and (bad := resolve.dangling_refs(m).join(p.select(*KEY, "package_id"), KEY).limit(20).collect()):
            raise ValueError("unresolved references: " + "; ".join(f"{r.package_id}: {r.kind} {r.package}::{r.class_name}" for r in bad))
        self.package = p.withColumn("slug", N.slug(F.col("package_id")))
        own = self.package.select(*KEY, "package_id", "ns", F.col("iri").alias("own_iri"))
        self.classes = m.classes.join(own, KEY).withColumn("entity", F.concat_ws(".", "package_id", "name")).withColumn("class_iri", F.concat("ns", "name"))
        head = self.classes.select(*CLASS_KEY, "package_id", "ns", "own_iri", "entity", "class_iri", F.col("name").alias("class_name"))
        first = m.package.where("name is not null").groupBy("doc_id", "name").agg(F.min_by(F.struct("package_id", F.rtrim(F.col("iri"), F.lit("/")).alias("iri")), "pkg_ord").alias("other"))
        self.other = first.select("doc_id", F.col("name").alias("to_package"), F.col("other.package_id").alias("to_id"), F.col("other.iri").alias("to_iri"))
        self.attribute = m.attribute.join(head, CLASS_KEY)
        a = m.association.join(head, CLASS_KEY).withColumn("to_package", F.col("target.package")).join(self.other, ["doc_id", "to_package"], "left")
        base = F.coalesce("to_iri", F.rtrim(F.col("own_iri"), F.lit("/")))
        local = F.coalesce(F.col("target.class_name"), F.lit("_"))
        self.association = a.withColumn("target_iri", F.coalesce(F.nullif("target.iri", F.lit("")), F.concat_ws("/", base, local))).withColumn("target_id", F.when(F.col("to_id").isNotNull() & F.col("target.class_name").isNotNull(), F.concat_ws(".", "to_id", "target.class_name")))
        u = m.parent.withColumnRenamed("class_name", "up").join(head, CLASS_KEY).withColumn("to_package", F.col("package")).join(self.other, ["doc_id", "to_package"], "left").where("up is not null")
        self.parent = u.select(*CLASS_KEY, "par_ord", "package_id", "to_package", "to_id", "up", "class_iri", F.coalesce(F.nullif("iri", F.lit("")), F.concat_ws("/", base, "up")).alias("parent_iri"))
        self.enumeration = m.enumeration.join(own, KEY)

    def dependencies(self) -> DataFrame:
        """(doc_id, pkg_ord, dependencies): the sorted ids of other packages that parents and targets belong to."""
        refs = self.parent.select(*KEY, "package_id", "to_id").unionByName(self.association.select(*KEY, "package_id", "to_id")).where("to_id is not null and to_id <> package_id")
        d = refs.groupBy(*KEY).agg(F.array_sort(F.collect_set("to_id")).alias("dependencies"))
        return self.package.select(*KEY, "package_id").join(d, KEY, "left").withColumn("dependencies", F.coalesce("dependencies", F.array().cast("array<string>")))

    def entities(self) -> DataFrame:
        ups = self.parent.groupBy(*CLASS_KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("par_ord", F.col("parent_iri").alias("iri"), F.col("to_package").alias("package")))), lambda x: F.struct(x["iri"].alias("iri"), x["package"].alias("package"))).alias("parents"))
        x = self.classes.join(ups, CLASS_KEY, "left")
        return x.select(*CLASS_KEY, "package_id", F.col("entity").alias("id"), "name", F.col("class_iri").alias("iri"), "description", F.coalesce("parents", F.array().cast("array<struct<iri:string,package:string>>")).alias("parents"))

    def attributes(self) -> DataFrame:
        """Ids are not qualified by the class, so that names may collide in a package."""
        x = self.attribute
        return x.select(*CLASS_KEY, "attr_ord", "package_id", F.concat_ws(".", "package_id", "name").alias("id"), "name", F.col("entity").alias("entity_id"), F.col("class_iri").alias("iri"), D.model_type(F.col("data_type")).alias("type"), F.coalesce(F.nullif("data_type", F.lit("")), F.lit("xsd:string")).alias("xsd"), F.coalesce("required", F.lit(False)).alias("required"), M.text(F.col("multiplicity")).alias("multiplicity"), "description")

    def relations(self) -> DataFrame:
        x = self.association
        return x.select(*CLASS_KEY, "assoc_ord", "package_id", F.concat_ws(".", "package_id", "name").alias("id"), "name", F.col("entity").alias("entity_id"), F.col("class_iri").alias("iri"), "target_id", "target_iri", M.text(F.col("multiplicity")).alias("multiplicity"), "inverse_name")

    def enumerations(self) -> DataFrame:
        return self.enumeration.select(*KEY, "enum_ord", "package_id", F.concat_ws(".", "package_id", "name").alias("id"), "name", F.transform("values", lambda v: F.struct(v.alias("value"), v.alias("label"))).alias("values"))

    def owl(self) -> DataFrame:
        onto = F.rtrim(F.col("ns"), F.lit("/"))
        g = F.col("package_id")
        t = [triples.expand(self.package, g, triples.iri(onto, triples.RDF + "type", F.lit(triples.OWL + "Ontology")), triples.literal(onto, triples.OWL + "versionInfo", F.col("version")), triples.literal(onto, triples.RDFS + "label", F.col("name"), "en"))]
        c = F.col("class_iri")
        t.append(triples.expand(self.classes, g, triples.iri(c, triples.RDF + "type", F.lit(triples.OWL + "Class")), triples.literal(c, triples.RDFS + "label", F.col("name"), "en"), triples.literal(c, triples.RDFS + "comment", F.nullif("description", F.lit("")), "zh")))
        t.append(triples.expand(self.parent, g, triples.iri(c, triples.RDFS + "subClassOf", F.col("parent_iri"))))
        p = F.concat("ns", "class_name", F.lit("."), "name")
        rng = _pick({f"xsd:{r}": triples.XSD + r for r in RANGES} | {"xsd:int": triples.XSD + "integer"}, F.col("data_type"), F.lit(triples.XSD + "string"))
        for df, kind, o in ((self.attribute, "DatatypeProperty", rng), (self.association, "ObjectProperty", F.col("target_iri"))):
            t.append(triples.expand(df, g, triples.iri(p, triples.RDF + "type", F.lit(triples.OWL + kind)), triples.literal(p, triples.RDFS + "label", F.col("name"), "en"), triples.iri(p, triples.RDFS + "domain", c), triples.iri(p, triples.RDFS + "range", o)))
        return _union(t).dropDuplicates()

    def shacl(self, legacy: bool = False) -> DataFrame:
        """Shapes of every class. ``legacy`` writes the class of a target under the misspelled property that no validator reads."""
        g, shape, c = F.col("package_id"), F.concat("ns", "class_name", F.lit("Shape")), F.col("class_iri")
        own = self.classes.withColumn("class_name", F.col("name"))
        t = [triples.expand(own, g, triples.iri(shape, triples.RDF + "type", F.lit(triples.SH + "NodeShape")), triples.iri(shape, triples.SH + "targetClass", c), triples.literal(shape, triples.RDFS + "label", F.concat("name", F.lit(" shape")), "en"))]
        path = F.concat("ns", "class_name", F.lit("."), "name")
        prop = F.concat(path, F.lit("Shape"))
        common = [triples.iri(shape, triples.SH + "property", prop), triples.iri(prop, triples.RDF + "type", F.lit(triples.SH + "PropertyShape")), triples.iri(prop, triples.SH + "path", path)]
        count = lambda n, v: triples.literal(prop, triples.SH + n, v, None, triples.XSD + "integer")
        rng = _pick({f"xsd:{r}": triples.XSD + r for r in RANGES} | {"xsd:int": triples.XSD + "integer"}, F.col("data_type"), F.lit(triples.XSD + "string"))
        t.append(triples.expand(self.attribute, g, *common, triples.iri(prop, triples.SH + "datatype", rng), count("minCount", F.when(F.col("required"), 1)), count("maxCount", F.when(F.col("multiplicity.max") <= 1, 1))))
        t.append(triples.expand(self.association, g, *common, triples.iri(prop, triples.SH + ("class_" if legacy else "class"), F.col("target_iri")), count("minCount", F.col("multiplicity.min")), count("maxCount", F.col("multiplicity.max"))))
        return _union(t).dropDuplicates()

    def context(self) -> DataFrame:
        """(doc_id, pkg_ord, term, id, kind): class by class its own term, then its attributes and associations, enumerations last; the later one
        of a name wins."""
        kinds = [
            (self.classes.withColumn("class_name", F.col("name")), 0, F.lit(0), F.col("class_iri"), "@id"),
            (self.attribute, 1, F.col("attr_ord"), F.concat("ns", "class_name", F.lit("."), "name"), None),
            (self.association, 2, F.col("assoc_ord"), F.concat("ns", "class_name", F.lit("."), "name"), "@id"),
        ]
        x = _union([df.select(*KEY, "cls_ord", F.lit(ph).alias("ph"), o.alias("ord"), F.col("name").alias("term"), i.alias("id"), F.lit(k).cast("string").alias("kind")) for df, ph, o, i, k in kinds])
        e = self.enumeration.select(*KEY, F.lit(2**31 - 1).alias("cls_ord"), F.lit(0).alias("ph"), F.col("enum_ord").alias("ord"), F.col("name").alias("term"), F.concat("ns", "name").alias("id"), F.lit("@id").alias("kind"))
        x = x.unionByName(e).where("term is not null")
        return x.groupBy(*KEY, "term").agg(F.max_by(F.struct("id", "kind"), F.struct("cls_ord", "ph", "ord")).alias("v")).select(*KEY, "term", "v.id", "v.kind")

    def schema(self) -> DataFrame:
        """(doc_id, pkg_ord, cls_ord, name, definition) of the node of each class in the JSON schema; nothing else is allowed in a node."""
        a = self.attribute.select(*CLASS_KEY, F.lit(0).alias("ph"), F.col("attr_ord").alias("ord"), "name", _pick(JSON, F.col("data_type"), F.lit('{"type":"string"}')).alias("value"), F.coalesce("required", F.lit(False)).alias("required"))
        many = F.coalesce(M.is_many(F.col("multiplicity")), F.lit(False)) & F.col("multiplicity").isNotNull()
        s = self.association.select(*CLASS_KEY, F.lit(1).alias("ph"), F.col("assoc_ord").alias("ord"), "name", F.when(many, '{"type":"array","items":{"type":"string"}}').otherwise('{"type":"string"}').alias("value"), F.lit(False).alias("required"))
        f = a.unionByName(s).where("name is not null").groupBy(*CLASS_KEY, "name").agg(F.min(F.struct("ph", "ord")).alias("first"), F.max_by("value", F.struct("ph", "ord")).alias("value"), F.max("required").alias("required"))
        f = f.groupBy(*CLASS_KEY).agg(F.array_sort(F.collect_list(F.struct("first", "name", "value", "required"))).alias("f"))
        x = self.classes.join(f, CLASS_KEY, "left").where("name is not null")
        none = F.array().cast("array<string>")
        props = F.concat(F.array(F.concat(F.lit('"@type":{"const":'), _quoted(F.col("name")), F.lit("}")), F.lit('"id":{"type":"string"}')), F.coalesce(F.transform("f", lambda i: _pair(i["name"], i["value"])), none))
        needed = F.concat(F.array(F.lit('"@type"'), F.lit('"id"')), F.coalesce(F.transform(F.filter("f", lambda i: i["required"]), lambda i: _quoted(i["name"])), none))
        body = F.concat(F.lit('{"type":"object","properties":'), _object(props), F.lit(',"required":['), F.array_join(needed, ","), F.lit('],"additionalProperties":false}'))
        return x.select(*CLASS_KEY, "name", body.alias("definition"))

    def example(self) -> DataFrame:
        """(doc_id, pkg_ord, cls_ord, node): one node a class; required links within the package are there, optional single ones too."""
        own = self.classes.select(*KEY, F.col("name").alias("to_name")).distinct()
        a = self.attribute.select(*CLASS_KEY, F.lit(0).alias("ph"), F.col("attr_ord").alias("ord"), "name", _pick(EXAMPLE, F.col("data_type"), F.when(F.col("data_type") == "xsd:string", _quoted(F.col("name"))).otherwise(F.lit('""'))).alias("value"))
        m = F.col("multiplicity")
        to = _quoted(F.concat("to_name", F.lit("001")))
        many = m.isNull() | m["max"].isNull() | (m["max"] > 1)
        link = F.when(F.coalesce(m["min"], F.lit(0)) >= 1, F.when(many, F.concat(F.lit("["), to, F.lit("]"))).otherwise(to)).when(m["max"] == 1, to)
        s = self.association.withColumn("to_name", F.col("target.class_name")).join(own, [*KEY, "to_name"]).select(*CLASS_KEY, F.lit(1).alias("ph"), F.col("assoc_ord").alias("ord"), "name", link.alias("value")).where("value is not null")
        f = a.unionByName(s).where("name is not null").groupBy(*CLASS_KEY, "name").agg(F.max_by("value", F.struct("ph", "ord")).alias("value"), F.min(F.struct("ph", "ord")).alias("first"))
        f = f.groupBy(*CLASS_KEY).agg(F.array_sort(F.collect_list(F.struct("first", "name", "value"))).alias("f"))
        x = self.classes.join(f, CLASS_KEY, "left").where("name is not null")
        pairs = F.concat(F.array(F.concat(F.lit('"@type":'), _quoted(F.col("name"))), F.concat(F.lit('"id":'), _quoted(F.concat("name", F.lit("001"))))), F.coalesce(F.transform("f", lambda i: _pair(i["name"], i["value"])), F.array().cast("array<string>")))
        return x.select(*CLASS_KEY, _object(pairs).alias("node"))

    def types(self) -> DataFrame:
        """(doc_id, pkg_ord, content): frozen dataclasses, required fields first, and enumerations."""
        hint = _pick(PYTHON, F.col("data_type"), F.lit("str"))
        late = (~F.coalesce("required", F.lit(False))).cast("int")
        a = self.attribute.where("name is not null").select(*CLASS_KEY, F.lit(1).alias("ph"), late.alias("late"), F.col("attr_ord").alias("ord"), F.concat(F.lit("    "), "name", F.lit(": "), hint, F.when(late == 1, " = None").otherwise("")).alias("line"))
        many = F.col("multiplicity").isNotNull() & F.coalesce(M.is_many(F.col("multiplicity")), F.lit(False))
        s = self.association.where("name is not null").select(*CLASS_KEY, F.lit(2).alias("ph"), F.lit(1).alias("late"), F.col("assoc_ord").alias("ord"), F.concat(F.lit("    "), "name", F.when(many, ": list[str] = None").otherwise(": Optional[str] = None")).alias("line"))
        c = self.classes.where("name is not null").select(*CLASS_KEY, F.lit(0).alias("ph"), F.lit(0).alias("late"), F.lit(0).alias("ord"), F.concat(F.lit("\n\n@dataclass(frozen=True)\nclass "), "name", F.lit(':\n    """'), F.replace(F.coalesce("description", F.lit("")), F.lit('"'), F.lit("'")), F.lit('"""\n    id: str')).alias("line"))
        values = F.array_join(F.transform(F.filter("values", lambda v: v.isNotNull()), lambda v: F.concat(F.lit("\n    "), v, F.lit(' = "'), v, F.lit('"'))), "")
        e = self.enumeration.where("name is not null").select(*KEY, F.lit(2**31 - 1).alias("cls_ord"), F.lit(0).alias("ph"), F.lit(0).alias("late"), F.col("enum_ord").alias("ord"), F.concat(F.lit("\n\nclass "), "name", F.lit("(Enum):"), F.when(values == "", "\n    pass").otherwise(values)).alias("line"))
        h = self.package.select(*KEY, F.lit(-1).alias("cls_ord"), F.lit(0).alias("ph"), F.lit(0).alias("late"), F.lit(0).alias("ord"), F.lit("from __future__ import annotations\n\nfrom dataclasses import dataclass\nfrom enum import Enum\nfrom typing import Optional").alias("line"))
        x = _union([h, c, a, s, e])
        return _list(x, KEY, ["cls_ord", "ph", "late", "ord"], F.col("line")).select(*KEY, F.array_join("items", "\n").alias("content"))

    def checks(self) -> DataFrame:
        """(doc_id, pkg_ord, case_id, name, check ARRAY) of the conformance cases of each package."""
        p = self.package.select(*KEY)
        # The conformance cases every package has.
        fixed = [("CTS-TP-001", "Package Metadata", ["manifest.yaml exists", "manifest.yaml schema valid"]), ("CTS-TP-004", "Artifact Generation", ["OWL file exists and parses", "SHACL file exists and parses", "JSON-LD context exists and parses", "JSON Schema exists and validates example"]), ("CTS-TP-005", "Runtime Loading", ["Package loads without error", "All classes have IRI", "All relations resolve target"])]
        parts = [p.select(*KEY, F.lit(i).alias("case_id"), F.lit(n).alias("name"), F.array(*map(F.lit, c)).alias("check")) for i, n, c in fixed]
        none = F.array().cast("array<string>")
        names = _list(self.classes, KEY, ["cls_ord"], F.concat("name", F.lit(" exists")))
        links = _list(self.association, KEY, ["cls_ord", "assoc_ord"], F.concat_ws(" ", "class_name", "name", "target.class_name"))
        for i, n, df in (("CTS-TP-002", "Entity Completeness", names), ("CTS-TP-003", "Relation Integrity", links)):
            parts.append(p.join(df, KEY, "left").select(*KEY, F.lit(i).alias("case_id"), F.lit(n).alias("name"), F.coalesce("items", none).alias("check")))
        return _union(parts)

    def files(self) -> DataFrame:
        """(doc_id, package_id, path, content) of all files of all packages; the manifest's time is the session's."""
        none = F.array().cast("array<string>")
        join = lambda df, order, item: self.package.select(*KEY).join(_list(df, KEY, order, item), KEY, "left").withColumn("items", F.coalesce("items", none))
        array = lambda name: F.concat(F.lit(f'{{"{name}":['), F.array_join("items", ","), F.lit("]}"))
        out = []
        add = lambda df, path, content: out.append(df.select(*KEY, path.alias("path"), content.alias("content")))
        d = self.dependencies().drop("package_id").join(self.package, KEY)
        man = F.concat(F.lit('{"package":'), _struct(id=F.col("package_id"), name=F.col("name"), version=F.col("version"), producer=F.lit(self.producer), compatibility=F.create_map(*[F.lit(x) for kv in self.compatibility.items() for x in kv]) if self.compatibility else F.lit(None).cast("map<string,string>"), maturity=F.lit("reference"), source_ir=F.col("iri"), status=F.lit("draft"), generated_at=F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"), generator=F.lit("loomset"), dependencies=F.col("dependencies")), F.lit("}"))
        add(d, F.lit("manifest.yaml"), man)
        add(d, F.lit("README.md"), F.concat(F.lit("# "), "name", F.lit("\n\nPackage `"), "package_id", F.lit("`, version "), "version", F.lit(".\n")))
        e, a, r, n = self.entities(), self.attributes(), self.relations(), self.enumerations()
        item = lambda df, skip: F.to_json(F.struct(*[c for c in df.columns if c not in skip]), {"ignoreNullFields": "false"})
        for name, df, order in (("entities", e, ["cls_ord"]), ("attributes", a, ["cls_ord", "attr_ord"]), ("relations", r, ["cls_ord", "assoc_ord"])):
            add(join(df, order, item(df, [*CLASS_KEY, "attr_ord", "assoc_ord"])), F.lit(f"semantic-model/{name}.yaml"), array(name))
        x = join(n, ["enum_ord"], item(n, [*KEY, "enum_ord"])).where(F.size("items") > 0)
        add(x, F.lit("semantic-model/enumerations.yaml"), array("enumerations"))
        slug = self.package.select(*KEY, "package_id", "slug", "ns", "name")
        for t, folder, end in ((self.owl(), "ontology", ".owl"), (self.shacl(), "constraints", ".shacl")):
            g = triples.lines(t).groupBy("doc_id", F.col("graph").alias("package_id")).agg(F.array_join(F.array_sort(F.collect_set("line")), "\n").alias("content"))
            add(slug.join(g, ["doc_id", "package_id"]), F.concat(F.lit(f"{folder}/"), "slug", F.lit(end)), F.col("content"))
        term = F.when(F.col("kind").isNull(), F.to_json(F.struct(F.col("id").alias("@id")))).otherwise(F.to_json(F.struct(F.col("id").alias("@id"), F.col("kind").alias("@type"))))
        c = join(self.context(), ["term"], _pair(F.col("term"), term)).join(slug, KEY)
        add(c, F.concat(F.lit("jsonld/"), "slug", F.lit("-context.jsonld")), F.concat(F.lit('{"@context":'), _object(F.concat(F.array(F.concat(F.lit('"@vocab":'), _quoted(F.col("ns"))), F.lit('"id":"@id"'), F.lit('"type":"@type"')), "items")), F.lit("}")))
        s = self.package.select(*KEY).join(_list(self.schema(), KEY, ["cls_ord"], F.struct("name", "definition")), KEY, "left").join(slug, KEY)
        items = F.coalesce("items", F.array().cast("array<struct<name:string,definition:string>>"))
        refs = F.array_join(F.transform(items, lambda i: F.concat(F.lit('{"$ref":'), _quoted(F.concat(F.lit("#/$defs/"), i["name"])), F.lit("}"))), ",")
        body = F.concat(F.lit('{"$schema":"http://json-schema.org/draft-07/schema#","$id":'), _quoted(F.concat("ns", F.lit("schema"))), F.lit(',"title":'), _quoted(F.col("name")), F.lit(',"type":"object","properties":{"@context":{"type":["string","object"]},"@graph":{"type":"array","items":{"anyOf":['), refs, F.lit(']}}},"required":["@graph"],"$defs":'), _object(F.transform(items, lambda i: _pair(i["name"], i["definition"]))), F.lit("}"))
        add(s, F.concat(F.lit("jsonschema/"), "slug", F.lit(".schema.json")), body)
        add(self.types().join(slug, KEY), F.concat(F.lit("python/"), F.replace("slug", F.lit("-"), F.lit("_")), F.lit("_types.py")), F.col("content"))
        ex = _list(self.example(), KEY, ["cls_ord"], F.col("node")).join(slug, KEY)
        add(ex, F.concat(F.lit("examples/"), "slug", F.lit("-instance.jsonld")), F.concat(F.lit('{"@context":'), _quoted(F.concat("ns", F.lit("context"))), F.lit(',"@graph":['), F.array_join("items", ","), F.lit("]}")))
        anchor = F.concat(F.lit('{"semantic_id":'), _quoted(F.concat_ws(".", "package_id", "name")), F.lit(',"expected_mappings":[{"system":"PMS","object":'), _quoted(F.col("class_name")), F.lit(',"field":""}]}'))
        add(join(self.attribute, ["cls_ord", "attr_ord"], anchor), F.lit("mappings/mapping-template.yaml"), array("mapping_anchors"))
        t = join(self.checks(), ["case_id"], F.to_json(F.struct(F.col("case_id").alias("id"), "name", "check")))
        add(t, F.lit("tests/package-cts.yaml"), array("cases"))
        folder = F.concat("slug", F.lit("-"), F.coalesce("version", F.lit("0.1.0")), F.lit("/"))
        return _union(out).join(self.package.select(*KEY, "package_id", folder.alias("folder")), KEY).select("doc_id", "package_id", F.concat("folder", "path").alias("path"), "content")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
