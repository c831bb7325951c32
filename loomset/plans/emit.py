"""Emitters: from the model to files as rows (doc_id, form, path, content). Writing them is up to ``sinks``.

Text is put together by the engine: rows of lines or fields are grouped by file, so that a file of any document is built by the task that
holds it, and no driver loop goes over documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import frames
from ..frames import written
from ..functions import datatypes as D
from ..functions import names as N
from ..operators import graph, resolve, triples
from .model import CLASS_KEY, Model, materialised

Adapter = Callable[[Model], DataFrame]
ADAPTERS: dict[str, Adapter] = {}
#: The forms that are emitted by default; Turtle says the same as OWL.
FORMS = ["owl", "shacl", "jsonld-context", "json-schema", "python-types"]


def register_adapter(form: str, adapter: Adapter) -> None:
    """Makes ``adapter`` the emitter of ``form``."""
    ADAPTERS[form] = adapter


def get_adapter(form: str) -> Adapter:
    if form not in ADAPTERS:
        raise ValueError(f"unknown form {form!r}; there are {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[form]


def _adapter(form: str) -> Callable[[Adapter], Adapter]:
    def add(f: Adapter) -> Adapter:
        register_adapter(form, f)
        return f

    return add


def _file(form: str, path: Column, content: Column, *keys: str) -> list[Column]:
    return ["doc_id", F.lit(form).alias("form"), path.alias("path"), content.alias("content"), *keys]


def _joined(lines: DataFrame, *keys: str, order: list[str]) -> DataFrame:
    """(…keys, content): the lines of each key in order."""
    return lines.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "line"))), lambda x: x["line"]), "\n").alias("content"))


#: Most lines of triples in one file; a larger graph is written as several, by the hash of the line.
MOST_LINES = 1_000_000


def _graphs(lines: DataFrame, *keys: str) -> DataFrame:
    """(…keys, part, content): the lines of each graph, sorted. ``part`` ends the name of a file, and is empty but for graphs of many files."""
    size = lines.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.ceil(F.count("*") / MOST_LINES).alias("_files"))
    if not size.where("_files > 1").limit(1).count():
        return _joined(lines.withColumn("part", F.lit("")), *keys, "part", order=[])
    x = lines.join(size, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]))
    x = x.withColumn("part", F.when(F.col("_files") == 1, "").otherwise(F.format_string("-%05d", F.pmod(F.xxhash64("line"), "_files"))))
    return _joined(x.select(*keys, "part", "line"), *keys, "part", order=[])


def _with_full(lines: DataFrame) -> DataFrame:
    """The lines of each graph, which are distinct in it, and those of all together, as graph ``full``."""
    own = written(lines)
    return own.unionByName(own.select("doc_id", F.lit("full").alias("graph"), "line").distinct())


@lru_cache(4)
def merged(m: Model) -> Model:
    """The model with its packages merged, worked out once for all emitters."""
    return materialised(resolve.merged_packages(materialised(m)))


@lru_cache(4)
def tidy(m: Model) -> Model:
    """The model with its packages merged and its classes deduplicated, worked out once for all emitters."""
    return materialised(resolve.without_copies(merged(m)))


def _quoted(c: Column) -> Column:
    """A text as JSON."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


frames.on_clear(merged.cache_clear, tidy.cache_clear)  # what they hold is read from tables that clear deletes


def _object(pairs: Column) -> Column:
    """A JSON object of an array of texts ``"key":value``."""
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def _pair(key: Column, value: Column) -> Column:
    return F.concat(_quoted(key), F.lit(":"), value)


def owl_graphs(m: Model) -> DataFrame:
    """Triples of one graph for each package with a named class (in the order of ``package_order``); packages are merged, classes are not deduplicated. Each graph lists
    the packages it imports."""
    own = merged(m)
    full = own.classes.where(~N.blank(F.col("name"))).select("doc_id", "pkg_ord").distinct()
    kept = own.with_(package=own.package.join(full, ["doc_id", "pkg_ord"], "left_semi"))
    refs = resolve.cross_package_refs(kept).select("doc_id", F.col("from_package").alias("graph"), "to_package").distinct()
    node = lambda c: F.concat(F.lit(triples.NS.rstrip("#") + "_"), c)
    imports = triples.expand(refs, F.col("graph"), triples.iri(node(F.col("graph")), triples.OWL + "imports", node(F.col("to_package"))))
    return triples.owl(kept).unionByName(imports)


@_adapter("owl")
def owl(m: Model) -> DataFrame:
    """The graphs of ``owl_graphs`` in N-Triples."""
    every = _with_full(triples.lines(owl_graphs(m)))
    return _graphs(every, "doc_id", "graph").select(*_file("owl", F.concat(F.lit("cim17_"), "graph", "part", F.lit(".nt")), F.col("content")))


@_adapter("turtle")
def turtle(m: Model) -> DataFrame:
    """The same graphs in Turtle, with prefixes and one triple a line."""
    every = _with_full(triples.turtle_lines(owl_graphs(m)))
    content = F.concat(F.lit(triples.PREFIX_LINES), F.col("content"), F.lit("\n"))
    return _graphs(every, "doc_id", "graph").select(*_file("turtle", F.concat(F.lit("cim17_"), "graph", "part", F.lit(".ttl")), content))


@_adapter("shacl")
def shacl(m: Model) -> DataFrame:
    """One file of all shapes; packages are neither merged nor classes deduplicated."""
    return _graphs(written(triples.lines(triples.shacl(m))), "doc_id").select(*_file("shacl", F.concat(F.lit("cim17_shapes"), "part", F.lit(".nt")), F.col("content")))


def context_terms(m: Model) -> DataFrame:
    """(doc_id, pkg_ord, package, term, id, kind) of the terms of each package's JSON-LD context: attributes and associations class by class, the
    later one of a name winning, and classes above all."""
    own = m.named().select(*CLASS_KEY, "package", F.col("name").alias("class_name")).where("class_name is not null")
    name = F.col("name")
    a = m.attribute.where(~N.blank(name) & ~N.has_ocr_noise(name) & N.has_ascii(name)).join(own, CLASS_KEY).select(*CLASS_KEY, "package", "class_name", F.lit(0).alias("phase"), F.col("attr_ord").alias("ord"), name.alias("term"), D.normalize_xsd(F.col("data_type")).alias("kind"))
    s = m.association.where(F.col("name").isNotNull() & F.coalesce(F.col("target.class_name").rlike(r"^\p{Lu}"), F.lit(False))).join(own, CLASS_KEY).select(*CLASS_KEY, "package", "class_name", F.lit(1).alias("phase"), F.col("assoc_ord").alias("ord"), name.alias("term"), F.lit("@id").alias("kind"))
    members = a.unionByName(s).withColumn("id", F.concat(F.lit("cim:"), "class_name", F.lit("."), "term")).withColumn("top", F.lit(0))
    c = own.where((F.col("class_name") != "") & ~N.has_ocr_noise(F.col("class_name"))).select(*CLASS_KEY, "package", "class_name", F.lit(2).alias("phase"), F.lit(0).alias("ord"), F.col("class_name").alias("term"), F.lit("@id").alias("kind"), F.concat(F.lit("cim:"), "class_name").alias("id"), F.lit(1).alias("top"))
    best = F.max_by(F.struct("id", "kind"), F.struct("top", "cls_ord", "phase", "ord"))
    return members.unionByName(c).groupBy("doc_id", "pkg_ord", "package", "term").agg(best.alias("v")).select("doc_id", "pkg_ord", "package", "term", "v.id", "v.kind")


@_adapter("jsonld-context")
def jsonld_context(m: Model) -> DataFrame:
    t = tidy(m)
    head = [("@vocab", triples.NS), ("cim", triples.NS), ("rdf", triples.RDF), ("xsd", triples.XSD)]
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("term", "id", "kind"))), lambda x: _pair(x["term"], F.to_json(F.struct(x["id"].alias("@id"), x["kind"].alias("@type")))))
    fixed = F.array(*[F.lit(f'"{k}":"{v}"') for k, v in head])
    g = t.package.select("doc_id", "pkg_ord", F.col("name").alias("package")).join(context_terms(t).drop("package").where(~F.col("term").isin([k for k, _ in head])).groupBy("doc_id", "pkg_ord").agg(pairs.alias("pairs")), ["doc_id", "pkg_ord"], "left")
    content = F.concat(F.lit('{"@context":'), _object(F.concat(fixed, F.coalesce("pairs", F.array().cast("array<string>")))), F.lit("}"))
    return g.select(*_file("jsonld-context", F.concat("package", F.lit("_context.jsonld")), content))


def schema_fields(m: Model) -> DataFrame:
    """(…class key, slug, value, required) of the fields of each class: attributes with their JSON type, associations with a capital target as
    references; of one slug the last counts, in the place of the first."""
    a = m.attribute.where(~N.is_separator(F.col("name"))).select(*CLASS_KEY, F.lit(0).alias("phase"), F.col("attr_ord").alias("ord"), N.attribute_slug(F.col("name")).alias("slug"), F.to_json(F.struct(*D.json_kind(F.col("data_type")), F.when(F.col("description") != "", F.col("description")).alias("description"))).alias("value"), F.coalesce("required", F.lit(False)).alias("required"))
    target = F.col("target.class_name")
    s = m.association.where(~N.is_separator(F.col("name")) & F.coalesce(target.rlike(r"^\p{Lu}"), F.lit(False))).select(*CLASS_KEY, F.lit(1).alias("phase"), F.col("assoc_ord").alias("ord"), N.attribute_slug(F.col("name")).alias("slug"), F.to_json(F.struct(F.concat(F.lit("#/properties/"), target).alias("$ref"))).alias("value"), F.lit(False).alias("required"))
    place = F.struct("phase", "ord")
    return a.unionByName(s).groupBy(*CLASS_KEY, "slug").agg(F.min(place).alias("first"), F.max_by("value", place).alias("value"), F.max("required").alias("required"))


@_adapter("json-schema")
def json_schema(m: Model) -> DataFrame:
    t = tidy(m)
    f = schema_fields(t).groupBy(*CLASS_KEY).agg(F.array_sort(F.collect_list(F.struct("first", "slug", "value", "required"))).alias("f"))
    c = t.classes.where("name is not null").join(f, CLASS_KEY, "left").withColumn("f", F.coalesce("f", F.array().cast("array<struct<first:struct<phase:int,ord:int>,slug:string,value:string,required:boolean>>")))
    fields = _object(F.transform("f", lambda x: _pair(x["slug"], x["value"])))
    required = F.transform(F.filter("f", lambda x: x["required"]), lambda x: _quoted(x["slug"]))
    body = F.concat(F.lit('{"type":"object","properties":'), fields, F.when(F.size(required) > 0, F.concat(F.lit(',"required":['), F.array_join(required, ","), F.lit("]"))).otherwise(""), F.lit("}"))
    of = c.groupBy("doc_id", "pkg_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("cls_ord", _pair(F.col("name"), body).alias("t")))), lambda x: x["t"]).alias("classes"))
    g = t.package.join(of, ["doc_id", "pkg_ord"], "left").where("name is not null")
    content = F.concat(F.lit('{"$schema":"http://json-schema.org/draft-07/schema#","title":'), _quoted(F.concat(F.lit("CIM "), "name")), F.lit(',"type":"object","properties":'), _object(F.coalesce("classes", F.array().cast("array<string>"))), F.lit("}"))
    return g.select(*_file("json-schema", F.concat("name", F.lit("_schema.json")), content))


def checked_package_names(m: Model) -> DataFrame:
    """The packages; a name that isn't fit for a module raises an error when the rows are read."""
    ok = N.is_identifier(F.col("name")) & ~N.has_ocr_noise(F.col("name"))
    return m.package.withColumn("name", F.when(ok, F.col("name")).otherwise(F.raise_error(F.concat(F.lit("no package name: "), F.coalesce("name", F.lit("null")))).cast("string")))


@_adapter("python-types")
def python_types(m: Model, required_first: bool = True) -> DataFrame:
    """One module for each package: imports of what its classes name in others, and a dataclass for each class. Required fields come first, as
    Python asks for; in the order of the model if ``required_first`` is off. Members without a proper name are left out."""
    t = tidy(m)
    t = t.with_(package=checked_package_names(t))
    name = F.col("name")
    fit = N.is_identifier(name) & ~N.has_ocr_noise(name)
    hint = D.python_type(F.col("data_type"))
    line = F.when(F.col("required"), F.concat(F.lit("    "), name, F.lit(": "), hint)).otherwise(F.concat(F.lit("    "), name, F.lit(": Optional["), hint, F.lit("] = None")))
    late = F.when(F.lit(required_first) & ~F.coalesce("required", F.lit(False)), 1).otherwise(0)
    a = t.attribute.where(fit).select(*CLASS_KEY, F.lit(2).alias("phase"), late.alias("late"), F.col("attr_ord").alias("ord"), line.alias("line"))
    target = F.col("target.class_name")
    s = t.association.where(fit & N.is_identifier(target)).select(*CLASS_KEY, F.lit(3).alias("phase"), F.lit(1).alias("late"), F.col("assoc_ord").alias("ord"), F.concat(F.lit("    "), name, F.lit(": Optional['"), target, F.lit("'] = None")).alias("line"))
    c = t.classes.where(fit)
    heads = c.select(*CLASS_KEY, F.lit(1).alias("phase"), F.lit(0).alias("late"), F.lit(0).alias("ord"), F.concat(F.lit("@dataclass\nclass "), name, F.lit(':\n    rdf_type: ClassVar[str] = "cim:'), name, F.lit('"')).alias("line"))
    bare = c.join(t.attribute.where(fit).select(*CLASS_KEY).distinct(), CLASS_KEY, "left_anti").select(*CLASS_KEY, F.lit(4).alias("phase"), F.lit(0).alias("late"), F.lit(0).alias("ord"), F.lit("    pass").alias("line"))
    ends = c.select(*CLASS_KEY, F.lit(5).alias("phase"), F.lit(0).alias("late"), F.lit(0).alias("ord"), F.lit("").alias("line"))
    members = a.unionByName(s).join(c.select(*CLASS_KEY), CLASS_KEY, "left_semi")
    body = heads.unionByName(members).unionByName(bare).unionByName(ends)
    own = t.package.select("doc_id", "pkg_ord", F.col("name").alias("package"))
    refs = resolve.cross_package_refs(t).where(N.is_identifier(F.col("via_class"))).groupBy("doc_id", F.col("from_package").alias("package"), "to_package").agg(F.array_join(F.array_sort(F.collect_set("via_class")), ", ").alias("names"))
    imports = refs.join(own, ["doc_id", "package"]).select("doc_id", "pkg_ord", F.lit(-1).alias("cls_ord"), F.lit(0).alias("phase"), F.lit(1).alias("late"), F.lit(0).alias("ord"), F.concat(F.lit("from "), "to_package", F.lit("_types import "), "names").alias("line"))
    head = F.concat(F.lit("# Generated from package "), "package", F.lit("\nfrom __future__ import annotations\nfrom dataclasses import dataclass\nfrom typing import ClassVar, Optional\n"))
    tops = own.select("doc_id", "pkg_ord", F.lit(-1).alias("cls_ord"), F.lit(0).alias("phase"), F.lit(0).alias("late"), F.lit(0).alias("ord"), head.alias("line"))
    files = _joined(tops.unionByName(imports).unionByName(body), "doc_id", "pkg_ord", order=["cls_ord", "phase", "late", "ord"]).join(own, ["doc_id", "pkg_ord"])
    return files.select(*_file("python-types", F.concat("package", F.lit("_types.py")), F.col("content")))


def package_order(m: Model) -> DataFrame:
    """(doc_id, package, rank): the packages that are emitted, Core first, the others in the order of the model."""
    own = merged(m)
    full = own.classes.where(~N.blank(F.col("name"))).select("doc_id", "pkg_ord").distinct()
    p = own.package.join(full, ["doc_id", "pkg_ord"], "left_semi").select("doc_id", "pkg_ord", F.col("name").alias("package"), (F.col("name") != "Core").cast("int").alias("later"))
    return frames.ranked(p, ["doc_id"], ["later", "pkg_ord"], "rank").select("doc_id", "package", F.col("rank").cast("int").alias("rank"))


def module_order(m: Model) -> DataFrame:
    """(doc_id, id, rank): packages in the order of their dependencies, each after those it names; by name where they depend on each other."""
    t = tidy(m)
    nodes = t.package.groupBy("doc_id", F.col("name").alias("id")).agg(F.min("pkg_ord").alias("ord")).where("id is not null")
    edges = resolve.cross_package_refs(t).select("doc_id", F.col("to_package").alias("a"), F.col("from_package").alias("b"))
    return graph.emit_order(nodes, edges, ["doc_id"])


def emitted(m: Model, forms: list[str] | None = None) -> DataFrame:
    """The files of the given forms, by default of ``FORMS``. Each form is written by itself: one plan of all would take its memory in the driver at
    once."""
    forms = list(forms or FORMS)
    if {"jsonld-context", "json-schema", "python-types"} & set(forms):
        tidy(m)  # what several forms share comes first
    elif {"owl", "turtle"} & set(forms):
        merged(m)
    each = lambda f: written(get_adapter(f)(m).drop("form")).select("doc_id", F.lit(f).alias("form"), "path", "content")
    parts = frames.together(*[partial(each, f) for f in forms])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verified(files: DataFrame) -> DataFrame:
    """(doc_id, form, path, issue) of files that can't be read back: JSON that doesn't parse or lacks its top key, triples of another shape."""
    json = F.try_parse_json("content")
    lacks = lambda k: F.try_variant_get(json, f"$['{k}']", "variant").isNull()
    ill = F.exists(F.split("content", "\n"), lambda x: ~x.rlike(triples.LINE))
    issue = (
        F.when(F.col("form").isin("jsonld-context", "json-schema") & json.isNull(), "no JSON")
        .when((F.col("form") == "jsonld-context") & lacks("@context"), "no @context")
        .when((F.col("form") == "json-schema") & lacks("properties"), "no properties")
        .when(F.col("form").isin("owl", "shacl") & ill, "no triples")
        .when((F.col("form") == "turtle") & F.exists(F.split("content", "\n"), lambda x: (x != "") & ~x.startswith("@prefix ") & ~x.rlike(triples.TURTLE_LINE)), "no triples")
        .when((F.col("form") == "python-types") & ~F.col("content").contains("from dataclasses import dataclass"), "no module")
    )
    return files.select("doc_id", "form", "path", issue.alias("issue")).where("issue is not null")
