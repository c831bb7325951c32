"""The model as triples (doc_id, graph, s, p, o, o_kind, o_lang, o_datatype), and as lines of N-Triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import datatypes as D
from ..functions import names as N
from ..plans.model import CLASS_KEY, Model

# Namespaces of the output.
NS = "http://iec.ch/TC57/2024/CIM-schema-cim17#"
RDF, RDFS = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2000/01/rdf-schema#"
OWL, SH, XSD = "http://www.w3.org/2002/07/owl#", "http://www.w3.org/ns/shacl#", "http://www.w3.org/2001/XMLSchema#"
NAME_MOST = 64


def iri(s: Column, p: str, o: Column) -> Column:
    return F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_lang"), F.lit(None).cast("string").alias("o_datatype"))


def literal(s: Column, p: str, o: Column, lang: str | None = None, datatype: str | None = None) -> Column:
    return F.struct(s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit("literal").alias("o_kind"), F.lit(lang).cast("string").alias("o_lang"), F.lit(datatype).cast("string").alias("o_datatype"))


def expand(df: DataFrame, graph: Column, *triples: Column) -> DataFrame:
    """One row a triple of each row; a triple without subject or object is left out."""
    there = F.filter(F.array(*triples), lambda t: t["s"].isNotNull() & t["o"].isNotNull())
    return df.select("doc_id", graph.alias("graph"), there.alias("t")).select("doc_id", "graph", F.explode("t").alias("t")).select("doc_id", "graph", "t.*")


def _at(c: Column) -> Column:
    return F.concat(F.lit(NS), c)


def _some(c: Column) -> Column:
    return F.when(c != "", c)


def owl(m: Model, keep_prefixed: bool = True) -> DataFrame:
    """Classes, datatype properties and object properties, each package a graph; a triple stands once in a graph. Properties whose names are
    blank, noisy or no identifiers are left out; ``keep_prefixed`` as in ``xsd_range``."""
    named = m.named().where("name is not null")
    pkg = F.concat(F.lit(NS.rstrip("#") + "_"), F.col("package"))
    cls = _at(F.col("class_name"))
    c = named.withColumnRenamed("name", "class_name")
    stereotype = F.concat(F.lit("stereotype: "), _some(F.col("stereotype")))
    classes = expand(c, F.col("package"), iri(cls, RDF + "type", F.lit(OWL + "Class")), literal(cls, RDFS + "label", F.col("class_name"), "en"), iri(cls, RDFS + "isDefinedBy", pkg), literal(cls, RDFS + "comment", _some(F.col("description")), "zh"), literal(cls, RDFS + "comment", stereotype, "en"))
    own = c.select(*CLASS_KEY, "package", "class_name")
    parents = expand(m.parent.withColumnRenamed("class_name", "up").drop("package").join(own, CLASS_KEY), F.col("package"), iri(cls, RDFS + "subClassOf", _at(_some(F.col("up")))))
    prop = N.property_iri(F.col("class_name"), F.col("name"), NS)
    label = F.left(F.col("name"), F.lit(NAME_MOST))
    xsd = D.xsd_range(F.col("data_type"), keep_prefixed)
    rng = F.when(xsd.startswith("xsd:"), F.concat(F.lit(XSD), F.substring(xsd, 5, 2**31 - 1))).otherwise(xsd)
    attributes = expand(m.attribute.join(own, CLASS_KEY), F.col("package"), iri(prop, RDF + "type", F.lit(OWL + "DatatypeProperty")), literal(prop, RDFS + "label", label, "en"), iri(prop, RDFS + "domain", cls), iri(prop, RDFS + "range", rng), literal(prop, RDFS + "comment", F.when(F.col("required"), "required (min >= 1)"), "en"))
    target = F.when(F.coalesce(F.col("target.class_name").rlike(N.IDENTIFIER), F.lit(False)), _at(F.col("target.class_name")))
    associations = expand(m.association.join(own, CLASS_KEY), F.col("package"), iri(prop, RDF + "type", F.lit(OWL + "ObjectProperty")), literal(prop, RDFS + "label", label, "en"), iri(prop, RDFS + "domain", cls), iri(prop, RDFS + "range", target))
    return classes.unionByName(parents).unionByName(attributes).unionByName(associations).dropDuplicates()


def shacl(m: Model, xsd_names: bool = True) -> DataFrame:
    """Node and property shapes of every class with a safe name. With ``xsd_names`` a type with the prefix ``xsd:`` is its XSD name; without,
    such types are left out, as the model's first publisher did."""
    c = m.named().where(N.is_safe_iri_part(F.col("name"))).select(*CLASS_KEY, F.col("name").alias("class_name"))
    graph = F.lit("shapes")
    shape = F.concat(F.lit(NS + "shape_"), F.col("class_name"))
    nodes = expand(c, graph, iri(shape, RDF + "type", F.lit(SH + "NodeShape")), iri(shape, SH + "targetClass", _at(F.col("class_name"))))
    prop = F.concat(shape, F.lit("_"), F.col("name"))
    path = _at(F.concat(F.col("class_name"), F.lit("."), F.col("name")))
    count = lambda name, v: literal(prop, SH + name, v, None, XSD + "integer")
    bare = F.when(N.is_safe_iri_part(F.col("data_type")), F.col("data_type"))
    kind = F.coalesce(F.when(F.lit(xsd_names) & F.col("data_type").startswith("xsd:"), F.concat(F.lit(XSD), F.substring("data_type", 5, 2**31 - 1))), bare)
    a = m.attribute.where(N.is_safe_iri_part(F.col("name"))).join(c, CLASS_KEY)
    attributes = expand(a, graph, iri(shape, SH + "property", prop), iri(prop, SH + "path", path), iri(prop, SH + "datatype", kind), count("minCount", F.when(F.col("required"), 1)), count("maxCount", F.col("multiplicity.max")))
    t = F.col("target.class_name")
    s = m.association.where(N.is_safe_iri_part(F.col("name")) & N.is_safe_iri_part(t)).join(c, CLASS_KEY)
    associations = expand(s, graph, iri(shape, SH + "property", prop), iri(prop, SH + "path", path), iri(prop, SH + "class", _at(t)), count("minCount", F.col("multiplicity.min")), count("maxCount", F.col("multiplicity.max")))
    return nodes.unionByName(attributes).unionByName(associations).dropDuplicates()


def match(triples: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
    """The triples with the given parts."""
    for name, v in (("s", s), ("p", p), ("o", o)):
        if v is not None:
            triples = triples.where(F.col(name) == v)
    return triples


def _quoted(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), c, F.lit('"'))


def lines(triples: DataFrame) -> DataFrame:
    """(doc_id, graph, line) in N-Triples."""
    tail = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), "o_lang")).when(F.col("o_datatype").isNotNull(), F.concat(F.lit("^^<"), "o_datatype", F.lit(">"))).otherwise("")
    o = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), "o", F.lit(">"))).otherwise(F.concat(_quoted(F.col("o")), tail))
    return triples.select("doc_id", "graph", F.concat(F.lit("<"), "s", F.lit("> <"), "p", F.lit("> "), o, F.lit(" .")).alias("line"))


# Fixed value: a line of N-Triples.
LINE = r'^<([^<>"{}|^`\\]*)> <([^<>"{}|^`\\]*)> (?:<([^<>"{}|^`\\]*)>|"((?:[^"\\\n\r]|\\.)*)"(?:@([A-Za-z\-]+)|\^\^<([^<>]*)>)?) \.\z'


def parsed(text: DataFrame) -> DataFrame:
    """Triples of (doc_id, graph, line); a line that is none has a null subject, for ``verify``."""
    part = lambda k: F.regexp_extract("line", LINE, k)
    ok = F.col("line").rlike(LINE)
    back = part(4)
    for a, b in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"')):
        back = F.replace(back, F.lit(a), F.lit(b))
    is_iri = F.col("line").rlike(r"^<[^>]*> <[^>]*> <")
    return text.select(
        "doc_id", "graph", F.when(ok, part(1)).alias("s"), F.when(ok, part(2)).alias("p"), F.when(ok, F.when(is_iri, part(3)).otherwise(F.replace(back, F.lit("\\\\"), F.lit("\\")))).alias("o"),
        F.when(ok, F.when(is_iri, "iri").otherwise("literal")).alias("o_kind"), F.when(part(5) != "", part(5)).alias("o_lang"), F.when(part(6) != "", part(6)).alias("o_datatype"),
    )


# Prefixes of Turtle output.
PREFIXES = {"cim": NS, "rdf": RDF, "rdfs": RDFS, "owl": OWL, "sh": SH, "xsd": XSD}
PREFIX_LINES = "".join(f"@prefix {p}: <{n}> .\n" for p, n in PREFIXES.items())
_NAME = r"[A-Za-z_][A-Za-z0-9_\-]*(?:\.[A-Za-z0-9_\-]+)*"
_TERM = rf'(?:<[^<>"{{}}|^`\\]*>|(?:{"|".join(PREFIXES)}):{_NAME})'
TURTLE_LINE = rf'^({_TERM}) ({_TERM}) (?:({_TERM})|"((?:[^"\\\n\r]|\\.)*)"(?:@([A-Za-z\-]+)|\^\^({_TERM}))?) \.\z'


def _short(c: Column) -> Column:
    """An IRI by its prefix, if what follows is a plain name."""
    out = F.concat(F.lit("<"), c, F.lit(">"))
    for p, n in PREFIXES.items():
        rest = F.substring(c, len(n) + 1, 2**31 - 1)
        out = F.when(c.startswith(n) & rest.rlike(rf"^{_NAME}\z"), F.concat(F.lit(f"{p}:"), rest)).otherwise(out)
    return out


def _long(c: Column) -> Column:
    """The IRI of a term of Turtle."""
    known = F.create_map(*[F.lit(x) for kv in PREFIXES.items() for x in kv])
    return F.when(c.startswith("<"), F.substring(c, 2, F.length(c) - 2)).otherwise(F.concat(F.try_element_at(known, F.substring_index(c, ":", 1)), F.regexp_extract(c, "(?s)^[^:]*:(.*)$", 1)))


def turtle_lines(triples: DataFrame) -> DataFrame:
    """(doc_id, graph, line) in Turtle, one triple a line; ``PREFIX_LINES`` go before them."""
    tail = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), "o_lang")).when(F.col("o_datatype").isNotNull(), F.concat(F.lit("^^"), _short(F.col("o_datatype")))).otherwise("")
    o = F.when(F.col("o_kind") == "iri", _short(F.col("o"))).otherwise(F.concat(_quoted(F.col("o")), tail))
    return triples.select("doc_id", "graph", F.concat(_short(F.col("s")), F.lit(" "), _short(F.col("p")), F.lit(" "), o, F.lit(" .")).alias("line"))


def turtle_parsed(text: DataFrame) -> DataFrame:
    """Triples of (doc_id, graph, line) as ``turtle_lines`` writes them; lines of prefixes have none, and a line that is no triple has a null subject."""
    part = lambda k: F.regexp_extract("line", TURTLE_LINE, k)
    angle = lambda c: F.concat(F.lit("<"), _long(c), F.lit(">"))
    kind = F.when(part(6) != "", F.concat(F.lit("^^"), angle(part(6)))).when(part(5) != "", F.concat(F.lit("@"), part(5))).otherwise("")
    o = F.when(part(3) != "", angle(part(3))).otherwise(F.concat(F.lit('"'), part(4), F.lit('"'), kind))
    line = F.when(F.col("line").rlike(TURTLE_LINE), F.concat(angle(part(1)), F.lit(" "), angle(part(2)), F.lit(" "), o, F.lit(" ."))).otherwise(F.col("line"))
    return parsed(text.where(~F.col("line").startswith("@prefix ") & (F.col("line") != "")).withColumn("line", line))
