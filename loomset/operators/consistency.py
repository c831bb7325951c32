"""Agreement of every emitted form with the model: what each form holds, samples of classes, and where they differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..frames import written
from ..functions.names import blank, local_name
from . import review
from .triples import OWL, RDF, SH

FORMATS = ["owl", "shacl", "json-schema", "jsonld-context", "python-types"]


def stratified_sample(rows: DataFrame, stratum: str, name: str, n: int = 25, seed: int = 42) -> DataFrame:
    """At most ``n`` rows of each stratum without replacement, blank names left out: those of the least md5(seed, name), ties by name. The choice
    depends on names and seed only. A stratum of any size is cut down by its own tasks first, by a salt, before one task ranks what is left."""
    x = rows.where(~blank(F.col(name))).withColumn("_k", F.md5(F.concat(F.lit(f"{seed}:"), name)))
    salted = Window.partitionBy(stratum, F.pmod(F.xxhash64(name), F.lit(64))).orderBy("_k", name)
    x = x.withColumn("_r", F.row_number().over(salted)).where(F.col("_r") <= n)
    return x.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy("_k", name))).where(F.col("_r") <= n).drop("_k", "_r")


def triples_classes(triples: DataFrame, form: str) -> DataFrame:
    """(doc_id, form, class_name) of the classes in OWL or SHACL triples."""
    if form == "owl":
        x = triples.where((F.col("p") == RDF + "type") & (F.col("o") == OWL + "Class")).select("doc_id", local_name(F.col("s")).alias("class_name"))
    else:
        x = triples.where(F.col("p") == SH + "targetClass").select("doc_id", local_name(F.col("o")).alias("class_name"))
    return x.select("doc_id", F.lit(form).alias("form"), "class_name").distinct()


def text_classes(files: DataFrame, form: str, strict: bool = False) -> DataFrame:
    """(doc_id, form, class_name) of the classes in emitted files (doc_id, content): keys of a JSON schema (looked for under ``definitions``, where
    the emitter never wrote them, if ``strict``), of a JSON-LD context, or classes of Python source."""
    if form == "python-types":
        names = F.regexp_extract_all("content", F.lit(r"(?m)^class (\w+)"), F.lit(1))
    else:
        top = "@context" if form == "jsonld-context" else "definitions" if strict else "properties"
        names = F.map_keys(F.try_variant_get(F.try_parse_json("content"), f"$['{top}']", "map<string,variant>"))
    return files.select("doc_id", F.lit(form).alias("form"), F.explode(names).alias("class_name")).distinct()


def probed(samples: DataFrame, present: DataFrame, forms: list[str] = FORMATS) -> DataFrame:
    """(doc_id, package, class_name, found MAP<form, BOOLEAN>, missing ARRAY): which forms hold each sampled class; one join for all forms."""
    p = present.groupBy("doc_id", "class_name").agg(F.collect_set("form").alias("forms"))
    x = samples.join(p, ["doc_id", "class_name"], "left").withColumn("forms", F.coalesce("forms", F.array().cast("array<string>")))
    return x.select("doc_id", "package", "class_name", F.array(*[F.struct(F.lit(f).alias("form"), F.array_contains("forms", f).alias("found")) for f in forms]).alias("found"), F.array_compact(F.array(*[F.when(~F.array_contains("forms", f), F.lit(f)) for f in forms])).alias("missing"))


def matrix(probes: DataFrame, forms: list[str] = FORMATS) -> DataFrame:
    """(package, samples, passed, pass_rate, one count of found classes a form) of each package."""
    counts = [F.count_if(~F.array_contains("missing", f)).alias(f.replace("-", "_")) for f in forms]
    g = probes.groupBy("package").agg(F.count("*").alias("samples"), F.count_if(F.size("missing") == 0).alias("passed"), *counts)
    return g.withColumn("pass_rate", F.coalesce(F.try_divide("passed", "samples"), F.lit(0.0)))


def passed_names(probes: DataFrame) -> DataFrame:
    """Class names without an inconsistent sample; samples of one name share their fate."""
    return probes.groupBy("class_name").agg(F.count_if(F.size("missing") > 0).alias("bad")).where("bad = 0").select("class_name")


def compared_outputs(before: DataFrame, after: DataFrame) -> DataFrame:
    """(form, files and bytes before and after, and their differences) of manifests (form, path, bytes); what is missing counts 0."""
    both = before.select("form", "bytes", F.lit(True).alias("first")).unionByName(after.select("form", "bytes", F.lit(False).alias("first")))
    count = lambda c, n: (F.count_if(c).alias(f"files_{n}"), F.coalesce(F.sum(F.when(c, F.col("bytes"))), F.lit(0)).alias(f"bytes_{n}"))
    x = both.groupBy("form").agg(*count(F.col("first"), "before"), *count(~F.col("first"), "after"))
    return x.withColumn("files_delta", F.col("files_after") - F.col("files_before")).withColumn("bytes_delta", F.col("bytes_after") - F.col("bytes_before"))


def triples_members(triples: DataFrame, namespace: str) -> DataFrame:
    """(doc_id, class_name, kind, name, value) of the attributes and associations in OWL triples: value is the local name of the range."""
    from .triples import RDFS

    wide = triples.where(F.col("p").isin(RDF + "type", RDFS + "range")).groupBy("doc_id", "graph", "s").agg(F.max(F.when(F.col("p") == RDF + "type", local_name(F.col("o")))).alias("kind"), F.max(F.when(F.col("p") == RDFS + "range", local_name(F.col("o")))).alias("value"))
    own = local_name(F.col("s"))
    kind = F.when(F.col("kind") == "DatatypeProperty", "attribute").otherwise("association")
    return wide.where(F.col("kind").isin("DatatypeProperty", "ObjectProperty")).select("doc_id", F.substring_index(own, ".", 1).alias("class_name"), kind.alias("kind"), F.expr("substring(substring_index(substring_index(s, '#', -1), '/', -1), instr(substring_index(substring_index(s, '#', -1), '/', -1), '.') + 1)").alias("name"), "value").distinct()


# Fixed value: answers below this confidence don't count.
LEAST_CONFIDENCE = 0.5


_MISSING = "map<string,array<string>>"


def semantic_findings(answers: DataFrame) -> DataFrame:
    """(class_iri, consistent, missing_attrs, missing_assocs, multiplicity_mismatch, notes, confidence, outcome) of review answers (class_iri, response):
    outcome is ok, json_invalid (no object), invalid_format (without ``missing_attrs`` or ``missing_assocs``) or low_confidence. What is missing is
    listed by form; an answer may name the class otherwise."""
    v = F.try_parse_json("response")
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    has = lambda k: F.coalesce(F.map_contains_key(fields, F.lit(k)), F.lit(False))
    sure = F.coalesce(F.try_variant_get(v, "$.confidence", "double"), F.lit(0.0))
    outcome = F.when(fields.isNull(), "json_invalid").when(~(has("missing_attrs") & has("missing_assocs")), "invalid_format").when(sure < LEAST_CONFIDENCE, "low_confidence").otherwise("ok")
    return answers.select(
        F.coalesce(F.try_variant_get(v, "$.class_iri", "string"), "class_iri").alias("class_iri"), F.try_variant_get(v, "$.consistent", "boolean").alias("consistent"),
        F.try_variant_get(v, "$.missing_attrs", _MISSING).alias("missing_attrs"), F.try_variant_get(v, "$.missing_assocs", _MISSING).alias("missing_assocs"), F.try_variant_get(v, "$.multiplicity_mismatch", "array<string>").alias("multiplicity_mismatch"),
        F.try_variant_get(v, "$.notes", "string").alias("notes"), sure.alias("confidence"), outcome.alias("outcome"),
    )


SEMANTIC = """Compare what each output form holds of this class with the model, which is the truth.
Answer with one JSON object and nothing else:
{"class_iri": "...", "consistent": true, "missing_attrs": {"form": ["attribute"]}, "missing_assocs": {"form": ["association"]}, "multiplicity_mismatch": ["form:attribute m1 vs m2"], "notes": "...", "confidence": 0.0}
missing_attrs and missing_assocs list what the model has and the form lacks; consistent is true if all forms agree with the model; confidence is from 0 to 1."""


def semantic_prompts(samples: DataFrame, model_members: DataFrame, form_members: DataFrame, forms: list[str] = FORMATS) -> DataFrame:
    """(doc_id, class_name, class_iri, case_id, prompt) of sampled classes (doc_id, class_name, class_iri) of the model: the members that the model
    has, (doc_id, class_name, kind, name), and those that each form has, (doc_id, form, class_name, kind, name, value). A form without any
    member of a class says so."""
    names = lambda x, kind: F.coalesce(F.nullif(F.array_join(F.array_sort(F.array_distinct(F.filter(x, lambda m: m["kind"] == kind)["t"])), ", "), F.lit("")), F.lit("none"))
    own = model_members.groupBy("doc_id", "class_name").agg(F.collect_list(F.struct("kind", F.col("name").alias("t"))).alias("m"))
    target = F.when(F.col("kind") == "association", F.concat_ws("->", "name", "value")).otherwise(F.col("name"))
    per = form_members.groupBy("doc_id", "class_name", "form").agg(F.collect_list(F.struct("kind", target.alias("t"))).alias("m"))
    line = F.concat(F.col("form"), F.lit(": attributes "), names("m", "attribute"), F.lit("; associations "), names("m", "association"))
    per = per.select("doc_id", "class_name", F.struct("form", line.alias("line")).alias("l")).groupBy("doc_id", "class_name").agg(F.map_from_entries(F.collect_list("l")).alias("lines"))
    x = samples.join(own, ["doc_id", "class_name"], "left").join(per, ["doc_id", "class_name"], "left")
    said = [F.coalesce(F.try_element_at("lines", F.lit(f)), F.lit(f"{f}: nothing")) for f in forms]
    model = F.concat(F.lit("Model: attributes "), F.coalesce(names("m", "attribute"), F.lit("none")), F.lit("; associations "), F.coalesce(names("m", "association"), F.lit("none")))
    text = F.concat_ws("\n", F.concat(F.lit("Class: "), "class_name"), model, *said, F.lit(SEMANTIC))
    return x.select("doc_id", "class_name", "class_iri", F.concat(F.lit("semantic:"), "class_iri").alias("case_id"), text.alias("prompt"))


def semantic_review(prompts: DataFrame, cache: DataFrame, provider: review.Provider, tries: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(findings, the responses new to the cache, counts by outcome) of ``semantic_prompts``. Cached classes aren't asked again; a call that fails
    is counted as provider_exception and has no finding. Each class iri is asked once."""
    hit, miss = review.split_by_cache(prompts.dropDuplicates(["case_id"]), cache)
    got = written(review.ask(miss.select("case_id", "prompt"), provider, tries=tries))
    iri = F.expr("substring(case_id, 10)").alias("class_iri")
    answers = hit.select(iri, "response", F.lit("hit").alias("cache")).unionByName(got.where("response is not null").select(iri, "response", F.lit("miss").alias("cache")))
    found = semantic_findings(answers)
    counts = found.groupBy("outcome").agg(F.count("*").alias("n")).unionByName(got.where("response is null").groupBy(F.lit("provider_exception").alias("outcome")).agg(F.count("*").alias("n")))
    return found, got.where("response is not null").select("case_id", "response"), counts


def semantic_section(findings: DataFrame, listed: int = 200) -> str:
    """The report's section of the semantic review: how many classes agree, and the first ``listed`` missing attributes, associations and
    differing multiplicities. Only accepted findings count."""
    ok = findings.where("outcome = 'ok'")
    odd = (F.size(F.coalesce("missing_attrs", F.map_from_arrays(F.array(), F.array()).cast(_MISSING))) > 0) | (F.size(F.coalesce("missing_assocs", F.map_from_arrays(F.array(), F.array()).cast(_MISSING))) > 0) | (F.size(F.coalesce("multiplicity_mismatch", F.array().cast("array<string>"))) > 0)
    total, differ = ok.agg(F.count("*"), F.count_if(odd)).first()
    out = ["## Semantic review", "", f"{total - differ} of {total} reviewed classes are consistent ({100 * (total - differ) / total if total else 0:.1f} %)."]
    for title, c in (("Missing attributes", "missing_attrs"), ("Missing associations", "missing_assocs")):
        rows = ok.select("class_iri", "notes", F.explode(c).alias("form", "names")).select("class_iri", "form", F.explode("names").alias("name"), "notes").orderBy("class_iri", "form", "name").limit(listed).collect()
        out += ["", f"### {title}", "", *([f"- {r.class_iri.split('#')[-1]} lacks {r.name} in {r.form}: {r.notes or ''}" for r in rows] or ["none"])]
    rows = ok.select("class_iri", "notes", F.explode("multiplicity_mismatch").alias("what")).orderBy("class_iri", "what").limit(listed).collect()
    out += ["", "### Differing multiplicities", "", *([f"- {r.class_iri.split('#')[-1]}: {r.what}: {r.notes or ''}" for r in rows] or ["none"])]
    return "\n".join(out) + "\n"


def shape_members(triples: DataFrame) -> DataFrame:
    """(doc_id, class_name, kind, name, value, multiplicity) of SHACL triples: datatype or class, and the counts as ``lo..hi``."""
    from ..functions.multiplicity import from_counts

    p = local_name(F.col("p"))
    wide = triples.groupBy("doc_id", "s").agg(*[F.max(F.when(p == n, local_name(F.col("o")))).alias(n) for n in ("path", "datatype", "class", "minCount", "maxCount")]).where("path is not null")
    return wide.select("doc_id", F.substring_index("path", ".", 1).alias("class_name"), F.when(F.col("class").isNull(), "attribute").otherwise("association").alias("kind"), F.expr("substring(path, instr(path, '.') + 1)").alias("name"), F.coalesce("class", "datatype").alias("value"), from_counts(F.col("minCount"), F.col("maxCount")).alias("multiplicity")).distinct()


def schema_members(files: DataFrame) -> DataFrame:
    """(doc_id, class_name, kind, name, value) of emitted JSON schemas: references are associations."""
    top = F.try_variant_get(F.try_parse_json("content"), "$.properties", "map<string,variant>")
    c = files.select("doc_id", F.explode(top).alias("class_name", "v")).select("doc_id", "class_name", F.explode(F.try_variant_get("v", "$.properties", "map<string,variant>")).alias("name", "f"))
    ref = F.try_variant_get("f", "$['$ref']", "string")
    return c.select("doc_id", "class_name", F.when(ref.isNull(), "attribute").otherwise("association").alias("kind"), "name", F.coalesce(F.substring_index(ref, "/", -1), F.try_variant_get("f", "$.type", "string")).alias("value")).distinct()


def source_members(files: DataFrame) -> DataFrame:
    """(doc_id, class_name, kind, name, value) of emitted Python source: a quoted type is an association."""
    parts = files.select("doc_id", F.explode(F.split("content", r"(?m)^@dataclass.*$")).alias("part")).withColumn("class_name", F.regexp_extract("part", r"(?m)^class (\w+):", 1)).where("class_name <> ''")
    lines = parts.select("doc_id", "class_name", F.explode(F.regexp_extract_all("part", F.lit(r"(?m)^    (\w+: [^\n]+)$"), F.lit(1))).alias("l")).where(~F.col("l").startswith("rdf_type:"))
    hint = F.regexp_extract("l", r"^\w+: (?:Optional\[)?'?(\w+)", 1)
    return lines.select("doc_id", "class_name", F.when(F.col("l").contains("['"), "association").otherwise("attribute").alias("kind"), F.substring_index("l", ":", 1).alias("name"), hint.alias("value")).distinct()


def differing_members(model_members: DataFrame, form_members: DataFrame) -> DataFrame:
    """(doc_id, class_name, kind, name, side) of members that only the model or only the form has."""
    key = ["doc_id", "class_name", "kind", "name"]
    a, b = model_members.select(*key).distinct(), form_members.select(*key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("model")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("form")))


def report(by_package: DataFrame, probes: DataFrame, forms: list[str] = FORMATS, listed: int = 200) -> str:
    """The matrix as Markdown, with the first ``listed`` samples that a form lacks; one row a package comes to the driver."""
    rows = sorted(by_package.collect(), key=lambda r: r.package)
    total, passed = sum(r.samples for r in rows), sum(r.passed for r in rows)
    out = ["# Consistency", "", f"{passed} of {total} samples are in every form ({100 * passed / total if total else 0:.1f} %).", "", "| package | samples | passed | " + " | ".join(forms) + " |", "|" + "-|" * (3 + len(forms))]
    out += [f"| {r.package} | {r.samples} | {r.passed} | " + " | ".join(str(r[f.replace("-", "_")]) for f in forms) + " |" for r in rows]
    lacking = probes.where(F.size("missing") > 0).orderBy("package", "class_name", "doc_id").limit(listed).collect()
    if lacking:
        out += ["", "## Missing", ""] + [f"- {r.package}::{r.class_name}: {', '.join(r.missing)}" for r in lacking]
    return "\n".join(out) + "\n"
