"""Names, types, resolution, triples, emitters, packages, review, metrics and validation on small cases."""

import importlib
import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomset import sinks
from loomset.cli import main as cli
from loomset.errors import PipelineError, Severity, configure_logging
from loomset.functions import datatypes as D
from loomset.functions import headings as H
from loomset.functions import multiplicity as M
from loomset.functions import names as N
from loomset.operators import consistency, metrics, resolve, review, triples, validate
from loomset.plans import emit
from loomset.plans.model import Model
from loomset.plans.package import Packages
from loomset.plans.pipeline import build
from loomset.sources import markdown, providers
from loomset.sources.models import PackageSource, assoc, attr, cls, cref, env_settings, from_code, ir_documents, ir_json, known_classes, multiplicity, provider_name, union_of_known, unread_documents
from loomset.operators.graph import transitive_closure
from loomset.sources.providers import Chat, Fixed, Local, Messages
from loomset.sources.reference_model import concept_map, map_concept, reference_model
from loomset.streaming.orphans import as_changes, follow


def each(spark, values, *columns):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [tuple(r)[1:] for r in df.select("k", *columns).orderBy("k").collect()]


def test_names(spark):
    v = F.col("v")
    values = [" a-b.c ", "x y", None, "", " ", "---", "|:-:|", "$\\mathcal{Z}$", "0..1", "纯中文", "a：b", "__x1", "a　b", "12"]
    got = each(spark, values, N.is_safe_iri_part(v), N.is_identifier(v), N.has_ocr_noise(v), N.is_separator(v), N.attribute_noise(v), N.is_noisy_target(v), N.attribute_slug(v), N.clean_inline(v))
    assert got[0] == (True, False, False, False, None, False, "a_b.c", "a-b.c")
    assert got[2] == (False, False, False, False, None, True, "ocr_noise_attr", None)
    assert got[3][3] is False and got[4][3] is True  # white space alone counts as a rule
    assert [g[4] for g in got[5:11]] == ["separator", "separator", "latex", None, "cjk", "mixed_punct"]
    assert got[8] == (True, False, True, False, None, True, "ocr_noise_attr", "0..1") and got[13][5] is True
    assert got[11][1] is True and got[12][7] == "a b"
    assert each(spark, ["A b--C!", "é x", "!!"], N.slug(v), N.safe_local(v)) == [("a-b-c", "A_b--C_"), ("é-x", "é_x"), ("", "__")]
    assert each(spark, ["http://x/y#Z", "a/b", None], N.local_name(v)) == [("Z",), ("b",), (None,)]


@pytest.mark.parametrize(("raw", "want"), [("1..*", (1, None, "1..*")), (" $0..n$ ", (0, None, "0..*")), ("many", (0, None, "0..*")), ("\\mathcal{ABC}2..1", (2, 1, "2..1")), ("1", None), ("", None), (None, None), ("0..1 D", None), ("0..99999999999", None)])
def test_multiplicity(spark, raw, want):
    r = each(spark, [raw], M.parse(F.col("v")), M.parse_or_optional(F.col("v")))[0]
    assert (tuple(r[0]) if r[0] else None) == want
    assert tuple(r[1]) == (want or (0, 1, raw or "0..1"))


def test_types_and_headings(spark):
    v = F.col("v")
    assert [x[0] for x in each(spark, ["String", "xsd:INT", None, " ", "Status", "datetimeinterval", "xsd:Foo"], D.normalize_xsd(v))] == ["xsd:string", "xsd:integer", "xsd:string", "xsd:string", "Status", "xsd:dateTime", "xsd:foo"]
    assert [x[0] for x in each(spark, ["http://t", "long", "xsd:date", "0..1"], D.xsd_range(v, keep_prefixed=False))] == ["http://t", "xsd:integer", "xsd:string", "xsd:string"]
    heads = ["6.2.3 Class: Measurement (Base)", "6.7.10直流母线类(DCBusbar)", "A.2.4.2.2（欧洲)SolarPowerPlant 类（SolarPower）", "7 Package Overview", "none", None, "6.2 Class Foo"]
    assert [tuple(x[0]) for x in each(spark, heads, H.parse_heading(v))] == [("6.2.3", "Measurement", "Base"), ("6.7.10", "DCBusbar", None), ("A.2.4.2.2", "SolarPower", None), ("7", None, None), ("", None, None), ("", None, None), ("6.2", "Foo", None)]
    assert each(spark, ["<TABLE><tr><td>a <b>x</b></td><th> c</th></tr><tr></tr></table><table><tr><td>z</td></tr></table>", "no"], H.html_table(v)) == [("a x|c",), ("",)]
    assert [tuple(x[0]) for x in each(spark, ["6.1.2 x", "Class: A", "x"], H.section_depth(v))] == [(3, 0.9), (3, 0.7), (2, 0.3)]


CODE = [
    PackageSource("Core", "https://x/core", [cls("Root", attributes=[attr("id", required=True), attr("note")]), cls("Twin")], "a.core"),
    PackageSource("Wires", "https://x/wires/", [cls("Line", "a \"line\"", [cref("Core", "Root")], [attr("id", "xsd:integer"), attr("$bad$"), attr("---")], [assoc("ends", "Core", "Twin", "1..*"), assoc("Twin", "Core", "Twin", "0..1")], "St"), cls("Twin", attributes=[attr("x")])], "a.wires", enumerations={"State": ["on", "off"]}),
    PackageSource("Wire", "https://x/wire", [cls("Extra"), cls("Line")], None),
]


@pytest.fixture(scope="module")
def m(spark):
    return from_code(spark, CODE)


def test_model_lookups(m):
    assert tuple(m.stats().first()) == (0, 3, 6, 6, 2)
    assert m.get_class("Twin").first().pkg_ord == 0 and m.get_package("Wires").first().package_id == "a.wires" and m.get_class("No").count() == 0


def test_resolution(m):
    best = {r.name: (r.pkg_ord, r.copies) for r in resolve.richest(m).collect()}
    assert best["Twin"] == (1, 2) and best["Line"] == (1, 2)
    assert {tuple(r)[1:] for r in resolve.cross_package_refs(m).collect()} == {("Wires", "Core", "Root", "parent:Line")}
    assert [(r.a, r.b, r.distance) for r in resolve.fuzzy_pairs(m).collect()] == []  # four letters are too few
    assert resolve.dangling_refs(m).count() == 0


def test_merged_packages(spark):
    names = ["Measurement", "Measuremnt", "Core", "Core", "Protection", "Production"]
    x = from_code(spark, [PackageSource(n, f"#{k}", [cls("A", attributes=[attr("x")]), cls(f"B{k}")]) for k, n in enumerate(names)])
    got = resolve.merged_packages(x)
    assert {(r.pkg_ord, r.name, r.iri) for r in got.package.collect()} == {(0, "Measurement", "#0"), (2, "Core", "#2"), (4, "Protection", "#4"), (5, "Production", "#5")}
    assert {(r.package, r.name, r.cls_ord) for r in got.named().collect() if r.package == "Core"} == {("Core", "A", 0), ("Core", "B2", 1), ("Core", "B3", 2)}
    assert got.attribute.count() == 4


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab", min_size=1, max_size=7), max_size=8), st.lists(st.text("ab", min_size=1, max_size=7), max_size=8), st.integers(1, 3))
def test_similar_finds_all(spark, left, right, most):
    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _next(row, i, x, b)
        return row[-1]

    def _next(row, i, x, b):
        out = [i]
        for j, y in enumerate(b, 1):
            out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
        return out

    df = lambda v, c: spark.createDataFrame([(x,) for x in v], f"{c} string")
    got = {tuple(r) for r in resolve.similar(df(left, "a"), df(right, "b"), most).collect()}
    assert got == {(a, b, lev(a, b)) for a in left for b in right if lev(a, b) <= most}


def test_targets_and_prefixes(spark):
    x = from_code(spark, [PackageSource("P", "#", [cls("DispatchTicket"), cls("OtherBay"), cls("MainBay"), cls("H", associations=[assoc(n, "P", t) for n, t in [("a", "ispatchTicket"), ("b", "Bay"), ("c", "MainBay"), ("d", "中文"), ("e", "Nowhere"), ("f", "0..1")]])])])
    assert {r.name: (r.outcome, r.class_name) for r in resolve.resolved_targets(x).collect()} == {"a": ("fuzzy_resolved", "DispatchTicket"), "b": ("ambiguous_kept", "Bay"), "c": ("kept_exact", "MainBay"), "d": ("noise_dropped", None), "e": ("unresolved_kept", "Nowhere"), "f": ("noise_dropped", None)}
    p = spark.createDataFrame([("cimm",), ("rdf",), ("ow",), ("zzzzz",), (None,)], "prefix string")
    assert {tuple(r) for r in resolve.nearest_prefix(p).collect()} == {("cimm", "cim"), ("ow", "owl")}
    n = spark.createDataFrame([("Meastrement",), ("Asse",), ("Asset",), ("Qqqqqqq",)], "name string")
    known = spark.createDataFrame([("Asset",), ("Asser",)], "name string")
    assert {r.name: (r.value, r.uncertainty_reason, r.suggestions) for r in resolve.clean_class_names(n, known).collect()} == {"Meastrement": ("Measurement", None, []), "Asse": ("Asse", "possible_typo", ["Asser", "Asset"]), "Asset": ("Asset", None, []), "Qqqqqqq": ("Qqqqqqq", "class_unknown", [])}


def test_triples(m):
    t = triples.owl(m)
    assert t.count() == t.dropDuplicates().count()
    line = triples.match(t, s=triples.NS + "Line", p=triples.RDFS + "subClassOf").collect()
    assert [r.o for r in line] == [triples.NS + "Root"]
    assert t.where(F.col("s").contains("bad")).count() == 0
    back = triples.parsed(triples.lines(t))
    assert back.exceptAll(t.select(*back.columns)).count() == 0 and back.count() == t.count()
    s = triples.shacl(m)
    shape = {(r.p.split("#")[1], r.o) for r in s.where(F.col("s").endswith("shape_Line_ends")).collect()}
    assert shape == {("path", triples.NS + "Line.ends"), ("class", triples.NS + "Twin"), ("minCount", "1")}


def test_emitted(m, tmp_path, monkeypatch):
    files = {(r.form, r.path): r.content for r in emit.emitted(m).collect()}
    assert emit.verified(emit.emitted(m)).count() == 0
    ctx = json.loads(files["jsonld-context", "Wires_context.jsonld"])["@context"]
    assert ctx["Twin"] == {"@id": "cim:Twin", "@type": "@id"}  # the class above the association of its name
    assert ctx["id"] == {"@id": "cim:Line.id", "@type": "xsd:integer"}
    schema = json.loads(files["json-schema", "Wires_schema.json"])["properties"]
    assert schema["Line"]["properties"]["ends"] == {"$ref": "#/properties/Twin"} and "---" not in schema["Line"]["properties"]
    assert json.loads(files["json-schema", "Core_schema.json"])["properties"]["Root"]["required"] == ["id"]
    code = files["python-types", "Wires_types.py"]
    assert "from Core_types import Root" in code and "class Line:" in code and "    id: Optional[int] = None" in code
    for name in ("Core", "Wires"):
        (tmp_path / f"{name}_types.py").write_text(files["python-types", f"{name}_types.py"])
    monkeypatch.syspath_prepend(str(tmp_path))
    assert importlib.import_module("Wires_types").Line().id is None
    assert ("owl", "cim17_full.nt") in files and ("owl", "cim17_Wires.nt") in files and ("shacl", "cim17_shapes.nt") in files
    ranks = {r.id: r["rank"] for r in emit.module_order(m).collect()}
    assert ranks["Core"] < ranks["Wires"]
    with pytest.raises(ValueError, match="unknown form"):
        emit.get_adapter("x")


def test_bad_package_name_is_refused(spark):
    x = from_code(spark, [PackageSource("no name", "#", [cls("A")])])
    with pytest.raises(Exception, match="no package name"):
        emit.python_types(x).collect()


def test_packages(spark, m, tmp_path):
    p = Packages(m)
    files = {r.path: r.content for r in p.files().collect()}
    assert len([f for f in files if f.startswith("a-wires-0.1.0/")]) == 14 and len([f for f in files if f.startswith("a-core-0.1.0/")]) == 13
    assert {r.package_id: r.dependencies for r in p.dependencies().collect()} == {"a.core": [], "a.wires": ["a.core"]}
    schema = json.loads(files["a-core-0.1.0/jsonschema/a-core.schema.json"])
    assert schema["$defs"]["Root"]["required"] == ["@type", "id", "id"] or schema["$defs"]["Root"]["required"] == ["@type", "id"]
    assert json.loads(files["a-wires-0.1.0/examples/a-wires-instance.jsonld"])["@graph"][0]["@type"] == "Line"
    sh = p.shacl()
    assert sh.where(F.col("p") == triples.SH + "class").count() == 2 and p.shacl(legacy=True).where(F.col("p") == triples.SH + "class").count() == 0
    bad = from_code(spark, [PackageSource("A", "#", [cls("X", parents=[cref("A", "No")])], "a")])
    with pytest.raises(ValueError, match="unresolved"):
        Packages(bad)
    n = sinks.write_files(p.files(), str(tmp_path)).collect()
    assert len(n) == 27 and (tmp_path / "a-core-0.1.0" / "manifest.yaml").exists()
    out = spark.createDataFrame([(0, "../x", "y")], "doc_id bigint, path string, content string")
    with pytest.raises(Exception, match="leads out"):
        sinks.write_files(out, str(tmp_path)).collect()


def test_sources(spark, tmp_path):
    with pytest.raises(ValueError, match="multiplicity"):
        multiplicity("1")
    (tmp_path / "k.txt").write_text("# list\nA\n\n B \nA\n")
    k = known_classes(spark, str(tmp_path / "k.txt"))
    assert [r.name for r in k.collect()] == ["A", "B"]
    assert [r.name for r in union_of_known(k, spark.createDataFrame([("C",)], "name string")).collect()] == ["A", "B", "C"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        known_classes(spark, str(tmp_path / "none.txt"))
    (tmp_path / "ir.json").write_text(json.dumps({"packages": [{"name": "P", "classes": [{"name": "C", "attributes": [{"name": "a"}]}]}]}, indent=1))
    assert ir_documents(spark, str(tmp_path / "ir.json")).attribute.count() == 1
    assert env_settings("A=1\n# B=2\nexport C='x y'\nbad") == {"A": "1", "C": "x y"}
    assert [provider_name(e) for e in ({"CI": "true", "DEEPSEEK_API_KEY": "k"}, {"DEEPSEEK_API_KEY": "k"}, {"ANTHROPIC_API_KEY": "k"}, {"USE_OLLAMA": "1"}, {})] == ["mock", "deepseek", "claude", "ollama", "mock"]


def test_sample_model(spark):
    x = reference_model(spark)
    assert x.package.count() == 3 and x.classes.count() == 16 and resolve.dangling_refs(x).count() == 0
    edges = x.parent.join(x.classes, ["doc_id", "pkg_ord", "cls_ord"]).select(F.col("name").alias("a"), F.col("class_name").alias("b"))
    assert ("PowerTransformer", "Equipment") in {tuple(r) for r in transitive_closure(edges).collect()}
    assert {r.package_id: r.dependencies for r in Packages(x).dependencies().collect()}["power.equipment.transformer"] == ["power.equipment", "power.grid.core"]
    table = concept_map()
    map_concept(table, "X::Y", "Rule")
    assert table["GridCore::Asset"] == "Entity" and table["X::Y"] == "Rule"


def test_review(spark, tmp_path):
    e = spark.createDataFrame([("c1", "P", "Rep0rt", "typo", "ctx"), ("c2", "P", "Foo", "x", None), ("c3", None, "Bar", None, "y" * 300)], "case_id string, package string, raw_text string, uncertainty_reason string, context_snippet string")
    cache = spark.createDataFrame([("c1", "old", datetime(2024, 1, 1)), ("c1", "new", datetime(2024, 1, 2))], "case_id string, response string, created_at timestamp")
    hit, miss = review.split_by_cache(e, cache)
    assert [r.response for r in hit.collect()] == ["new"] and miss.count() == 2
    b = review.batch_prompts(review.batches(e.fillna("P", ["package"]), 2, ["package"]), ["package", "batch"]).orderBy("batch").collect()
    assert [r.batch_key for r in b] == ["c1|c2", "c3"] and "y" * 200 in b[1].prompt and "y" * 201 not in b[1].prompt
    fixtures = spark.createDataFrame([("semantic_Foo", '{"corrected": {"class_name": "Foot"}, "confidence": 1}'), ("Rep", "[]"), ("default", '{"corrected": {"class_name": "Nope"}}')], "stem string, body string")
    said = review.fixture_responses(e, fixtures)
    d = review.decided(said.join(e, "case_id"), spark.createDataFrame([("Foot",)], "name string"))
    assert {r.case_id: (r.outcome, r.corrected) for r in d.collect()} == {"c1": ("json_invalid", None), "c2": ("corrected", "Foot"), "c3": ("business_invalid", None)}
    c = spark.createDataFrame([(0, 0, 0, "Foo"), (0, 0, 1, "Foo"), (0, 0, 2, "Bar")], "doc_id bigint, pkg_ord int, cls_ord int, name string")
    assert [r.name for r in review.corrected_classes(c, d.withColumn("doc_id", F.lit(0).cast("bigint"))).orderBy("cls_ord").collect()] == ["Foo", "Foot", "Bar"]
    calls = []

    def failing(prompt):
        calls.append(prompt)
        raise OSError

    waits = []
    with pytest.raises(OSError):
        review.retried(failing, pause=waits.append)("x")
    assert len(calls) == 3 and waits == [1.0, 2.0]
    got = review.ask(e.select("case_id", F.col("raw_text").alias("prompt")), lambda p: p.upper() if p != "Bar" else 1 / 0).collect()
    assert {(r.case_id, r.response, r.failure) for r in got} == {("c1", "REP0RT", None), ("c2", "FOO", None), ("c3", None, "ZeroDivisionError")}
    path = str(tmp_path / "cache")
    sinks.append_cache(said, path)
    sinks.append_cache(said.limit(1), path)
    sinks.compact_cache(spark.createDataFrame(spark.read.parquet(path).collect(), "case_id string, response string, created_at timestamp"), path)
    assert spark.read.parquet(path).count() == 3
    sinks.append_audit(d.withColumn("response", F.repeat(F.lit("x"), 900)), str(tmp_path / "audit"))
    assert max(len(json.loads(r.value)["response"]) for r in spark.read.text(str(tmp_path / "audit")).collect()) == 500


def test_review_flows(spark):
    e = spark.createDataFrame([(f"c{k}", "P", t, "x", "") for k, t in enumerate(["Foo", "Bar", "Baz", "Qux"])], "case_id string, package string, raw_text string, uncertainty_reason string, context_snippet string")
    cache = spark.createDataFrame([("c3", '{"corrected": {"class_name": "Known"}}', datetime(2024, 1, 1))], "case_id string, response string, created_at timestamp")
    known = spark.createDataFrame([("Known",)], "name string")

    def one(prompt):
        if "Bar" in prompt:
            raise OSError
        return '{"corrected": {"class_name": "Known"}}' if "Foo" in prompt else "no json"

    d, new = review.reviewed(e, cache, one, known)
    assert {r.case_id: r.outcome for r in d.collect()} == {"c0": "corrected", "c1": "provider_exception", "c2": "json_invalid", "c3": "corrected"} and new.count() == 2
    left = review.still_uncertain(d, spark.createDataFrame([("Foo",)], "name string"))
    assert {r.case_id for r in left.collect()} == {"c1", "c2", "c3"}

    def many(prompt):
        if "c2" in prompt:
            return "[]"
        return json.dumps([{"case_id": "c0", "corrected": {}}, {"case_id": "c1", "corrected": {"class_name": "No"}}, {"case_id": "c0", "corrected": {"class_name": "Known"}}])

    d, new = review.reviewed_in_batches(e, cache, many, known, size=2)
    assert {r.case_id: r.outcome for r in d.collect()} == {"c0": "corrected", "c1": "business_invalid", "c2": "missing_entry", "c3": "corrected"} and new.count() == 2
    for said, want in (("x", "json_invalid"), ("{}", "json_invalid")):
        d, _ = review.reviewed_in_batches(e, cache, Fixed(said), known)
        assert {r.outcome for r in d.collect()} == {want, "corrected"}
    seen = {}
    send = lambda url, body, headers: seen.update(body) or {"choices": [{"message": {"content": "a"}}], "content": [{"text": "b"}], "response": "c"}
    assert [Chat("u", "m", "k", send=send)("p"), Messages("u", "m", "k", "v", send=send)("p"), Local("u", "m", send=send)("p")] == ["a", "b", "c"] and seen["model"] == "m"


def test_members_of_forms(spark, m):
    owl = {tuple(r)[1:4] for r in consistency.triples_members(triples.owl(m), triples.NS).collect()}
    assert ("Line", "attribute", "id") in owl and ("Line", "association", "ends") in owl
    sh = {(r.class_name, r.name): (r.value, r.multiplicity) for r in consistency.shape_members(triples.shacl(m)).collect()}
    assert sh["Line", "ends"] == ("Twin", "1..*") and sh["Root", "id"] == ("string", "1") and sh["Line", "id"] == ("integer", "0..1")
    files = emit.emitted(m, ["json-schema", "python-types"])
    js = {(r.class_name, r.name): (r.kind, r.value) for r in consistency.schema_members(files.where("form = 'json-schema'")).collect()}
    assert js["Line", "ends"] == ("association", "Twin") and js["Line", "id"] == ("attribute", "integer")
    py = {(r.class_name, r.name): (r.kind, r.value) for r in consistency.source_members(files.where("form = 'python-types'")).collect()}
    assert py["Line", "Twin"] == ("association", "Twin") and py["Root", "id"] == ("attribute", "str")
    x = consistency.differing_members(consistency.schema_members(files.where("form = 'json-schema'")), consistency.source_members(files.where("form = 'python-types'")))
    assert {(r.name, r.side) for r in x.collect()} == {("_bad_", "model")}
    p = consistency.probed(m.named().select("doc_id", "package", F.col("name").alias("class_name")), consistency.triples_classes(triples.owl(m), "owl"), ["owl", "shacl"])
    text = consistency.report(consistency.matrix(p, ["owl", "shacl"]), p, ["owl", "shacl"])
    assert "| Core | 2 | 0 | 2 | 0 |" in text and "Core::Root: shacl" in text


def test_metrics(spark):
    ev = [("counter", "n", {"a": "1", "b": "2"}, 2.0, 1), ("counter", "n", {"b": "2", "a": "1"}, 3.0, 2), ("histogram", "h", {}, 4.0, 3), ("histogram", "h", {}, 8.0, 4), ("gauge", "g", None, 1.0, 6), ("gauge", "g", None, 9.0, 5), ("gauge", None, None, 9.0, 5)]
    schema = "kind string, name string, labels map<string,string>, value double, ord int"
    got = {r.name: r for r in metrics.snapshot(spark.createDataFrame(ev, schema)).collect()}
    assert got["n"].sum == 5 and got["n"].labels == "a=1,b=2" and got["n"]["count"] is None
    assert (got["h"]["count"], got["h"].min, got["h"].max, got["h"].mean) == (2, 4, 8, 6) and got["g"].last == 1
    with pytest.raises(Exception, match="positive"):
        metrics.snapshot(spark.createDataFrame([("counter", "n", {}, 0.0, 1)], schema)).collect()


def test_validation(spark):
    n, v = spark.createDataFrame([(1,), (2,), (3,), (None,), (1,)], "id int"), spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    assert {tuple(r) for r in validate.count_violations(n, v, "id", 1, 1).collect()} == {(1, 2, "maxCount"), (3, 0, "minCount")}
    t = lambda x, kind: each(spark, [x], validate.conforms(F.col("v"), kind))[0][0]
    assert [t(x, "xsd:integer") for x in ("1", "-3", "three", "1.5", None)] == [True, True, False, False, True]
    assert not t("yes", "xsd:boolean") and t("2024-02-29", "xsd:date") and not t("2024-02-30", "xsd:date") and t("any", "Status")
    d = spark.createDataFrame([('{"a": 1}',), ('{"a": "x", "z": 1}',), ("[]",), ("{",), (None,), ('{"b": true}',)], "j string")
    assert {(r.j, r.violation) for r in validate.document_violations(d, "j", ["a"], {"a": "integer", "b": "boolean"}).collect()} == {('{"a": "x", "z": 1}', "unknown z"), ('{"a": "x", "z": 1}', "type a"), ("[]", "not an object"), ("{", "not an object"), ('{"b": true}', "required a")}


def test_consistency(spark):
    rows = spark.createDataFrame([(p, f"N{k}") for p in "ab" for k in range(200)] + [("a", " "), ("a", None)], "p string, n string")
    s = consistency.stratified_sample(rows, "p", "n", 10)
    assert s.groupBy("p").count().where("count <> 10").count() == 0 and sorted(s.collect()) == sorted(consistency.stratified_sample(rows.repartition(7), "p", "n", 10).collect())
    x = spark.createDataFrame([(0, "a", "X"), (0, "a", "Y")], "doc_id bigint, package string, class_name string")
    present = spark.createDataFrame([(0, "owl", "X"), (0, "shacl", "X"), (0, "owl", "Y")], "doc_id bigint, form string, class_name string")
    p = consistency.probed(x, present, ["owl", "shacl"])
    assert tuple(consistency.matrix(p, ["owl", "shacl"]).first()) == ("a", 2, 1, 2, 1, 0.5)
    assert [r.class_name for r in consistency.passed_names(p).collect()] == ["X"]
    f = spark.createDataFrame([(0, '{"properties": {"X": {}}}')], "doc_id bigint, content string")
    assert consistency.text_classes(f, "json-schema").count() == 1 and consistency.text_classes(f, "json-schema", strict=True).count() == 0
    ok = '{"missing_attrs": {"owl": ["a", "b"]}, "missing_assocs": {}, "confidence": 0.9, "class_iri": "x#u", "notes": "n"}'
    said = [("u", ok), ("v", "x"), ("w", "{}"), ("y", '{"missing_attrs": {}, "missing_assocs": {}, "confidence": 0.1}'), ("z", '{"class_iri": "z", "consistent": true, "confidence": 0.9}'), ("q", None), ("s", '{"missing_attrs": {}, "missing_assocs": {}, "confidence": 0.5}')]
    found = consistency.semantic_findings(spark.createDataFrame(said, "class_iri string, response string"))
    assert {r.class_iri: r.outcome for r in found.collect()} == {"x#u": "ok", "v": "json_invalid", "w": "invalid_format", "y": "low_confidence", "z": "invalid_format", "q": "json_invalid", "s": "ok"}
    first = found.where("class_iri = 'x#u'").first()
    assert first.missing_attrs == {"owl": ["a", "b"]} and first.missing_assocs == {} and first.notes == "n"
    text = consistency.semantic_section(found)
    assert "1 of 2 reviewed" in text and "- u lacks b in owl: n" in text


def test_semantic_review(spark):
    s = spark.createDataFrame([(0, "X", "n#X"), (0, "Y", "n#Y"), (0, "Z", "n#Z")], "doc_id bigint, class_name string, class_iri string")
    m = spark.createDataFrame([(0, "X", "attribute", "a"), (0, "X", "attribute", "b"), (0, "X", "association", "to")], "doc_id bigint, class_name string, kind string, name string")
    f = spark.createDataFrame([(0, "owl", "X", "attribute", "a", "string"), (0, "owl", "X", "association", "to", "Y"), (0, "shacl", "X", "attribute", "b", None)], "doc_id bigint, form string, class_name string, kind string, name string, value string")
    p = consistency.semantic_prompts(s, m, f, ["owl", "shacl", "python-types"])
    x = {r.class_name: r.prompt for r in p.collect()}
    assert "Model: attributes a, b; associations to\nowl: attributes a; associations to->Y\nshacl: attributes b; associations none\npython-types: nothing" in x["X"] and "Model: attributes none" in x["Y"]

    def answer(prompt):
        if "Class: Y" in prompt:
            raise OSError
        return json.dumps({"missing_attrs": {"owl": ["b"]}, "missing_assocs": {}, "confidence": 1.0})

    none = spark.createDataFrame([("semantic:n#Z", "no json", None)], "case_id string, response string, created_at timestamp")
    found, new, counts = consistency.semantic_review(p, none, answer)
    assert {r.class_iri: r.outcome for r in found.collect()} == {"n#X": "ok", "n#Z": "json_invalid"}
    assert [r.case_id for r in new.collect()] == ["semantic:n#X"] and {r.outcome: r.n for r in counts.collect()} == {"ok": 1, "json_invalid": 1, "provider_exception": 1}


def test_stream_of_changes(spark, tmp_path):
    at = datetime(2024, 1, 1)
    r = spark.createDataFrame([("t", k, "P", f"N{k}", at) for k in range(4)], "source_table string, ref_id bigint, package string, name string, ref_at timestamp")
    p = spark.createDataFrame([("P", "N1", at, None)], "package string, name string, created_at timestamp, deleted_at timestamp")
    c = as_changes(r, p)
    c.where("kind = 'reference'").coalesce(1).write.parquet(str(tmp_path / "in"))
    c.where("kind = 'parent'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    seen = []
    state, q = follow(spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "cp"), None, lambda s, n: seen.append(s.agg(F.sum("orphans")).first()[0]))
    q.awaitTermination(60)
    assert {x.ref_id for x in state.orphans().collect()} == {0, 2, 3} and len(seen) == 2
    c.where("kind = 'parent'").withColumn("name", F.lit("N2")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    again, q = follow(spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "cp"), None, lambda s, n: seen.append(s.agg(F.sum("orphans")).first()[0]))
    q.awaitTermination(60)
    assert {x.ref_id for x in again.orphans().collect()} == {0, 3} and seen[-1] == 2  # taken up after a restart
    again.advance(r, p, number=1)
    assert {x.ref_id for x in again.orphans().collect()} == {0, 3} and len(again.steps) == 3  # a step that is done changes nothing


def test_reviewers_of_settings_and_prompts(spark):
    seen = []

    def send(url, body, headers):
        seen.append((url, body, headers))
        return {"choices": [{"message": {"content": "a"}}], "content": [{"text": "b"}], "response": "c"}

    assert providers.from_settings({}) is None and providers.from_settings({"CI": "true", "ANTHROPIC_API_KEY": "k"}) is None
    asked = review.Prompt("question", "as whom")
    for env, said in (({"DEEPSEEK_API_KEY": "k"}, "a"), ({"ANTHROPIC_API_KEY": "k", "REVIEW_MODEL": "m"}, "b"), ({"USE_OLLAMA": "1", "REVIEW_URL": "http://x"}, "c")):
        assert providers.from_settings(env, send)(asked) == said
    assert seen[0][1]["messages"][0] == {"role": "system", "content": "as whom"} and seen[0][1]["messages"][1]["content"] == "question"
    assert seen[1][1]["system"] == "as whom" and seen[1][1]["model"] == "m" and seen[1][2]["anthropic-version"] and seen[2][0] == "http://x" and seen[2][1]["system"] == "as whom"
    e = spark.createDataFrame([("c1", "P", 3, "Beto", {"a": "1"}, "why", "y" * 300)], "case_id string, package string, source_table int, raw_text string, rule_attempt map<string,string>, uncertainty_reason string, context_snippet string")
    text = review.prompts(e, review.known_lists(["B", "A"], ["cim"])).first().prompt
    assert "Known classes: A, B" in text and "Known namespaces: cim" in text and "Table: 3" in text and "First attempt: a=1" in text and text.count("y" * 200) == 1 and "y" * 201 not in text and text.endswith(review.ONE)
    b = review.batch_prompts(e.selectExpr("*", "0 as batch"), ["batch"]).first()
    assert b.batch_key == "c1" and b.prompt.startswith("case_id: c1\n") and '[{"case_id": "...", "corrected"' in b.prompt
    fails = []

    def flaky(prompt):
        fails.append(prompt.system)
        if len(fails) < 3:
            raise OSError
        return "yes"

    assert review.retried(flaky, 3, lambda s: None)(review.Prompt("x")) == "yes" and fails == [review.SYSTEM] * 3


def test_build_with_review(tmp_path, spark):
    def answer(prompt):
        return json.dumps({"corrected": {"class_name": "Beta" if "Beto" in prompt else "Nope"}})

    (tmp_path / "d.md").write_text("## A.1（Alpha）\n\n| 属性 | 类型 |\n|---|---|\n| a | int |\n\n## A.2（Beto）\n", encoding="utf-8")
    known = spark.createDataFrame([("Beta",)], "name string")
    b = build(spark, str(tmp_path / "d.md"), str(tmp_path / "out"), ["json-schema", "shacl"], answer, known)
    assert {r.name for r in b.model.classes.collect()} == {"Alpha", "Beta"} and {r.raw_text for r in b.uncertain.collect()} == {"Alpha"}
    assert b.stats == {"json-schema": 1, "shacl": 1} and b.issues.count() == 0 and b.manifest.count() == 2
    assert set(json.loads((tmp_path / "out" / "Core_schema.json").read_text())["properties"]) == {"Alpha", "Beta"}
    info = markdown.source_info(markdown.documents(spark, str(tmp_path / "d.md"))).first()
    assert info.document_path.endswith("d.md") and len(info.document_sha256) == 64
    log = str(tmp_path / "log")
    asked = []
    for _ in range(2):
        b = build(spark, str(tmp_path / "d.md"), str(tmp_path / "again"), ["shacl"], answer, known, log)
        asked.append(spark.read.parquet(log).count())
    assert asked == [2, 2] and {r.name for r in b.model.classes.collect()} == {"Alpha", "Beta"}  # the second run asks nothing
    assert "hint: h" in str(PipelineError(Severity.WARN, "s", "m", suggestion="h"))
    configure_logging("WARNING")


def test_command_line(tmp_path, spark):
    (tmp_path / "d.md").write_text("## 1 Class: Alpha\n\n| 属性 | 类型 | 基数 |\n|---|---|---|\n| a | int | 1..1 |\n", encoding="utf-8")
    assert cli(["build", "-i", str(tmp_path / "d.md"), "-o", str(tmp_path / "out"), "-f", "json-schema"]) == 0
    assert json.loads((tmp_path / "out" / "Core_schema.json").read_text())["properties"]["Alpha"]["required"] == ["a"]
    assert cli(["verify", "-i", str(tmp_path / "d.md")]) == 0


def test_schema_violations(spark):
    schema = {
        "type": "object", "required": ["a"], "additionalProperties": False,
        "properties": {"a": {"type": ["string", "null"]}, "b": {"const": {"x": 1}}, "c": {"type": "array", "items": {"anyOf": [{"type": "integer"}, {"$ref": "#/$defs/d"}]}}, "e": {"enum": ["u", 2]}, "f": {"type": "array", "items": {"type": "object", "required": ["g"]}}},
        "$defs": {"d": {"type": "object", "required": ["k"], "properties": {"k": {"type": "boolean"}}}},
    }
    texts = {
        1: '{"a": "s", "b": {"x": 1}, "c": [1, {"k": true}], "e": "u", "f": [{"g": null}]}', 2: "{}", 3: '{"a": 1, "z": 0}', 4: '{"a": null, "b": {"x": 2}}', 5: '{"a": "", "c": [1, "x", {"k": 1}, {}]}', 6: '{"a": "", "e": 2}', 7: '{"a": "", "e": "2"}',
        8: "[1]", 9: "no json", 10: None, 11: '{"a": "", "c": 5}', 12: '{"a": "", "f": [{}, {"g": 1}, 3]}', 13: "null", 14: "",
    }
    got = {}
    for r in validate.schema_violations(spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "id int, t string, violation string").drop("violation"), "t", schema).collect():
        got.setdefault(r.id, []).append(r.violation)
    assert {k: sorted(v) for k, v in got.items()} == {
        2: ["required $.a"], 3: ["additionalProperties $.z", "type $.a"], 4: ["const $.b"], 5: ["anyOf $.c[]"] * 3, 7: ["enum $.e"], 8: ["type $"], 9: ["json $"], 11: ["type $.c"], 12: ["required $.f[].g", "type $.f[]"], 13: ["type $"], 14: ["json $"],
    }
    with pytest.raises(ValueError, match="itself"):
        validate.schema_violations(spark.createDataFrame([("x",)], "t string"), "t", {"$ref": "#/$defs/l", "$defs": {"l": {"items": {"$ref": "#/$defs/l"}}}})


def test_namespaces_registry_and_resets(spark):
    x = spark.createDataFrame([("cim:",), ("cin",), ("zz",), (None,)], "p string")
    assert [r.i for r in x.select(resolve.namespace_iri(F.col("p"), {"cin": "cim"}, strict=False).alias("i")).collect()] == [resolve.NAMESPACES["cim"]] * 2 + [None, None]
    with pytest.raises(Exception, match="unknown namespace: zz"):
        x.select(resolve.namespace_iri(F.col("p"))).collect()
    with pytest.raises(ValueError, match="canonical"):
        resolve.namespace_iri(F.col("p"), {"a": "b"})
    r = spark.createDataFrame([("B", "P", 1), ("A", "P", 2), ("B", "Q", 3), (None, "P", 0), ("C", None, 4)], "name string, package string, at int")
    assert [tuple(v) for v in resolve.class_registry(r, "at").orderBy("place").collect()] == [("B", "Q", 0), ("A", "P", 1), ("C", None, 2)]
    e = spark.createDataFrame([("counter", "n", {"a": "b"}, 1.0, 1), ("counter", "n", {"a": "b"}, 2.0, 2)], "kind string, name string, labels map<string,string>, value double, ord int")
    assert [metrics.snapshot(e, s).first()["sum"] for s in (None, F.lit(1))] == [3.0, 2.0] and metrics.snapshot(e, F.lit(2)).count() == 0


def test_model_to_json_and_back(spark, tmp_path):
    m = reference_model(spark)
    text = ir_json(m).first().content
    (tmp_path / "ir.json").write_text(text)
    back = ir_documents(spark, str(tmp_path / "ir.json"))
    for name in ("package", "classes", "parent", "attribute", "association", "enumeration"):
        a, b = (getattr(x, name).drop("doc_id") for x in (m, back))
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect())), name
    assert m.classes.where("name = 'Asset' and description <> ''").count() == 1
    (tmp_path / "bad.json").write_text('{"packages": 5')
    assert [r.path.rsplit("/", 1)[1] for r in unread_documents(spark, str(tmp_path / "*.json")).collect()] == ["bad.json"]
    assert ir_documents(spark, str(tmp_path / "*.json"), strict=False).package.count() == 3


def test_corpus_of_hashed_ids(spark):
    d = {"packages": [PackageSource("P", "#", [cls("A")]).row(), PackageSource("Q", "#", [cls("B")]).row()]}
    from loomset.plans.model import nested
    from loomset.sources.models import PACKAGES

    m = nested(spark.createDataFrame([{"ir_id": i, **d} for i in (2**60, -(2**62), 5)], f"ir_id BIGINT, packages {PACKAGES}")).corpus()
    assert [(r.pkg_ord >> 20, r.pkg_ord & 1) for r in m.package.orderBy("pkg_ord").collect()] == [(k, p) for k in range(3) for p in range(2)]
    assert m.named().count() == 6


def test_many_short_names_meet_few(spark):
    """Pieces grow with the edits that lengths allow: of random names only a small part of all pairs is compared."""
    import random

    r = random.Random(4)
    names = {"".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(9, 24))) for _ in range(400)}
    names |= {n[:4] + n[5:] for n in list(names)[:40]} | {n + "xy" for n in list(names)[:40]}
    df = spark.createDataFrame([(0, n) for n in names], "doc_id bigint, name string")
    got = {(x.a, x.b) for x in resolve.fuzzy_pairs(Model(*[df.withColumn("pkg_ord", F.lit(0))] * 6)).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    want = {(a, b) for a in names for b in names if a < b and 1 <= abs(len(a) - len(b)) <= 3 and distance(a, b) <= min(6, max(2, max(len(a), len(b)) // 3))}
    assert got == want and len(want) >= 80


def test_turtle(spark):
    rows = [(0, "g", triples.NS + "A.b", triples.RDF + "type", triples.OWL + "Class", "iri", None, None), (0, "g", triples.NS + "A.", "http://x/p", "http://x/ü", "iri", None, None), (0, "g", triples.NS + "1", triples.RDFS + "label", 'q " \\ \n\t\r . é', "literal", "en", None), (0, "g", "urn:x", triples.SH + "minCount", "1", "literal", None, triples.XSD + "integer"), (0, "g", "urn:x", triples.SH + "name", "", "literal", None, None)]
    t = spark.createDataFrame(rows, "doc_id bigint, graph string, s string, p string, o string, o_kind string, o_lang string, o_datatype string")
    text = triples.turtle_lines(t)
    lines = {r.line for r in text.collect()}
    assert "cim:A.b rdf:type owl:Class ." in lines and f"<{triples.NS}A.> <http://x/p> <http://x/ü> ." in lines and 'urn:x> sh:minCount "1"^^xsd:integer .' in "".join(lines)
    heads = spark.createDataFrame([(0, "g", x) for x in triples.PREFIX_LINES.splitlines() + [""]], text.schema)
    assert sorted(map(tuple, triples.turtle_parsed(text.unionAll(heads)).collect()), key=repr) == sorted(rows, key=repr)
    assert triples.turtle_parsed(heads.withColumn("line", F.lit("no triple ."))).where("s is null").count() == 7


def test_large_graphs_are_several_files(spark, monkeypatch):
    m = reference_model(spark)
    one = {r.path: r.content for r in emit.emitted(m, ["owl", "shacl", "turtle"]).collect()}
    assert {"cim17_full.nt", "cim17_GridCore.ttl", "cim17_shapes.nt"} <= set(one)
    assert emit.verified(emit.emitted(m, ["owl", "shacl", "turtle"])).count() == 0
    monkeypatch.setattr(emit, "MOST_LINES", 40)
    many = {r.path: r.content for r in emit.emitted(m, ["owl"]).collect()}
    parts = [v for k, v in many.items() if k.startswith("cim17_full-")]
    assert len(parts) > 3 and sorted(x for p in parts for x in p.split("\n")) == one["cim17_full.nt"].split("\n")
