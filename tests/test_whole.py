"""Queries on small tables written for the test, with rows that a narrower query would leave out."""

import pytest

import __spark_entry__ as entry
from loomset.operators import resolve

REF = "struct<package:string, class_name:string, iri:string, is_external:boolean>"


@pytest.fixture
def run(spark, tmp_path):
    """Runs a query on tables given as name=(rows, schema)."""

    def of(name, **tables):
        for k, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{k}.parquet")
        return entry.queries()[name](spark, str(tmp_path))

    return of


def test_subclass_closure_crosses_packages(run):
    up = lambda package, name: [(package, name, None, False)]
    rows = [("P", "A", up("Q", "B")), ("Q", "B", up("R", "C")), ("R", "C", None), ("P", "D", up("P", "A")), ("P", "B", up("P", "Z")), ("P.x", "A", up("P", "y")), ("P", "x.A", up("Q", "w"))]
    got = run("subclass_closure", class_def=(rows, f"package string, name string, parents array<{REF}>")).collect()
    pairs = "P.A>Q.B P.A>R.C Q.B>R.C P.D>P.A P.D>Q.B P.D>R.C P.B>P.Z P.x.A>P.y P.x.A>Q.w".split()
    assert sorted((r.sub, r.super) for r in got) == sorted(tuple(p.split(">")) for p in pairs)


def test_md_tables_of_any_script(run):
    texts = ["a|b\n1|2", "señal|tipo\n---|---\nx|é\n\u3000\ny|z", "名字|类型|重数\n:-:|-|-\n\xa0\n\u3000甲|乙|1", "\xa0--|--\n属性", "", None]
    rows = [(k, "d", k, "table", 0, t) for k, t in enumerate(texts)] + [(9, "d", 9, "paragraph", 0, "señal|x")]
    got = run("md_tables", md_token=(rows, "tok_id bigint, std_doc string, tok_ord int, type string, level int, content string")).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 2), (1, 2, 2), (2, 1, 3), (3, 0, 1)]


def test_topo_levels_backwards_and_around_loops(run):
    edges = [("z", "m"), ("m", "a"), ("z", "a"), ("z", "a"), ("c", "b"), ("b", "c"), ("a", "b"), ("c", "d"), ("d", "e"), ("m", "m"), (None, "q"), ("q", None)]
    got = run("topo_levels", cross_package_ref=(edges, "from_package string, to_package string")).collect()
    assert {tuple(r) for r in got} == {("z", 0), ("m", 1), ("a", 2), ("b", None), ("c", None), ("d", None), ("e", None)} and len(got) == 7


def test_local_names_of_any_script(run):
    rows = [(1, "http://x/y#Z", "Last known mark 单线图所示"), (2, "a/b", "Señal  de Übergang!"), (3, "c", None), (4, "d#e/f", "plain A"), (4, "d#e/f", "plain A"), (5, None, "—é—")]
    got = run("local_names", class_def=(rows, "class_id bigint, iri string, description string")).collect()
    want = {(1, "Z", "last-known-mark-单线图所示"), (2, "b", "señal-de-übergang"), (3, "c", None), (4, "f", "plain-a"), (5, None, "é")}
    assert {tuple(r) for r in got} == want and len(got) == 5


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_clean_class_names_of_any_script(run):
    known = ["Line", "Señal", "Breaker", "Größe", "线路端子", "Ｌine"]
    found = ["Line", "Ｌine", "Liñé", "Lіne", "Senal", "señál", "Brеаkеr", "Brеаker", "线路端", "线路", "端子组", "Grosse", "Größen", "é", "", "Ｂreaker", "😀ine", None]
    got = run("clean_class_names", ocr_noise_samples=([(x,) for x in found], "raw_text string"), class_def=([(x,) for x in known + [None]], "name string")).collect()
    assert len(got) == len(found) - 1
    for r in got:
        near = sorted((d, k) for k in known if (d := distance(r.name, k)) <= 2)[:3]
        plain = r.name in known or r.name in resolve.CORRECTIONS
        assert r.value == resolve.CORRECTIONS.get(r.name, r.name) and r.correction_applied == (r.name in resolve.CORRECTIONS)
        assert r.suggestions == ([] if plain else [k for _, k in near]), r.name
        assert r.uncertainty_reason == (None if plain else "possible_typo" if near else "class_unknown"), r.name


def test_shape_datatype_of_every_event(run):
    rows = [(1, "click", '{"k": 5}'), (2, "view", '{"k": "x"}'), (3, "7", '{"k": "y"}'), (4, "signup", None), (5, None, '{"k": "z"}'), (6, "12", "{}")]
    got = run("shape_datatype", events=(rows, "event_id bigint, event_type string, props string")).collect()
    assert sorted((r.event_id, r.event_type) for r in got) == [(1, "click"), (2, "view"), (2, "view"), (3, "7"), (4, "signup"), (5, None)]
