"""Hierarchies, references and nested records, with nulls, ties, loops and empty tables."""

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loomset.operators.flatten import Flattened
from loomset.operators.graph import connected_components, levels, transitive_closure
from loomset.operators.hierarchy import class_links, cycles, descendants, hierarchy
from loomset.operators.orphans import Orphans, replayed

LINK = "id bigint, parent bigint, path string"


def truth(parent):
    out = {}
    for i in parent:
        seen, x = [], i
        while x is not None and x not in seen:
            seen.append(x)
            x = parent[x]
        out[i] = (seen[-1], len(seen) - 1, "/".join(map(str, seen[::-1]))) if x is None else (0, -1, "cycle" if x == i else "below cycle")
    return out


def solved(spark, rows, **kw):
    df = spark.createDataFrame([(a, b, "clash") for a, b in rows], LINK)
    return {r.id: (r.root, r.depth, r.path) for r in hierarchy(df, **kw).collect()}


@pytest.mark.parametrize("most", [200_000, 2])
def test_hierarchy(spark, most):
    rows = [(1, None), (2, 1), (3, 2), (3, 2), (4, 99), (5, 6), (6, 7), (7, 5), (8, 7), (9, 8), (10, 10), (None, 1), (11, 2)]
    parent = {1: None, 2: 1, 3: 2, 4: None, 5: 6, 6: 7, 7: 5, 8: 7, 9: 8, 10: 10, 11: 2}
    assert solved(spark, rows, max_component=most) == truth(parent)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(1, 12), st.one_of(st.none(), st.integers(1, 12)), max_size=12), st.sampled_from([1, 200_000]))
def test_hierarchy_of_any_links(spark, links, most):
    parent = {k: v if v in links else None for k, v in links.items()}
    assert solved(spark, list(links.items()), max_component=most) == truth(parent)


def test_cycles(spark):
    rows = [(1, None), (5, 6), (6, 7), (7, 5), (8, 7), (9, 8), (10, 10), (None, 1), (5, 6)]
    got = {tuple(r) for r in cycles(spark.createDataFrame([(a, b, "") for a, b in rows], LINK)).collect()}
    assert got == {(5, 5, 6, False), (5, 6, 7, False), (5, 7, 5, True), (10, 10, 10, True)}
    assert cycles(spark.createDataFrame([(1, 2, "")], LINK)).count() == 0 == cycles(spark.createDataFrame([], LINK)).count()


def test_hierarchy_of_nothing_and_a_hub(spark):
    assert solved(spark, []) == {}
    got = solved(spark, [(0, None)] + [(k, 0) for k in range(1, 400)], max_component=50)
    assert len(got) == 400 and got[7] == (0, 1, "0/7")
    rows = [(1, None), (2, 1), (3, 2)]
    d = descendants(hierarchy(spark.createDataFrame([(a, b, "") for a, b in rows], LINK)))
    assert {tuple(r) for r in d.collect()} == {(1, 2, 1), (1, 3, 2), (2, 3, 1)}


def test_links_of_classes(spark):
    ref = "struct<package:string,class_name:string,iri:string,is_external:boolean>"
    c = spark.createDataFrame(
        [(1, "P", "A", None, None), (2, "P", "B", [("P", "A", None, None)], None), (3, "P", "C", [("P", None, None, False), ("P", "A", None, True)], None), (4, "P", "D", [("Q", "A", None, False)], None), (None, "P", "E", None, None)],
        f"class_id bigint, package string, name string, parents array<{ref}>, loaded_at timestamp",
    )
    p = spark.createDataFrame([(1, 3, 0, None), (2, 3, 1, "B"), (3, 4, 0, "A"), (4, None, 0, "A")], "attr_id bigint, class_id bigint, attr_ord int, inherited_from string")
    assert {tuple(r) for r in class_links(c, p).collect()} == {(1, None), (2, 1), (3, 2), (4, None)}


def test_components_levels_and_closure(spark):
    n = spark.createDataFrame([(k,) for k in "abcdefg"], "id string")
    e = spark.createDataFrame([("b", "a"), ("b", "c"), ("d", "e"), ("e", "f"), (None, "a"), ("g", "g")], "a string, b string")
    assert {tuple(r) for r in connected_components(n, e).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d"), ("f", "d"), ("g", "g")}
    assert {tuple(r) for r in levels(n, e).collect()} == {("a", 1), ("b", 0), ("c", 1), ("d", 0), ("e", 1), ("f", 2), ("g", 0)}
    loop = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "a string, b string")
    assert {r.id: r.level for r in levels(n, loop).collect()} == {"a": None, "b": None, "c": None, "d": 0, "e": 0, "f": 0, "g": 0}
    assert {tuple(r) for r in transitive_closure(loop).collect()} == {(x, y) for x in "ab" for y in "abc"}


REF = "source_table string, ref_id bigint, package string, name string, ref_at timestamp, loaded_at timestamp, extra string"
PAR = "package string, name string, created_at timestamp, deleted_at timestamp, loaded_at timestamp, ref_id int"
T = [datetime(2024, m, 1) for m in range(1, 13)]


def frames(spark, refs, parents):
    return spark.createDataFrame(refs, REF), spark.createDataFrame(parents, PAR)


def test_orphans_are_resolved_and_reopened(spark):
    r, p = frames(spark, [("t", 1, "P", "A", T[3], T[3], ""), ("t", 2, "P", "B", T[3], T[3], ""), ("t", 3, "P", "C", T[3], T[3], ""), ("t", 4, "P", None, T[3], T[3], ""), ("t", 5, None, "A", T[3], T[3], "")], [("P", "A", T[0], None, T[0], 0)])
    s = Orphans().advance(r, p)
    assert {(x.ref_id, x.reason) for x in s.orphans().collect()} == {(2, "missing"), (3, "missing"), (5, "missing")}
    none, late = frames(spark, [], [("P", "B", T[5], None, T[5], 0), ("P", "C", T[1], None, T[5], 0)])
    s.advance(none, late)  # B arrived after the reference, C had been there
    assert {(x.ref_id, x.reason) for x in s.orphans().collect()} == {(2, "late"), (5, "missing")}
    none, gone = frames(spark, [], [("P", "C", T[1], T[2], T[6], 0)])
    s.advance(none, gone)
    assert {(x.ref_id, x.reason, x.period) for x in s.orphans().collect()} == {(2, "late", "2024-04"), (3, "deleted", "2024-04"), (5, "missing", "2024-04")}
    assert {tuple(x) for x in s.snapshot().collect()} == {("t", "2024-04", k, 1) for k in ("late", "deleted", "missing")}
    assert s.open_at(T[11]).collect()[0].open_orphans == 2  # C deleted, the one without package


@pytest.mark.parametrize("steps", [1, 4])
def test_steps_do_not_matter(spark, steps):
    refs = [("t", k, "P", f"N{k % 5}", T[k % 12], T[(k * 7) % 12], "") for k in range(60)] * 2
    pars = [("P", f"N{k}", T[2 * k], T[2 * k + 3] if k % 2 else None, T[11 - k], 0) for k in range(4)]
    got = {tuple(x) for x in replayed(*frames(spark, refs, pars), steps=steps).orphans().collect()}
    want = set()
    for _, i, _, n, at, *_ in refs:
        p = [x for x in pars if x[1] == n]
        reason = "missing" if not p else "late" if p[0][2] > at else "deleted" if p[0][3] and p[0][3] <= at else None
        if reason:
            want.add(("t", i, reason, at.strftime("%Y-%m")))
    assert got == want


def test_state_is_compacted(spark):
    s = Orphans(compact=2)
    for k in range(6):
        s.advance(*frames(spark, [("t", k, "P", f"N{k}", T[3], T[3], "")], [("P", f"N{k - 1}", T[0], None, T[0], 0)]))
        assert {x.ref_id for x in s.orphans().collect()} == {k}
    assert len(s.steps) <= 2 and s.refs.count() == 6 and s.index.count() == 6
    assert {x.ref_id for x in Orphans(s.path).advance(*frames(spark, [], [("P", "N1", T[0], T[1], T[0], 0)])).orphans().collect()} == {1, 5}


def test_orphans_of_empty_tables(spark):
    assert replayed(*frames(spark, [], [])).orphans().count() == 0


FEED = [
    (1, {"packages": [None, {"name": "A", "classes": {"name": "C", "attributes": [{"name": "x"}, None, 3]}}]}),
    (2, {"envelope": {"packages": {"name": "B", "classes": [{"name": "D", "associations": {"name": "y", "target": {"package": "P"}}}]}}, "n": 1}),
    (3, "text"),
    (4, []),
    (5, {"packages": None}),
]


def test_flattened_text(spark):
    rows = [(k, json.dumps(v), "clash") for k, v in FEED] + [(6, "{broken", ""), (7, None, ""), (8, json.dumps(json.dumps(FEED[0][1])), ""), (9, "", ""), (10, '{"packages": [' * 3000, "")]
    f = Flattened.text(spark.createDataFrame(rows, "id bigint, payload string, path string"), "id", "payload", "packages")
    at = lambda p: {(r.rec_id, tuple(r.path)) for r in f.nodes[p].collect()}
    assert at("packages") == {(1, (1,)), (2, (0,)), (8, (1,))}
    assert at("packages.classes") == {(1, (1, 0)), (2, (0, 0)), (8, (1, 0))}
    assert at("packages.classes.attributes") == {(1, (1, 0, 0)), (8, (1, 0, 0))}
    t = f.table("packages.classes").orderBy("rec_id").collect()
    assert (t[0].node_key, t[0].parent_key, t[0].name) == ("1/1/0", "1/1", "C")


def test_flattened_columns(spark):
    df = spark.createDataFrame(
        [(1, [("a", [("x", [1, None])]), None, ("b", None)]), (2, None), (None, [("c", [])])],
        "id bigint, l array<struct<name:string, inner:array<struct<rec_id:string, nums:array<int>>>>>",
    )
    f = Flattened.typed(df, "id", "l")
    assert {(r.rec_id, tuple(r.path), r.node.name) for r in f.nodes["l"].collect()} == {(1, (0,), "a"), (1, (2,), "b"), (None, (0,), "c")}
    assert [(r.node_key, r.rec_id_) for r in f.table("l.inner").collect()] == [("1/0/0", "x")]  # a clashing name gets a new one
    assert [(r.node_key, r.value) for r in f.table("l.inner.nums").collect()] == [("1/0/0/0", 1)]


def test_text_without_any_list(spark):
    f = Flattened.text(spark.createDataFrame([], "id bigint, payload string"), "id", "payload", "packages")
    assert f.nodes == {}


def test_written_tables_are_cleared(spark):
    from loomset.frames import clear, shared_dir, written

    clear(spark)
    x = written(spark.range(5).toDF("id"))
    assert x.count() == 5 and x.inputFiles()[0].split("/loomset-")[0].endswith(shared_dir(spark).split("/")[-1])
    assert clear(spark) == 1 and clear(spark) == 0
