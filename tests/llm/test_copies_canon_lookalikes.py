"""Copies, canonical values and lookalikes against brute force, with nulls, ties, empty tables and long texts."""

import collections
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loomset.llm import canon, lookalikes
from loomset.llm.canon import Trie, assigned, found, mapped, readings, slips
from loomset.llm.copies import Collapsed, canonical_key
from loomset.llm.lookalikes import alike, forms

RECORD = "rec_id bigint, package_name string, class_name string, props string, head string, key string, copies string"


def bare(s):
    return None if s is None else "".join(c for c in s if unicodedata.category(c)[0] in "LNM").lower()


def same(r):
    if r[3] is None:
        return bare(r[1]), bare(r[2]), None
    parts = [re.split("[=:]", e, maxsplit=1) + [""] for e in re.split(r"[;|\r\n]", r[3])]
    return bare(r[1]), bare(r[2]), frozenset((bare(p[0]), bare(p[1])) for p in parts) - {("", "")}


def collapsed(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], RECORD)
    return Collapsed(df, "rec_id", canonical_key(["package_name", "class_name"], ["props"]))


def groups(rows):
    g = collections.defaultdict(list)
    for r in rows:
        g[same(r)].append(r[0])
    return g


ROWS = [
    (5, "A b", "C", "k=v; a:b"), (3, "a-B", " c ", "A = b|K:V;;"), (3, "a-B", " c ", "A = b|K:V;;"), (9, "ab", "c", None), (8, "AB", "C", None), (7, "ab", "c", ""), (6, "ab", "c", ";|\n"), (4, None, "c", ""), (2, "", "c", ""),
    (None, "ab", "c", None), (11, "ab", "c", "k=va=b"), (12, "ab", "c", "kv=;a=b"), (13, "ab", "c", "x" * 50_000), (14, "AB", "c", "X-" * 50_000),
]


def test_collapsed(spark):
    c = collapsed(spark, ROWS)
    want = {(min(x for x in v if x is not None), k) for v in groups(ROWS).values() for k in v if k is not None and k != min(x for x in v if x is not None)}
    assert {tuple(r) for r in c.copies().collect()} == want
    assert sorted(r.copies for r in c.kept().collect()) == sorted(len(v) for v in groups(ROWS).values())


def test_one_hot_record_over_many_partitions(spark):
    rows = [(k, "P", "C" if k % 3 else f"D{k % 50}", "a=1") for k in range(3000)]
    got = {tuple(r) for r in collapsed(spark, rows).kept().collect()}
    assert got == {(min(v), len(v)) for v in groups(rows).values()}
    assert collapsed(spark, rows).copies().count() == 3000 - len(groups(rows))


def test_no_records(spark):
    c = collapsed(spark, [])
    assert c.copies().count() == 0 and c.kept().count() == 0


def distance(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=9), min_size=1, max_size=8), st.text("abcd", max_size=9), st.integers(0, 3))
def test_automaton_finds_all_entries(words, value, most):
    t = Trie(list(enumerate(words)))
    allowed = lambda w: min(most, slips(max(len(value), len(w))))
    assert t.search(value, most) == {k: distance(value, w) for k, w in enumerate(words) if distance(value, w) <= allowed(w)}


ENTRY = "canon_id bigint, list_name string, label string, aliases array<string>"
ENTRIES = [(1, "t", "xsd:string", ["str", None]), (2, "t", "xsd:dateTime", None), (3, "t", "SagProfile", ["sag shape"]), (4, "c", "OpalRadialLinkDepot", None), (5, "t", None, ["blob"]), (None, "t", "nothing", None), (6, "u", "twin", None), (7, "u", "Twin", None)]


@pytest.mark.parametrize(
    ("name", "value", "entry"),
    [("t", "strnig ", 1), ("t", "[xsd:string]", 1), ("t", "XSD string", 1), ("t", "STR", 1), ("t", "xsd::SagProfile", 3), ("t", "sag_profile", 3), ("t", "Sag-Shaqe", 3), ("t", "dateTirneStamp", 0), ("t", "??", 0), ("t", "", 0), ("t", "rev 3", 0), ("t", "blob", 5), ("t", "nothing", 0), ("u", "twin.", 0),
     ("c", "$\\mathrm{OpalRadialLinkDepot}$", 4), ("c", "Pkg::OpalRadialLinkDepot", 4), ("c", "urn:onto:Pkg#OpalRadialLnikDepot", 4), ("c", "OpalRadialLinkDepot [0..1]", 4), ("c", "Pkg.OpalRadialLinkDepot1 .. *", 4), ("c", "opal_radial_link_depot", 4), ("c", "OpalRadialLinkBay", 0), ("zz", "twin", 0)],
)
def test_mapped(spark, name, value, entry):
    tries = {n: Trie([(e[0], t) for e in ENTRIES if e[1] == n and e[0] for t in [e[2], *(e[3] or [])] if t]) for n in "tcu"}
    assert (tries[name].nearest(value) if name in tries else 0) == entry


def test_mapped_rows(spark):
    e = spark.createDataFrame(ENTRIES, ENTRY)
    rows = spark.createDataFrame([("f", "t", "1", -1, "strnig"), ("f", "t", "2", -1, None), ("f", "t", "3", -1, "xsd:string"), ("f", "t", "1", -1, "strnig"), ("g", "c", "k", 0, "zzz"), ("g", None, "k", 1, "zzz"), ("f", "t", "4", -1, "x" * 100_000)], "source_field string, list_name string, row_key string, pos int, value string")
    assert {tuple(r) for r in assigned(rows, e).collect()} == {("f", "1", -1, 1), ("g", "k", 0, 0), ("f", "4", -1, 0)}
    assert mapped(rows.select("list_name", "value").limit(0), e).count() == 0
    assert {r.canon_id for r in mapped(rows.select("list_name", "value"), e.limit(0)).collect()} == {0}
    assert readings("") == []


def test_candidates_and_blocks(spark, monkeypatch):
    """All entries within distance, whatever the number of tries they are spread over."""
    e = spark.createDataFrame([(k, "t", w, None) for k, w in enumerate(["lantern", "lanterns", "lamp", "camp", "harbour", "harbor"])], ENTRY)
    v = spark.createDataFrame([("t", w) for w in ["lanternz", "lamp", "bamp", "harbur", "zzz", "xx harbour"]], "list_name string, value string")
    get = lambda: {r.value: [(c.canon_id, c.slips) for c in r.found] for r in found(v, e).collect()}
    one, to = get(), {r.value: r.canon_id for r in mapped(v, e).collect()}
    assert one["bamp"] == [(2, 1), (3, 1)] and one["zzz"] == [] and one["lanternz"] == [(0, 1), (1, 1)] and one["lamp"][0] == (2, 0)
    assert to == {"lanternz": 0, "lamp": 2, "bamp": 0, "harbur": 0, "zzz": 0, "xx harbour": 4}
    monkeypatch.setattr(canon, "MAX_LIST_CHARS", 12)
    assert get() == one and {r.value: r.canon_id for r in mapped(v, e).collect()} == to


ALIKE = [
    (1, "Scope"), (2, "Sсоре"), (3, "Ｓｃｏｐｅ"), (4, "Sco\u200bpe"), (5, "scope"), (6, "Scope"), (7, "caf\u00e9"), (8, "cafe\u0301"), (9, "cafe"), (10, "m²"), (11, "m2"), (12, "①"), (13, "1"), (14, "off\u2011line ﬁx"), (15, "off-line fix"),
    (16, "Part Ⅱ"), (17, "Part II"), (18, "a\u00a0b"), (19, "a b"), (20, "⼤"), (21, "大"), (22, "Ё"), (23, "Ë"), (24, ""), (25, None), (None, "Scope"), (26, "½"), (27, "1/2"), (28, "x" * 200_000 + "ｙ"), (29, "x" * 200_000 + "y"), (1, "Scope"), (30, "а" * 3 + "\n"), (31, "aaa\n"),
    (32, "ρɡα\ufe01\u115f\U000e0041z"), (33, "pgaz"),
]


def test_lookalikes(spark):
    df = spark.createDataFrame([(a, b, "clash", "c") for a, b in ALIKE], "row bigint, words string, form string, id string")
    f = forms(df, "row", "words")
    assert f.count() == len(ALIKE) - 1
    got = {tuple(r) for r in alike(f).collect()}
    scope = {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (2, 6), (3, 6), (4, 6)}
    assert got == scope | {(7, 8), (14, 15), (16, 17), (18, 19), (20, 21), (22, 23), (28, 29), (30, 31), (32, 33)}
    assert forms(df.limit(0), "row", "words").count() == 0


def test_nothing_is_mapped_twice():
    one, to, several = lookalikes.tables()
    made = set(to) | {c for _, b in several for c in b}
    assert not made & set(one) and not made & {a for a, _ in several} and len(one) > 1000


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=20), max_size=10))
def test_forms_are_stable(spark, texts):
    texts = [t for t in texts if "\x00" not in t and t.isprintable()]
    once = forms(spark.createDataFrame(list(enumerate(texts)), "i bigint, t string"), "i", "t").orderBy("id").collect()
    again = forms(spark.createDataFrame([(r.id, r.form) for r in once], "i bigint, t string"), "i", "t").orderBy("id").collect()
    assert [r.form for r in once] == [r.form for r in again]
