"""Documents to the model: layouts of headings and tables."""

import pytest
from pyspark.sql import functions as F

from loomset.sources import markdown as md

SMALL = """# Core

## 6.1 Class: IdentifiedObject (Base)

| 属性 | 类型 | 基数 |
|---|---|---|
| mRID | string | 1..1 |
| name | string | 0..1 |

## 6.2 Class: PowerSystemResource

| 继承 | 父类 |
|---|---|
| 继承自 | IdentifiedObject |

## 6.3 Class: Meastrement

| 关联端 | 目标类 | 基数 |
|---|---|---|
| PowerSystemResource | PowerSystemResource | 0..* |
"""
INLINE = """## 6.7 直流

表8 Core::IdentifiedObject的属性
| 名字 | 重数 | 类型 | 描述 |
|---|---|---|---|
| mRID | 1..1 | String | 继承自：Root |

表9 Wires::ACLineSegment的属性 表10 Wires::Clamp的属性

<table><tr><td>重数自</td><td>名字</td><td>重数到</td><td>类型</td><td>描述</td></tr>
<tr><td>0..1</td><td>Seg&amp;ment</td><td>1..n</td><td>LineSegment</td><td>x</td></tr></table>
"""


def docs(spark, *texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")


def test_small_document(spark):
    m, uncertain = md.model(docs(spark, SMALL, None, ""))
    classes = {(r.name, r.stereotype) for r in m.classes.collect()}
    assert classes == {("IdentifiedObject", "Base"), ("PowerSystemResource", None), ("Measurement", None)}  # a known misreading is corrected
    a = {r.name: (r.data_type, r.multiplicity.min, r.multiplicity.max, r.required) for r in m.attribute.collect()}
    assert a == {"mRID": ("string", 1, 1, True), "name": ("string", 0, 1, False)}
    assert [r.class_name for r in m.parent.collect()] == ["IdentifiedObject"]
    s = m.association.collect()
    assert [(r.name, r.target.class_name, r.multiplicity.max) for r in s] == [("PowerSystemResource", "PowerSystemResource", None)]
    assert {r.name for r in m.package.collect()} == {"Core"} and uncertain.count() == 0


def test_titles_begin_sections_and_name_packages(spark):
    m, _ = md.model(docs(spark, INLINE))
    assert {(r.package, r.name) for r in m.named().collect()} == {("Core", "IdentifiedObject"), ("Wires", "ACLineSegment"), ("Wires", "Clamp")}
    assert [(r.name, r.data_type, r.inherited_from) for r in m.attribute.collect()] == [("mRID", "String", "Root")]
    assert [r.class_name for r in m.parent.collect()] == ["Root"]  # no table of parents: those that attributes name
    s = m.association.collect()[0]
    assert (s.name, s.target.class_name, s.multiplicity.min, s.multiplicity.max) == ("Seg&ment", "LineSegment", 1, None)
    assert [r.name for r in m.package.orderBy("pkg_ord").collect()] == ["Core", "Wires"]
    # the only known class that ends with a target stands for it
    fixed = md.resolved(m.with_(association=m.association.withColumn("target", F.col("target").withField("class_name", F.lit("LineSegment"))))).association.collect()[0]
    assert fixed.target.class_name == "ACLineSegment"


def test_tokens():
    text = "pre\n\n```\n## no\n```\n\n| a | b |\n|---|---|\n|  | 1 |\n\nTitle\n---\ntext one\ntwo"
    got = md.tokens_of(text)
    assert [t[0] for t in got] == ["paragraph", "code", "table", "heading", "paragraph"]
    assert got[2][2] == "a|b\n1" and md.tokens_of(text, keep_empty=True)[2][2] == "a|b\n|1"
    assert got[3] == ("heading", 2, "Title") and got[4][2] == "text one two"
    assert md.tokens_of("") == []


@pytest.mark.parametrize(
    ("headers", "kind"),
    [(["属性", "类型", "基数"], "property"), (["名字", "重数", "类型"], "property"), (["名字（a）", "类型"], "property"), (["关联端", "目标类"], "association"), (["重数自", "名字", "重数到"], "association"), (["重数", "目标", "类型", "描述"], "association"), (["枚举", "x"], "enumeration"), (["父类"], "inheritance"), (["x"], "unknown"), ([], "unknown")],
)
def test_kind_of_table(spark, headers, kind):
    df = spark.createDataFrame([(headers,)], "h array<string>")
    assert df.select(md.kind(F.col("h")).alias("k")).first().k == kind


def test_column_prefers_earlier_keyword_and_skips_noise(spark):
    df = spark.createDataFrame([(["$x名字", "名称", "name "],)], "h array<string>")
    pick = lambda words: df.select(md.column(F.col("h"), words).alias("c")).first().c
    assert pick(["名字", "名称"]) == 1 and pick(["name"]) == 2 and pick(["z"]) is None


def test_four_columns_take_the_target_from_the_name(spark):
    m, _ = md.model(docs(spark, "## 1 Class: A\n\n| 重数 | 目标 | 类型 | 描述 |\n|---|---|---|---|\n| 0..1 | Bay | 0..1 | d |\n"))
    s = m.association.collect()[0]
    assert (s.name, s.target.class_name) == ("Bay", "Bay")


def test_document_without_section(spark):
    found, inside = md.sections(md.tokens(docs(spark, "only text")))
    assert [(r.path, r.heading, r.class_name) for r in found.collect()] == [("0", "", None)] and inside.count() == 0


def test_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a.md").write_text(SMALL, encoding="utf-8")
    d = md.documents(spark, str(tmp_path)).collect()
    assert len(d) == 1 and d[0].text == SMALL and len(d[0].sha256) == 64


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("- a\n- b\n  c\n\n  d\n", [("paragraph", 0, "a"), ("paragraph", 0, "b c"), ("paragraph", 0, "d")]),
        ("> q\n> r\nlazy\n\nafter", [("paragraph", 0, "q r lazy"), ("paragraph", 0, "after")]),
        ("1. one\n   - two\n2) three", [("paragraph", 0, "one"), ("paragraph", 0, "two"), ("paragraph", 0, "three")]),
        ("text\n2. no item\n1. item", [("paragraph", 0, "text 2. no item"), ("paragraph", 0, "item")]),
        ("- # H\n- | a | b |\n  |---|---|\n  | 1 | 2 |\n", [("heading", 1, "H"), ("table", 0, "a|b\n1|2")]),
        ("> > - deep\n***\nx\n* * *\n", [("paragraph", 0, "deep"), ("paragraph", 0, "x")]),
        ("title\n---\n- \n-x", [("heading", 2, "title"), ("paragraph", 0, "-x")]),
        ("- ```\n  c\n  ```\n", [("code", 0, "c\n")]),
        (">" * 300 + " x", None),
    ],
)
def test_quotes_and_lists(text, want):
    got = md.tokens_of(text)
    assert got == want if want is not None else len(got) == 1
