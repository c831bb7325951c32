"""Markdown documents to tokens, sections, tables and the model.

Only the tokenizer is a Python function, as fences and HTML blocks need the lines before; it works on whole documents inside the partitions.
Everything after it is columns: sections are runs of tokens numbered by a running sum within their document.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import headings as H
from ..functions import multiplicity as M
from ..functions import names as N
from ..plans.model import Model

PARSER_VERSION = "0.2.0"
DEFAULT_PACKAGE = "Core"
# Headers of tables and columns, in the order in which they are tried.
PROPERTY_FIRST = ["属性", "property", "attribute"]
PROPERTY_EXACT = ["名字", "名称", "name", "属性名", "字段"]
COLUMNS = {
    "property": {"name": ["名字", "名称", "name", "property", "属性"], "type": ["类型", "type"], "mult": ["重数", "cardinality", "multiplicity", "基数"], "desc": ["描述", "description", "desc", "说明"]},
    "association": {
        "name": ["名字", "名称", "name", "关联端", "association"], "type": ["类型", "type", "目标", "target", "class"], "to": ["重数到", "cardinality_to"], "from": ["重数自", "cardinality_from"],
        "mult": ["重数", "cardinality", "基数", "multiplicity"], "desc": ["描述", "description", "desc", "说明"],
    },
}

_RULE = re.compile(r"^\s{0,3}\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?\s*$")
_FENCE = re.compile(r"^\s{0,3}(`{3,}|~{3,})")
_HEADING = re.compile(r"^\s{0,3}(#{1,6})(?:\s+(.*?))?(?:\s+#+)?\s*$")
_QUOTE = re.compile(r"^\s{0,3}> ?")
_ITEM = re.compile(r"^(\s{0,3})([-*+]|\d{1,9}[.)])(?:( {1,4})(?=\S)|( +)|\t|$)")
_BREAK = re.compile(r"^\s{0,3}([-*_])[ \t]*(?:\1[ \t]*){2,}$")
_HTML = re.compile(r"^\s{0,3}</?(?:table|thead|tbody|tr|td|th|div|p|ul|ol|li|h[1-6]|hr|section|center)\b|^\s{0,3}<!--", re.I)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, path, text, sha256) of the files under ``path``, each whole; the id is a hash of the path."""
    x = spark.read.text(path, wholetext=True).select("value", F.input_file_name().alias("path"))
    return x.select(F.xxhash64("path").alias("doc_id"), "path", F.col("value").alias("text"), F.sha2("value", 256).alias("sha256"))


def source_info(docs: DataFrame) -> DataFrame:
    """(doc_id, document_path, document_sha256, parsed_at, parser_version) of documents."""
    return docs.select("doc_id", F.col("path").alias("document_path"), F.col("sha256").alias("document_sha256"), F.current_timestamp().alias("parsed_at"), F.lit(PARSER_VERSION).alias("parser_version"))


def _cells(line: str) -> list[str]:
    s = line.strip()
    s = s[1:] if s.startswith("|") else s
    s = s[:-1] if s.endswith("|") and not s.endswith("\\|") else s
    return [" ".join(c.replace("\\|", "|").split()) for c in re.split(r"(?<!\\)\|", s)]


#: Quotes and items within each other; what is nested deeper stays text.
MOST_NESTED = 100


def _inside(lines: list[str], k: int) -> tuple[list[str], int]:
    """The lines of the block quote or list item that begins at ``lines[k]``, without what marks them as such, and where it ends. A paragraph in it goes
    on in lines that lack the mark."""
    own, loose = [], False
    if _QUOTE.match(lines[k]):
        while k < len(lines) and lines[k].strip() and (m := _QUOTE.match(lines[k]) or (not loose and own and own[-1].strip() and not _begins(lines[k]) and re.match("", lines[k]))):
            own.append(lines[k][m.end() :])
            k += 1
        return own, k
    m = _ITEM.match(lines[k])
    own, width, k = [lines[k][m.end() :]], m.end(2) + (len(m[3]) if m[3] else 1), k + 1
    while k < len(lines):
        line = lines[k]
        if not line.strip():
            loose = True
            own.append("")
        elif len(line) - len(line.lstrip(" ")) >= width:
            own.append(line[width:])
            loose = False
        elif not loose and own[-1].strip() and not _begins(line):
            own.append(line)
        else:
            break
        k += 1
    return own, k


def _begins(line: str) -> bool:
    """Whether a line begins a block of its own, so that no paragraph goes on in it."""
    return bool(_FENCE.match(line) or _HEADING.match(line) or _QUOTE.match(line) or _ITEM.match(line) or _BREAK.match(line) or _HTML.match(line))


def tokens_of(text: str, keep_empty: bool = False) -> list[tuple[str, int, str]]:
    """(type, level, content) of one document; what stands in block quotes and list items comes as if it stood alone. A table's rows are lines of cells
    joined with ``|``; its first cells that are empty vanish, as in the layout the rest was written for, unless ``keep_empty``."""
    return _tokens(text.splitlines(), keep_empty, 0)


def _tokens(lines: list[str], keep_empty: bool, deep: int) -> list[tuple[str, int, str]]:
    out: list[tuple[str, int, str]] = []
    k, para = 0, []

    def close() -> None:
        if para:
            out.append(("paragraph", 0, " ".join(" ".join(para).split())))
            para.clear()

    while k < len(lines):
        line = lines[k]
        if m := _FENCE.match(line):
            close()
            mark, body, k = m[1], [], k + 1
            while k < len(lines) and not re.match(rf"^\s{{0,3}}{re.escape(mark[0])}{{{len(mark)},}}\s*$", lines[k]):
                body.append(lines[k])
                k += 1
            out.append(("code", 0, "\n".join(body) + "\n" * bool(body)))
        elif m := _HEADING.match(line):
            close()
            out.append(("heading", len(m[1]), " ".join((m[2] or "").split())))
        elif _HTML.match(line) and not para:
            body = []
            while k < len(lines) and lines[k].strip():
                body.append(lines[k])
                k += 1
            out.append(("html", 0, "\n".join(body)))
            continue
        elif "|" in line and k + 1 < len(lines) and _RULE.match(lines[k + 1]) and "-" in lines[k + 1] and len(_cells(line)) == len(_cells(lines[k + 1])):
            close()
            head, rows, k = _cells(line), [], k + 2
            while k < len(lines) and lines[k].strip() and not _HEADING.match(lines[k]) and not _FENCE.match(lines[k]):
                rows.append((_cells(lines[k]) + [""] * len(head))[: len(head)])
                k += 1
            text_rows = []
            for row in [head, *rows]:
                first = 0 if keep_empty else next((i for i, c in enumerate(row) if c), len(row))
                text_rows.append("|".join(row[first:]))
            out.append(("table", 0, "\n".join(text_rows)))
            continue
        elif deep < MOST_NESTED and (_QUOTE.match(line) or (m := _ITEM.match(line)) and not _BREAK.match(line) and not (para and (not line[m.end() :].strip() or m[2][-1] in ".)" and m[2][:-1] != "1"))):
            close()
            own, k = _inside(lines, k)
            out += _tokens(own, keep_empty, deep + 1)
            continue
        elif not line.strip():
            close()
        elif not para and re.match(r"^(?: {4}|\t)", line):
            pass  # an indented block holds nothing of the model
        elif m := re.match(r"^\s{0,3}(=+|-+)\s*$", line) if para else None:
            content = " ".join(" ".join(para).split())
            para.clear()
            out.append(("heading", 1 if m[1][0] == "=" else 2, content))
        elif _BREAK.match(line):
            close()
        else:
            para.append(line)
        k += 1
    close()
    return out


def tokens(docs: DataFrame, keep_empty: bool = False) -> DataFrame:
    """(doc_id, tok_ord, type, level, content) of (doc_id, text); HTML tables are tables like others, other HTML is left out."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [(d, i, *t) for d, text in zip(pdf["doc_id"], pdf["text"]) for i, t in enumerate(tokens_of(text, keep_empty))]
            yield pd.DataFrame(rows, columns=["doc_id", "tok_ord", "type", "level", "content"])

    x = docs.select("doc_id", "text").where("text is not null").mapInPandas(run, "doc_id bigint, tok_ord int, type string, level int, content string")
    table = H.html_table(F.col("content"))
    x = x.withColumn("content", F.when(F.col("type") == "html", table).otherwise(F.col("content")))
    return x.where("type <> 'html' or content <> ''").withColumn("type", F.when(F.col("type") == "html", "table").otherwise(F.col("type")))


def sections(toks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sec_ord, path, heading, class_name, stereotype, package), and the tokens of each section. A heading of level 2 begins a section;
    within one, each title of a table in a paragraph begins another, of the same path and stereotype. What comes before the first is
    dropped; a document without any is one empty section."""
    titles = H.table_titles(F.col("content"))
    is_h2 = (F.col("type") == "heading") & (F.col("level") == 2)
    has = (F.col("type") == "paragraph") & F.col("content").rlike(H.TABLE_TITLE)
    plain = F.struct(F.lit(None).cast("string").alias("package"), F.lit(None).cast("string").alias("class_name"), F.lit(None).cast("string").alias("title"), F.col("content").alias("tail"))
    before = F.struct(plain["package"].alias("package"), plain["class_name"].alias("class_name"), plain["title"].alias("title"), H.before_titles(F.col("content")).alias("tail"))
    x = toks.withColumn("_p", F.when(has, F.concat(F.array(before), titles)).otherwise(F.array(plain)))
    x = x.select("doc_id", "tok_ord", "type", "level", "content", is_h2.alias("h2"), F.posexplode("_p").alias("pos", "p"))
    w = Window.partitionBy("doc_id").orderBy("tok_ord", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("h", F.when(F.col("h2"), H.parse_heading(F.col("content")))).withColumn("h", F.last("h", ignorenulls=True).over(w)).where("h is not null")
    begins = F.col("h2") | F.col("p.title").isNotNull()
    x = x.withColumn("sec_ord", F.sum(begins.cast("int")).over(w) - 1)
    found = x.where(begins).select(
        "doc_id", "sec_ord", "h.path", F.coalesce("p.title", "content").alias("heading"), F.coalesce("p.class_name", F.when(F.col("h2"), F.col("h.class_name"))).alias("class_name"), "h.stereotype", "p.package",
    )
    none = toks.groupBy("doc_id").agg(F.max(is_h2).alias("any")).where("not any")
    empty = none.select("doc_id", F.lit(0).cast("bigint").alias("sec_ord"), F.lit("0").alias("path"), F.lit("").alias("heading"), *[F.lit(None).cast("string").alias(c) for c in ("class_name", "stereotype", "package")])
    inside = x.where("not h2 and p.tail <> ''").select("doc_id", "sec_ord", "tok_ord", "pos", "type", "level", F.col("p.tail").alias("content"))
    return found.unionByName(empty), inside


def tables(inside: DataFrame) -> DataFrame:
    """(doc_id, sec_ord, tok_ord, kind, headers, rows) of the tables in sections. Blank lines and rules are dropped, the first line is the header;
    entities are decoded and tags dropped."""
    x = inside.where("type = 'table'")
    rule = lambda r: F.replace(r, F.lit("|"), F.lit("")).rlike(r"^[-:]+$")
    lines = F.filter(F.transform(F.split("content", "\n"), N.strip), lambda r: (r != "") & ~rule(r))

    @F.pandas_udf("string")
    def decoded(s: pd.Series) -> pd.Series:
        return s.map(lambda v: html.unescape(v) if v and "&" in v else v)

    clean = F.transform(lines, lambda r: F.transform(F.split(r, r"\|"), lambda c: N.clean_inline(F.regexp_replace(c, "<[^>]*>", ""))))
    x = x.withColumn("content", decoded("content")).withColumn("cells", clean).where(F.size("cells") > 0)
    return x.select("doc_id", "sec_ord", "tok_ord", kind(F.get("cells", F.lit(0))).alias("kind"), F.get("cells", F.lit(0)).alias("headers"), F.slice("cells", F.lit(2), F.size("cells")).alias("rows"))


def kind(headers):
    """What a table holds, by its headers; the order of the rules counts."""
    low = F.transform(headers, F.lower)
    first = F.coalesce(F.get(low, F.lit(0)), F.lit(""))
    some = lambda *words: F.exists(low, lambda h: F.array_max(F.array(*[h.contains(w) for w in words])))
    begins = lambda *words: F.array_max(F.array(*[first.contains(w) for w in words]))
    return (
        F.when(begins(*PROPERTY_FIRST), "property")
        .when(first.isin(PROPERTY_EXACT), "property")
        .when(begins("名字", "名称") & some("类型", "重数"), "property")
        .when(begins("关联端", "association", "关联"), "association")
        .when(first.contains("重数自") | some("重数到"), "association")
        .when((F.size(headers) == 4) & first.contains("重数") & some("目标", "target"), "association")
        .when(begins("字面量", "literal", "枚举"), "enumeration")
        .when(begins("继承", "父类", "super"), "inheritance")
        .otherwise("unknown")
    )


def column(headers, keywords: list[str]):
    """0-based place of the column: keyword by keyword, a header that equals it, else one without noise that contains it; null if none does."""
    clean = F.transform(headers, N.strip)

    def places(w: str) -> list:
        exact = F.nullif(F.array_position(clean, w), F.lit(0)) - 1
        inside = F.transform(clean, lambda h, i: F.when(h.contains(w) & ~N.is_noisy_header(h), i))
        return [exact.cast("int"), F.get(F.array_compact(inside), F.lit(0))]

    return F.coalesce(*[c for w in keywords for c in places(w)])


def model(docs: DataFrame, keep_empty: bool = False) -> tuple[Model, DataFrame]:
    """The model of (doc_id, text), and its uncertain entries (doc_id, case_id, package, raw_text, uncertainty_reason, context_snippet). Classes
    go to the package of their table's title, else to Core; packages stand in the order of their first class. Of several tables of a kind the
    last counts. Sections with a numbered path have no uncertain entries."""
    found, inside = sections(tokens(docs, keep_empty))
    classes = found.where("class_name is not null").withColumn("package", F.coalesce(F.nullif("package", F.lit("")), F.lit(DEFAULT_PACKAGE)))
    w = Window.partitionBy("doc_id")
    classes = classes.withColumn("_first", F.min("sec_ord").over(Window.partitionBy("doc_id", "package")))
    classes = classes.withColumn("pkg_ord", (F.dense_rank().over(w.orderBy("_first")) - 1).cast("int")).withColumn("cls_ord", (F.row_number().over(Window.partitionBy("doc_id", "package").orderBy("sec_ord")) - 1).cast("int"))
    key = classes.select("doc_id", "sec_ord", "pkg_ord", "cls_ord")
    last = tables(inside).groupBy("doc_id", "sec_ord", "kind").agg(F.max_by(F.struct("headers", "rows"), "tok_ord").alias("t")).join(key, ["doc_id", "sec_ord"])
    rows = last.select("doc_id", "pkg_ord", "cls_ord", "kind", "t.headers", F.posexplode("t.rows").alias("ord", "row"))
    at = lambda c: F.get("row", c)
    p = rows.where("kind = 'property'")
    for c, words in COLUMNS["property"].items():
        p = p.withColumn(f"c_{c}", column(F.col("headers"), words))
    p = p.where(at(F.col("c_name")).isNotNull()).withColumn("multiplicity", M.parse_or_optional(at(F.col("c_mult"))))
    attribute = p.select("doc_id", "pkg_ord", "cls_ord", F.col("ord").alias("attr_ord"), at(F.col("c_name")).alias("name"), F.coalesce(at(F.col("c_type")), F.lit("")).alias("data_type"), "multiplicity", F.lit(None).cast("string").alias("description"), (F.col("multiplicity.min") >= 1).alias("required"), H.inherited_from(at(F.col("c_desc"))).alias("inherited_from"))
    s = rows.where("kind = 'association'")
    for c, words in COLUMNS["association"].items():
        s = s.withColumn(f"c_{c}", column(F.col("headers"), words))
    n = F.size("headers")
    s = s.withColumn("c_name", F.coalesce("c_name", F.when(n >= 2, 1))).withColumn("c_type", F.coalesce("c_type", F.when(n >= 4, 3)))
    targeted = (n == 4) & F.exists("headers", lambda h: h.contains("目标") | F.lower(h).contains("target"))
    s = s.withColumn("c_type", F.when(targeted, F.coalesce("c_name", F.lit(1))).otherwise(F.col("c_type"))).where(at(F.col("c_name")).isNotNull())
    said = F.coalesce(*[F.when(~N.blank(at(F.col(f"c_{c}"))), at(F.col(f"c_{c}"))) for c in ("to", "from", "mult")])
    target = F.struct(F.lit(DEFAULT_PACKAGE).alias("package"), F.coalesce(at(F.col("c_type")), F.lit("")).alias("class_name"), F.lit(None).cast("string").alias("iri"), F.lit(False).alias("is_external"))
    association = s.select("doc_id", "pkg_ord", "cls_ord", F.col("ord").alias("assoc_ord"), at(F.col("c_name")).alias("name"), target.alias("target"), M.parse_or_optional(said).alias("multiplicity"), F.lit(None).cast("string").alias("inverse_name"), H.inherited_from(at(F.col("c_desc"))).alias("inherited_from"))
    own = rows.where("kind = 'inheritance'").select("doc_id", "pkg_ord", "cls_ord", F.struct(F.lit(0).alias("phase"), "ord").alias("ord"), F.get(F.filter(F.transform("row", N.strip), lambda c: c.rlike(r"^[A-Z][A-Za-z0-9]+\z")), F.lit(0)).alias("class_name")).where("class_name is not null")
    heirs = attribute.select("doc_id", "pkg_ord", "cls_ord", F.struct(F.lit(1).alias("phase"), F.col("attr_ord").alias("ord")).alias("ord"), "inherited_from").unionByName(association.select("doc_id", "pkg_ord", "cls_ord", F.struct(F.lit(2).alias("phase"), F.col("assoc_ord").alias("ord")).alias("ord"), "inherited_from"))
    heirs = heirs.where("inherited_from is not null").groupBy("doc_id", "pkg_ord", "cls_ord", F.col("inherited_from").alias("class_name")).agg(F.min("ord").alias("ord")).join(own.select("doc_id", "pkg_ord", "cls_ord").distinct(), ["doc_id", "pkg_ord", "cls_ord"], "left_anti")
    up = own.unionByName(heirs.select(*own.columns)).withColumn("par_ord", (F.row_number().over(Window.partitionBy("doc_id", "pkg_ord", "cls_ord").orderBy("ord")) - 1).cast("int"))
    parent = up.select("doc_id", "pkg_ord", "cls_ord", "par_ord", F.lit(DEFAULT_PACKAGE).alias("package"), "class_name", F.lit(None).cast("string").alias("iri"), F.lit(False).alias("is_external"))
    package = classes.select("doc_id", "pkg_ord", "package").distinct().select("doc_id", "pkg_ord", F.concat(F.lit("http://iec.ch/TC57/2024/CIM-schema-cim17#"), "package").alias("iri"), F.col("package").alias("name"), F.lit(None).cast("string").alias("package_id"), F.lit("0.1.0").alias("version"))
    from ..operators.resolve import SEED_CLASSES, clean_class_names

    known = docs.sparkSession.createDataFrame([(c,) for c in SEED_CLASSES], "name string")
    names = clean_class_names(classes.select(F.col("class_name").alias("name")), known)
    cleaned = classes.join(names.withColumnRenamed("name", "class_name"), "class_name")
    doubtful = cleaned.where("uncertainty_reason is not null").where(~F.concat_ws("::", "path", "class_name").rlike(r"^\d+(\.\d+)*::"))
    uncertain = doubtful.select("doc_id", F.concat_ws("::", "path", "class_name").alias("case_id"), "package", F.col("class_name").alias("raw_text"), "uncertainty_reason", F.col("heading").alias("context_snippet"))
    cls = cleaned.select("doc_id", "pkg_ord", "cls_ord", F.col("value").alias("name"), F.lit(None).cast("string").alias("description"), "stereotype", F.lit(None).cast("int").alias("source_table"))
    enumeration = package.limit(0).select("doc_id", "pkg_ord", F.lit(0).alias("enum_ord"), "name", F.array().cast("array<string>").alias("values"))
    return Model(package, cls, parent, attribute, association, enumeration), uncertain


def resolved(m: Model) -> Model:
    """The model with the targets of associations repaired and noisy names of attributes emptied."""
    from ..operators.resolve import cleaned_attributes, resolved_targets

    a = resolved_targets(m).withColumn("target", F.col("target").withField("class_name", F.col("class_name"))).select(*m.association.columns)
    return m.with_(association=a, attribute=cleaned_attributes(m).drop("noise"))
