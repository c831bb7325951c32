"""Queries of the operators on training data, each with production settings over its whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import table
from . import canon, copies, leaks, lookalikes, mix, spans


def _records(spark: SparkSession, sf: str) -> copies.Collapsed:
    return copies.Collapsed(table(spark, sf, "class_record"), "rec_id", copies.canonical_key(["package_name", "class_name"], ["props"]))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf).copies()


def p1_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct record and how many rows it had."""
    return _records(spark, sf).kept()


def _typed_values(spark: SparkSession, sf: str) -> DataFrame:
    """The freely typed values of both tables in one form."""
    noise = table(spark, sf, "ocr_noise_samples")
    row = lambda field, name, key, pos, value: (F.lit(field).alias("source_field"), F.lit(name).alias("list_name"), key.alias("row_key"), pos.cast("int").alias("pos"), value.alias("value"))
    types = table(spark, sf, "data_property").select(*row("data_type", "data_type", F.col("attr_id").cast("string"), F.lit(-1), F.col("data_type")))
    fixes = noise.select(*row("expected_correction", "class_name", F.col("case_id"), F.lit(-1), F.col("expected_correction")))
    hints = noise.select("case_id", F.posexplode("cleaned.suggestions").alias("pos", "value")).select(*row("suggestions", "class_name", F.col("case_id"), F.col("pos"), F.col("value")))
    return types.unionByName(fixes).unionByName(hints)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return canon.assigned(_typed_values(spark, sf), table(spark, sf, "canon_entry"))


def p3_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Values that are none of the entries, with the number of rows that have them."""
    values = _typed_values(spark, sf).where("value is not null")
    none = canon.mapped(values.select("list_name", "value"), table(spark, sf, "canon_entry")).where("canon_id = 0")
    return values.join(none, ["list_name", "value"]).groupBy("list_name", "value").agg(F.count("*").alias("n_rows"))


def p3_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Every entry within the slips that a value's length allows, the nearest first; a value with none has one row without an entry."""
    x = canon.found(_typed_values(spark, sf), table(spark, sf, "canon_entry"))
    return x.select("list_name", "value", F.posexplode_outer("found").alias("place", "c")).select("list_name", "value", "place", "c.slips", "c.canon_id")


_TEXTS = (("section_row", "sec_id", "heading"), ("md_token", "tok_id", "content"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    a, b = (lookalikes.alike(lookalikes.forms(table(spark, sf, t), i, x)).select(F.lit(t).alias("source_table"), "row_a", "row_b") for t, i, x in _TEXTS)
    return a.unionByName(b)


def p6_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Every text in its one form."""
    a, b = (lookalikes.forms(table(spark, sf, t), i, x).select(F.lit(t).alias("source_table"), F.col("id").alias("row_id"), "form") for t, i, x in _TEXTS)
    return a.unionByName(b)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaked_items(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p7_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Every item and document with a passage in common within the edit budget: the most words in a row without an edit, and within it."""
    return leaks.leaked(table(spark, sf, "documents"), table(spark, sf, "eval_items")).select("item_id", "doc_id", "words", "near_words")


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix.Mixture(table(spark, sf, "documents"), table(spark, sf, "mix_target")).chosen()


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mix.Mixture(table(spark, sf, "documents"), table(spark, sf, "mix_target")).shares()


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return spans.SharedSpans(table(spark, sf, "documents")).pairs()


def p9_shared(spark: SparkSession, sf: str) -> DataFrame:
    """How much of each document stands in others too."""
    return spans.SharedSpans(table(spark, sf, "documents")).share()


def p9_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Each document without the sentences that an earlier one has in a long stretch."""
    x = spans.SharedSpans(table(spark, sf, "documents")).kept()
    return x.select("doc_id", F.length("text").alias("kept_chars"), F.md5("text").alias("kept_md5"))


def p9_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The groups of documents with a stretch in common, by members."""
    return spans.SharedSpans(table(spark, sf, "documents")).classes()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (p1_found, p1_kept, p3_found, p3_unmatched, p3_candidates, p6_found, p6_forms, p7_found, p7_passages, p8_mix, p8_shares, p9_found, p9_classes, p9_shared, p9_kept)
    return {f.__name__: f for f in every}


_BARE = r"lower(regexp_replace({}, '[^\p{{L}}\p{{N}}\p{{M}}]', '', 'g'))".format
_P1 = f"""
WITH e AS (SELECT rec_id, unnest(regexp_split_to_array(props, '[;|\\r\\n]')) AS x FROM class_record WHERE props IS NOT NULL),
k AS (SELECT rec_id, {_BARE("regexp_extract(x, '^([^=:]*)', 1)")} || '=' || {_BARE("regexp_extract(x, '^[^=:]*[=:]((?s).*)$', 1)")} AS x FROM e),
s AS (SELECT rec_id, string_agg(DISTINCT x, ';' ORDER BY x) FILTER (x <> '=') AS p FROM k GROUP BY 1),
c AS (SELECT rec_id, {_BARE("package_name")} AS a, {_BARE("class_name")} AS b, CASE WHEN props IS NOT NULL THEN coalesce(s.p, '') END AS p FROM class_record LEFT JOIN s USING (rec_id))
"""


_WIDE = "'" + "".join(map(chr, range(0xFF01, 0xFF5F))).replace("'", "''") + "', '" + "".join(map(chr, range(0x21, 0x7F))).replace("'", "''") + "'"
_PLAIN = lambda x: rf"lower(regexp_replace(translate({x}, {_WIDE}), '[^\p{{L}}\p{{N}}]', '', 'g'))"
_WS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def _readings(x: str) -> str:
    """SQL of the ways a value may be read, as a list of bare forms with nulls."""
    bare_ = x
    for _ in range(4):  # commands within commands
        bare_ = rf"regexp_replace({bare_}, '\\[A-Za-z]+\s*\{{([^{{}}]*)\}}', '\1', 'g')"
    trim = lambda y: f"regexp_replace({y}, '^{_WS}+|{_WS}+$', '', 'g')"
    bare_ = trim(f"replace(replace({bare_}, '$', ' '), '{chr(92)}_', '_')")
    inner = trim(rf"regexp_replace({bare_}, '[\s\[(]*(?:\d+\s*\.\.\s*(?:\d+|\*|n)|\*)[\s\])]*$', '')")
    cuts = (r"'^(?:urn:[^#\s]*#|[A-Za-z][A-Za-z0-9]*\s*::|[A-Za-z][A-Za-z0-9]*:)((?s).+)$', '\1'", r"'(?i)^xsd(?:[\s:_\-.]+)((?s).+)$', '\1'", r"'^[A-Z][A-Za-z0-9]*\.([A-Z][A-Za-z0-9]*)$', '\1'")
    return f"(SELECT list_transform([{x}, s, " + ", ".join(f"CASE WHEN regexp_replace(s, {c}) <> s THEN ltrim(regexp_replace(s, {c}), ':') END" for c in cuts) + f"], lambda y: nullif({_PLAIN('y')}, '')) FROM (SELECT {inner} AS s))"


_SLIPS = "CASE WHEN {0} >= 15 THEN 3 WHEN {0} >= 6 THEN 2 WHEN {0} >= 4 THEN 1 ELSE 0 END".format
_P3 = f"""
WITH raw AS (SELECT 'data_type' AS source_field, 'data_type' AS list_name, attr_id::VARCHAR AS row_key, -1 AS pos, data_type AS value FROM data_property UNION ALL SELECT 'expected_correction', 'class_name', case_id, -1, expected_correction FROM ocr_noise_samples
  UNION ALL SELECT 'suggestions', 'class_name', case_id, (i - 1)::INT, cleaned.suggestions[i] FROM ocr_noise_samples, unnest(range(1, len(cleaned.suggestions) + 1)) AS t(i)),
v AS (SELECT DISTINCT list_name, value FROM raw WHERE value IS NOT NULL),
n AS (SELECT DISTINCT list_name, canon_id, unnest(list_append(aliases, label)) AS text FROM canon_entry WHERE canon_id IS NOT NULL),
e AS (SELECT DISTINCT list_name, canon_id, form FROM (SELECT list_name, canon_id, unnest({_readings("text")}) AS form FROM n WHERE text IS NOT NULL) WHERE form IS NOT NULL),
f AS (SELECT list_name, value, k, r[k] AS form FROM (SELECT list_name, value, {_readings("value")} AS r FROM v), unnest(range(1, 6)) AS t(k) WHERE r[k] IS NOT NULL),
c AS (SELECT list_name, value, canon_id, min({{'d': damerau_levenshtein(f.form, e.form), 'k': k}}) AS best FROM f JOIN e USING (list_name)
  WHERE abs(length(f.form) - length(e.form)) <= 3 AND damerau_levenshtein(f.form, e.form) <= least({_SLIPS("length(f.form) + 1")}, {_SLIPS("greatest(length(f.form), length(e.form))")}) GROUP BY ALL),
m AS (SELECT list_name, value, CASE WHEN count(*) = 1 THEN any_value(canon_id) ELSE 0 END AS canon_id FROM (SELECT *, best = min(best) OVER (PARTITION BY list_name, value) AS near FROM c) WHERE near GROUP BY 1, 2),
a AS (SELECT v.*, coalesce(m.canon_id, 0)::BIGINT AS canon_id FROM v LEFT JOIN m USING (list_name, value))
"""


def _form(name: str, key: str, col: str) -> str:
    return lookalikes.sql(", text").replace("FROM batch", f"FROM (SELECT {key} AS id, {col} AS text FROM {name} WHERE {col} IS NOT NULL)")


def _same_reading(name: str, key: str, col: str) -> str:
    form = _form(name, key, col)
    return f"SELECT DISTINCT '{name}' AS source_table, a.id AS row_a, b.id AS row_b FROM ({form}) a JOIN ({form}) b ON a.form = b.form AND a.text <> b.text AND a.id < b.id"


def _words(name: str, key: str) -> str:
    return rf"SELECT {key}, regexp_extract_all(lower(regexp_replace(text, '\\[\p{{L}}]+', ' ', 'g')), '[\p{{L}}\p{{N}}]+') AS w FROM {name} WHERE text IS NOT NULL"


def _runs(name: str, key: str, n: int) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(w[i : i + {n - 1}], ' ') AS run FROM ({_words(name, key)}), unnest(range(1, len(w) - {n - 2})) AS t(i)"


_N = leaks.Settings().words
_P9 = """
WITH h AS (SELECT doc_id, i, hash(substr(text, i, {0})) AS h FROM documents, unnest(range(1, length(text) - {0} + 2)) AS t(i) WHERE length(text) >= {0}),
""".format(spans.Settings().length)
_L = spans.Settings().length


def oracle_sql() -> dict[str, str]:
    """``p7`` and ``p9`` state the result outright: all runs of words, all windows of characters."""
    return {
        "p1_found": _P1 + ", g AS (SELECT rec_id, min(rec_id) OVER (PARTITION BY a, b, p) AS keep_id FROM c) SELECT DISTINCT keep_id, rec_id AS copy_id FROM g WHERE rec_id <> keep_id",
        "p1_kept": _P1 + "SELECT min(rec_id) AS keep_id, count(*) AS copies FROM c GROUP BY a, b, p",
        "p3_found": _P3 + "SELECT DISTINCT source_field, row_key, pos, canon_id FROM raw JOIN a USING (list_name, value) WHERE NOT EXISTS (FROM canon_entry l WHERE l.list_name = raw.list_name AND l.label = raw.value)",
        "p3_unmatched": _P3 + "SELECT list_name, value, count(*) AS n_rows FROM raw JOIN a USING (list_name, value) WHERE canon_id = 0 GROUP BY ALL",
        "p3_candidates": _P3 + "SELECT v.list_name, v.value, CASE WHEN canon_id IS NOT NULL THEN (row_number() OVER (PARTITION BY v.list_name, v.value ORDER BY best, canon_id) - 1)::INT END AS place, best.d::INT AS slips, canon_id FROM v LEFT JOIN c USING (list_name, value)",
        "p6_found": " UNION ALL ".join(_same_reading(*x) for x in _TEXTS),
        "p6_forms": " UNION ALL ".join(f"SELECT '{x[0]}' AS source_table, id AS row_id, form FROM ({_form(*x)})" for x in _TEXTS),
        "p7_found": f"SELECT DISTINCT item_id, doc_id FROM ({_runs('eval_items', 'item_id', _N)}) JOIN ({_runs('documents', 'doc_id', _N)}) USING (run)",
        "p9_found": f"""
            WITH h AS (SELECT DISTINCT doc_id, hash(substr(text, i, {_L})) AS h FROM documents, unnest(range(1, length(text) - {_L - 2})) AS t(i) WHERE length(text) >= {_L}),
            d AS (SELECT * FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1))
            SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM d a JOIN d b ON a.h = b.h AND a.doc_id < b.doc_id""",
        "p9_classes": _P9 + """
            g AS (SELECT list_sort(list(DISTINCT doc_id)) AS docs FROM h GROUP BY h HAVING count(DISTINCT doc_id) > 1
              UNION ALL SELECT list_sort(list(DISTINCT doc_id)) FROM documents WHERE length(text) >= 400 GROUP BY text HAVING count(DISTINCT doc_id) > 1)
            SELECT DISTINCT docs[1] AS first_id, len(docs)::BIGINT AS n_docs, unnest(docs) AS doc_id FROM (SELECT DISTINCT docs FROM g)""",
        "p9_kept": _P9 + rf"""
            f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
            w AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > {_L} AS gap FROM h JOIN f USING (h) WHERE doc_id > first),
            p AS (SELECT doc_id, min(i) - 1 AS a, max(i) - 1 + {_L} AS b FROM (SELECT doc_id, i, sum(coalesce(gap, false)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM w) GROUP BY doc_id, k),
            s AS (SELECT doc_id, n, x[n] AS part, coalesce(list_sum(list_transform(x[1:n - 1], lambda y: length(y))), 0)::BIGINT AS a
              FROM (SELECT doc_id, regexp_extract_all(text, '(?s).*?(?:\n+|[.!?;\x{{3002}}\x{{FF01}}\x{{FF1F}}] )|.+') AS x FROM documents WHERE text IS NOT NULL), unnest(range(1, len(x) + 1)) AS t(n)),
            k AS (SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.doc_id = s.doc_id AND p.a <= s.a AND s.a + length(s.part) <= p.b)),
            t AS (SELECT doc_id, string_agg(part, '' ORDER BY n) AS text FROM k GROUP BY 1)
            SELECT doc_id, length(coalesce(t.text, ''))::INT AS kept_chars, md5(coalesce(t.text, '')) AS kept_md5 FROM documents LEFT JOIN t USING (doc_id) WHERE documents.text IS NOT NULL""",
        "p9_shared": _P9 + f"""
            m AS (SELECT doc_id, least({_L}, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {_L})) AS part FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(DISTINCT doc_id) > 1)),
            s AS (SELECT doc_id, sum(part)::BIGINT AS shared FROM m GROUP BY 1)
            SELECT doc_id, length(text) AS n_chars, coalesce(shared, 0) AS shared_chars, CASE WHEN length(text) > 0 THEN coalesce(shared, 0) / length(text) ELSE 0.0 END AS share FROM documents LEFT JOIN s USING (doc_id) WHERE text IS NOT NULL""",
    }
