"""One form for texts that read the same: DuckDB inside Arrow partitions, the mapping in embedded SQL."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import written

# Letters drawn like a Latin one, block by block, each beside the letter it is drawn like.
CYRILLIC = "АВЕКМНОРСТУХЅІЈҮаеорсухѕіјһԁԛԝԚԜӀ"
AS_CYRILLIC = "ABEKMHOPCTYXSIJYaeopcyxsijhdqwQWI"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿϳονϲαρ"
AS_GREEK = "ABEZHIKMNOPTYXCJjovcap"
ARMENIAN = "ՕՏԼօսոհց"
AS_ARMENIAN = "OSLounhg"
OTHERS = "ɡꓐꓑꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ"
AS_OTHERS = "gBPTGKJCZFMNLSRVHWXYAEIOU"
# Signs drawn like an ASCII one.
SIGNS = "‐‑˗⁃−﹣․∶꞉⁄∕⧸∗∣❘‚;′"
AS_SIGNS = "------.::///*||,;'"
# Ranges in which every format character has no body, beside fillers, joiners and selectors of variants, which have none either;
# and spaces of any width.
FORMAT = [(0xAD, 0xAD), (0x61C, 0x61C), (0x180E, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x2064), (0x2066, 0x206F), (0xFEFF, 0xFEFF), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0001, 0xE0001), (0xE0020, 0xE007F)]
BODILESS = [(0x34F, 0x34F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180D), (0x180F, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0100, 0xE01EF)]
INVISIBLE = "".join(chr(c) for lo, hi in FORMAT + BODILESS for c in range(lo, hi + 1))
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
# Ranges of compatibility forms that are drawn like what they stand for (full and half width, ligatures, numerals built of
# letters, radicals, variants of presentation); superscripts, fractions and circled signs are not among them.
COMPATIBLE = [(0x2160, 0x217F), (0x2E80, 0x2FD5), (0x3131, 0x318E), (0xF900, 0xFAFF), (0xFB00, 0xFB4F), (0xFE50, 0xFE6F), (0xFF01, 0xFFEE)]


@cache
def tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """What translate takes from and to, and the characters that become several, by rule from the values above."""
    single = dict(zip(CYRILLIC + GREEK + ARMENIAN + OTHERS + SIGNS + SPACES, AS_CYRILLIC + AS_GREEK + AS_ARMENIAN + AS_OTHERS + AS_SIGNS + " " * len(SPACES)))
    letters = dict(single)
    for c in map(chr, [*range(0x370, 0x530), *range(0x1F00, 0x2000)]):  # letters with accents whose bare letter has a double
        parts = unicodedata.normalize("NFD", c)
        if len(parts) > 1 and parts[0] in letters and len(new := unicodedata.normalize("NFC", letters[parts[0]] + parts[1:])) == 1:
            single[c] = new
    several = {}
    for lo, hi in COMPATIBLE:
        for c in map(chr, range(lo, hi + 1)):
            new = "".join(letters.get(x, x) for x in unicodedata.normalize("NFKC", c))
            if new != c and unicodedata.category(c) != "Cn":
                (single if len(new) == 1 else several)[c] = new
    gone = set(INVISIBLE)
    single = {a: b for a, b in single.items() if a not in gone}
    return "".join(single) + INVISIBLE, "".join(single.values()), tuple(sorted((a, b) for a, b in several.items()))


@cache
def sql(also: str = "") -> str:
    """The embedded SQL, with the columns ``also`` handed on. Characters are mapped only in texts that hold one of their block, and
    those that become several are replaced one by one only in texts that hold one of them."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    one, to, several = tables()
    long = "text"
    for a, b in several:
        long = f"replace({long}, {quote(a)}, {quote(b)})"
    class_ = lambda chars: quote("[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]")
    step = f"SELECT id{also}, text AS form, regexp_full_match(text, '[\\x00-\\x7f]*', 's') AS plain FROM batch"
    step = f"SELECT * REPLACE (CASE WHEN NOT plain AND regexp_matches(form, {class_([a for a, _ in several])}) THEN {long.replace('(text,', '(form,')} ELSE form END AS form) FROM ({step})"
    # translate reads its whole table for every text: the table is cut by blocks of characters, of which a text holds few
    parts: dict[int, list[str]] = {}
    for c in one:
        parts.setdefault(ord(c) >> 8, []).append(c)
    to += "\0" * (len(one) - len(to))
    for own in parts.values():
        own.sort(key=lambda c: to[one.index(c)] == "\0")  # those without a body last
        new = "".join(to[one.index(c)] for c in own).rstrip("\0")
        step = f"SELECT * REPLACE (CASE WHEN NOT plain AND regexp_matches(form, {class_(own)}) THEN translate(form, {quote(''.join(own))}, {quote(new)}) ELSE form END AS form) FROM ({step})"
    # runs of joining marks stay in canonical order: nfc_normalize comes last
    return f"SELECT id{also}, CASE WHEN plain THEN form ELSE nfc_normalize(form) END AS form FROM ({step})"


def forms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, form) of every row with a text: ``form`` is the same for texts that read the same. Null texts have no row; an empty text
    keeps an empty form; a null id is kept. Letter case, superscripts, fractions, circled digits, accents and line breaks are kept."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        # one statement for the whole partition, which streams through it
        names = ["id", "text", "form"]
        with duckdb.connect(config={"threads": 1}) as db:
            rows = pa.RecordBatchReader.from_batches(pa.schema([("id", pa.int64()), ("text", pa.string())]), (pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.string())], names=names[:2]) for b in batches))
            db.register("batch", rows)
            for b in db.sql(sql(", text")).to_arrow_reader(8192):
                yield pa.RecordBatch.from_arrays([b.column(n).cast(pa.int64() if n == "id" else pa.string()) for n in names], names=names)

    own = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return own.mapInArrow(scan, "id bigint, text string, form string")


def alike(rows: DataFrame) -> DataFrame:
    """(row_a, row_b), row_a < row_b, of (id, text, form) whose forms are equal and texts are not. Forms meet by 128 bits of their hash, so that no text
    is shuffled; texts of a form are compared once each, and rows come in only to be listed."""
    k = written(rows.where("id is not null").select(F.unhex(F.md5("form")).alias("f"), F.xxhash64("text").alias("x"), "id"))
    several = k.groupBy("f").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).where("lo <> hi").select("f")
    own = k.join(several, "f").distinct()
    texts = own.select("f", "x").distinct()
    pairs = texts.withColumnRenamed("x", "xa").join(texts.withColumnRenamed("x", "xb"), "f").where("xa < xb")
    a, b = own.select("f", F.col("x").alias("xa"), F.col("id").alias("ia")), own.select("f", F.col("x").alias("xb"), F.col("id").alias("ib"))
    both = pairs.join(a, ["f", "xa"]).join(b, ["f", "xb"]).where("ia <> ib")
    return both.select(F.least("ia", "ib").alias("row_a"), F.greatest("ia", "ib").alias("row_b")).distinct()
