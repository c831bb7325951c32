"""Long stretches of text that stand verbatim in more than one document.

Sliding sentence spans: at sentence starts, thinned, a run of consecutive sentences that holds ``span`` characters is hashed, and the hashes
are joined globally. What the texts of one span share around it is found in place, from the characters beside it, so that no text is compared
with another and work is in proportion to the text: pairs are made only where they are asked for.

A sentence starts after a line break or after a closing sign and a space. Every place has a hash of the few characters around it, and
sentence starts rank before all other places; of every ``reach`` consecutive places the one of least rank is kept. So of short sentences most
starts begin no span, and where no sentence starts for ``reach`` characters, another place does. No stretch is missed by this: what is kept in
a window depends on the characters of the window and 3 beside it only, so that a stretch of ``length`` characters keeps the same place in each
document, within its first ``reach`` + 4 characters, and the ``span`` characters from there on lie inside, as span = length - reach - 8.

A window of ``length`` characters that holds a span begins up to ``length - span`` characters before it, so that this many characters on either
side tell which windows two texts have in common there: those whose characters before and behind the span are equal, which prefix hashes
of both sides say for all of them. Windows of one group of texts make a class; equal groups are one class, wherever they come from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..frames import written

BLOCK_CHARS = 1_500_000
_ODD = 0x9E3779B97F4A7C15
_AROUND = 4


@dataclass(frozen=True)
class Settings:
    """length: characters of a stretch that counts; reach: largest distance of two sentence starts;
    hot: a span that stands at more places than this is never gathered in one task: its windows are counted by shuffles."""

    length: int = 400
    reach: int = 150
    hot: int = 2000

    @property
    def span(self) -> int:
        if self.length - self.reach - 2 * _AROUND < self.reach:
            raise ValueError("length must be at least 2 * reach + 8")
        return self.length - self.reach - 2 * _AROUND

    @property
    def side(self) -> int:
        """Characters on either side of a span that its windows reach to."""
        return self.length - self.span


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts in a row, and where each begins, with the end as last entry."""
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=begin[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), begin


class Rolling:
    """Hashes of windows of any length, from prefix sums of a polynomial modulo 2**64."""

    power = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, codes: np.ndarray):
        n = len(codes) + 1
        if len(Rolling.power) < n:
            size = max(n, 2 * BLOCK_CHARS)
            for name, base in (("power", _ODD), ("inverse", pow(_ODD, -1, 2**64))):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(Rolling, name, np.cumprod(x))
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(mixed * Rolling.power[: n - 1], out=self.sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        h = (self.sums[starts + length] - self.sums[starts]) * Rolling.inverse[starts]
        h ^= h >> np.uint64(31)
        return h * np.uint64(0xBF58476D1CE4E5B9)


def sentence_starts(codes: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where a sentence starts, at most ``reach`` characters apart, and of each the first and last of the ``reach`` consecutive places (by where
    they begin) that it has the least rank of."""
    n = len(codes)
    if n < reach:
        return (np.zeros(0, np.int64),) * 3
    small = codes.astype(np.uint32)
    h = small * np.uint32(0x85EBCA6B)
    for k in range(1, _AROUND):  # the characters before and from the place on
        h[:-k] += small[k:] * np.uint32(0xC2B2AE35 + 2 * k)
        h[k:] += small[:-k] * np.uint32(0x27D4EB2F + 2 * k)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    rank = (h >> np.uint32(1)) | np.uint32(1 << 31)
    line = small == 10
    close = (small == 46) | (small == 33) | (small == 63) | (small == 59) | (small == 0x3002) | (small == 0xFF01) | (small == 0xFF1F)
    natural = np.zeros(n, np.bool_)
    natural[1:] = line[:-1]
    natural[2:] |= close[:-2] & (small[1:-1] == 32)
    natural &= ~line
    rank[natural] &= np.uint32((1 << 31) - 1)
    key = (rank.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    least, width = key, 1
    while width * 2 <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    change = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    places = (np.uint64(0xFFFFFFFF) - (least[change] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    return places, change, np.append(change[1:], len(least)) - 1


def span_hashes(texts: list[str], s: Settings) -> tuple[np.ndarray, ...]:
    """Number of the text, place in it and hash of every span, and how far before it, at least and at most, the windows begin that are its own: those
    of the text whose least place it is. Each window is that of one span, which every text with the window has."""
    codes, begin = codes_of(texts)
    starts, first, last = sentence_starts(codes, s.reach)
    doc = np.searchsorted(begin, starts, side="right") - 1
    least = np.maximum(starts + s.length - begin[doc + 1], starts - last + _AROUND - 1).clip(min=0)
    most = np.minimum(np.minimum(starts - begin[doc], starts - first + _AROUND - 1), s.side)
    kept = least <= most
    starts, doc = starts[kept], doc[kept]
    return doc, starts - begin[doc], Rolling(codes).at(starts, s.span).view(np.int64), least[kept], most[kept]


def blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BLOCK_CHARS``; a longer text is a range of its own."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > BLOCK_CHARS:
            yield first, k
            first, size = k, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, sorted."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
    return a[new], b[new]


def spans(texts: DataFrame, s: Settings) -> DataFrame:
    """(h, t, salt) of every sentence span of (t, text). Of a span that many texts of a block have, two rows have salt 0 and tell the others by the
    shuffle; the rest, which are known to be shared already, are salted, so that no hot span meets in one task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            for lo, hi in blocks(own):
                doc, _, h, _, _ = span_hashes(own[lo:hi], s)
                h, t = _distinct(h, ids[lo:hi][doc])
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
                place = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
                salt = np.where(place < 2, 0, 1 + (t & 1023)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(t), pa.array(salt)], names=["h", "t", "salt"])

    return texts.mapInArrow(scan, "h bigint, t bigint, salt int")


def shared(found: DataFrame) -> DataFrame:
    """(h, t) of the spans that several texts have; rows may repeat."""
    w = Window.partitionBy("h", "salt")
    x = found.withColumn("lo", F.min("t").over(w)).withColumn("hi", F.max("t").over(w))
    return x.where("lo <> hi or salt > 0").select("h", "t")


PLACES = "h bigint, t bigint, first bigint, `left` string, `right` string, lo int, hi int, at array<bigint>"


def places(texts: DataFrame, s: Settings) -> DataFrame:
    """Of every marked span of (t, first, hs, text): the characters on either side, the windows that are its own (they begin ``lo`` to ``hi`` characters
    before the span), and where it stands. Places of one text that look alike are one row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ts, firsts, marks, own = (c.to_pylist() for c in batch.columns)
            for lo, hi in blocks(own):
                doc, at, h, least, most = span_hashes(own[lo:hi], s)
                wanted = np.unique(np.concatenate([np.array(m, np.int64) for m in marks[lo:hi]]))
                kept = np.isin(h, wanted)
                rows: dict[tuple, list[int]] = {}
                for d, p, x, a, b in zip((doc[kept] + lo).tolist(), *(v[kept].tolist() for v in (at, h, least, most))):
                    text, end = own[d], p + s.span
                    rows.setdefault((x, ts[d], firsts[d], text[max(0, p - b) : p], text[end : end + s.side - a], a, b), []).append(p)
                cols = list(zip(*rows)) or [[]] * 7
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32())
                arrays = [pa.array(c, k) for c, k in zip(cols, kinds)] + [pa.array(list(rows.values()), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["h", "t", "first", "left", "right", "lo", "hi", "at"])

    return texts.mapInArrow(scan, PLACES)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, left: list[str], right: list[str], side: int) -> np.ndarray:
    """Hash of every window around the spans ``h``: row by place, column by how many characters before the span the window begins. Where the
    text has no room, the value means nothing."""

    def prefix(texts: list[str], power: np.ndarray) -> np.ndarray:
        codes, begin = codes_of(texts)
        n = np.diff(begin)
        grid = np.zeros((len(texts), side), np.uint64)
        row = np.repeat(np.arange(len(texts)), n)
        grid[row, np.arange(len(codes)) - np.repeat(begin[:-1], n)] = codes.astype(np.uint64) + np.uint64(1)
        sums = np.zeros((len(texts), side + 1), np.uint64)
        np.cumsum(_mixed(grid) * power, axis=1, out=sums[:, 1:])
        return sums

    power = np.cumprod(np.full(side, _ODD, np.uint64))
    before, after = prefix([x[::-1] for x in left], power), prefix(right, power)
    return _mixed(_mixed(before) + after[:, ::-1] * np.uint64(0x9FB21C651E98DF25) + _mixed(h.view(np.uint64))[:, None])


#: What is found, by kind: 0 a part of t from ``a`` to ``b`` that another text has, 1 one that a text of smaller ``first`` has, 2 t is of class ``a``.
FOUND = "kind int, t bigint, a bigint, b bigint"


def resolved(rows: DataFrame, s: Settings) -> DataFrame:
    """``FOUND`` of the spans of ``rows``, whose places come together, span by span."""

    def resolve(h, t, first, left, right, lo, hi, at) -> pa.RecordBatch:
        n = len(h)
        w = window_hashes(h, left, right, s.side)
        ends = {kind: (np.full(n, s.side + 1), np.full(n, -1)) for kind in (0, 1)}
        mark = _mixed(t.view(np.uint64))
        classes: list[np.ndarray] = []
        for o in range(s.side + 1):
            own = np.flatnonzero((lo <= o) & (o <= hi))
            own = own[np.lexsort((t[own], w[own, o]))]
            key, who = w[own, o], t[own]
            new = np.append(True, key[1:] != key[:-1]) if len(own) else np.zeros(0, bool)
            start = np.flatnonzero(new)
            if len(start) in (0, len(own)):
                continue
            group = np.cumsum(new) - 1
            other = new | np.append(True, who[1:] != who[:-1])
            several = np.add.reduceat(other, start) > 1
            earliest = np.minimum.reduceat(first[own], start)
            kept = several[group]
            for kind, of in ((0, kept), (1, kept & (first[own] > earliest[group]))):
                i = own[of]
                np.minimum.at(ends[kind][0], i, o)
                np.maximum.at(ends[kind][1], i, o)
            sums = [np.add.reduceat(np.where(other, x, np.uint64(0)), start) for x in (mark[own], _mixed(mark[own] + np.uint64(_ODD)))]
            label = _mixed(sums[0] + _mixed(sums[1]))
            one = kept & other
            classes.append(np.stack([who[one], label[group[one]].view(np.int64)]))
        out = [np.zeros((4, 0), np.int64)]
        for kind, (least, most) in ends.items():
            i = np.flatnonzero(most >= 0)
            size = np.array([len(at[k]) for k in i], np.int64)
            i, p = np.repeat(i, size), np.array([p for k in i for p in at[k]], np.int64)
            out.append(np.stack([np.full(len(i), kind), t[i], p - most[i], p - least[i] + s.length]))
        if classes:
            label, who = _distinct(*np.concatenate(classes, axis=1)[::-1])
            out.append(np.stack([np.full(len(who), 2), who, label, np.zeros(len(who), np.int64)]))
        x = np.concatenate(out, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(x[0].astype(np.int32)), *map(pa.array, x[1:])], names=["kind", "t", "a", "b"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def run(rows: pa.Table) -> pa.RecordBatch:
            h, t, first, left, right, lo, hi, at = (rows.column(k) for k in range(8))
            return resolve(*(np.array(c) for c in (h, t, first)), left.to_pylist(), right.to_pylist(), *(np.array(c) for c in (lo, hi)), at.to_pylist())

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 8192:
                rows = pa.Table.from_batches(held)
                h = np.array(rows.column(0))
                change = np.flatnonzero(h[1:] != h[:-1])
                if len(change):  # the last span may go on in the next batch
                    yield run(rows.slice(0, change[-1] + 1))
                    held = rows.slice(change[-1] + 1).to_batches()
        if held and (rows := pa.Table.from_batches(held)).num_rows:
            yield run(rows)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the work is in the rows, not in their bytes: not to be coalesced
    return rows.repartition(n, "h").sortWithinPartitions("h").mapInArrow(scan, FOUND)


def counted(rows: DataFrame, s: Settings) -> DataFrame:
    """``FOUND`` of hot spans, without gathering one. Places with the same characters on both sides have all windows in common and are one context,
    which sends its windows once, whatever the number of its texts; what a window's contexts have in common comes back to the context."""
    context = F.xxhash64("h", "left", "right", "lo", "hi").alias("c")
    members = written(rows.select(context, "t", "first", "at", "h", "left", "right", "lo", "hi"))
    mark = [F.xxhash64("t", F.lit(k)).cast("decimal(38,0)") for k in (1, 2)]
    one = members.groupBy("c").agg(*[F.first(x).alias(x) for x in ("h", "left", "right", "lo", "hi")], F.min("first").alias("own"), F.max("first").alias("last"), *[F.sum(m).alias(f"s{k}") for k, m in enumerate(mark)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                w = window_hashes(np.array(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist(), s.side).view(np.int64)
                o = np.arange(s.side + 1)[None, :]
                i, o = np.nonzero((np.array(b.column(4))[:, None] <= o) & (o <= np.array(b.column(5))[:, None]))
                yield pa.RecordBatch.from_arrays([pa.array(w[i, o]), b.column(0).take(pa.array(i)), pa.array(o.astype(np.int32))], names=["w", "c", "o"])

    one = written(one)
    windows = written(one.select("c", "h", "left", "right", "lo", "hi").mapInArrow(scan, "w bigint, c bigint, o int"))
    told = windows.join(one.select("c", "own", "last", "s0", "s1"), "c")
    several = told.groupBy("w").agg(F.min("own").alias("earliest"), F.max("last").alias("latest"), F.xxhash64(F.sum("s0").cast("string"), F.sum("s1").cast("string")).alias("label")).where("earliest <> latest")
    known = written(windows.join(several.select("w", "earliest", "label"), "w"))
    ends = known.join(one.select("c", "own"), "c").groupBy("c", "own").agg(F.min("o").alias("lo"), F.max("o").alias("hi"), *[f(F.when(F.col("earliest") < F.col("own"), F.col("o"))).alias(n) for n, f in (("later_lo", F.min), ("later_hi", F.max))])
    x = members.select("c", "t", "first", F.explode("at").alias("p")).join(ends, "c")
    later = F.col("first") > F.col("own")
    part = lambda kind, lo, hi: x.select(F.lit(kind).alias("kind"), "t", (F.col("p") - hi).alias("a"), (F.col("p") - lo + s.length).alias("b"))
    pick = lambda n: F.when(later, F.col(n)).otherwise(F.col(f"later_{n}"))
    classes = known.select("c", "label").distinct().join(members.select("c", "t"), "c").select(F.lit(2).alias("kind"), "t", F.col("label").alias("a"), F.lit(0).cast("bigint").alias("b")).distinct()
    return part(0, F.col("lo"), F.col("hi")).unionByName(part(1, pick("lo"), pick("hi")).where("a is not null")).unionByName(classes)


#: Most bits of a sieve: 16 MB, which go to every executor. Of many more ids than bits it lets nearly all rows pass.
MOST_BITS = 1 << 27
_WORD = 1 << 15


def sieved(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of ``rows`` but for most of those whose ``key`` is not in ``ids``: a bit of its hash says so. It spares the shuffle of texts that a join
    on the key would drop, and never drops one that it keeps."""
    n = ids.count()
    bits = min(MOST_BITS, max(_WORD, 1 << (16 * n).bit_length()))
    bit = F.pmod(F.xxhash64(key), F.lit(bits))
    word, at = F.floor(bit / _WORD).cast("int"), F.pmod(bit, F.lit(_WORD)).cast("int")
    words = ids.select(word.alias("_word"), at.alias("_at")).groupBy("_word").agg(F.bitmap_construct_agg("_at").alias("_bits"))  # at most MOST_BITS / 8 bytes
    byte = F.conv(F.hex(F.substr("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    x = rows.withColumn("_word", word).join(F.broadcast(words), "_word").where(F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2 == 1)
    return x.drop("_word", "_bits")


class SharedSpans:
    """The operator: what each text shares, the classes of texts that share a window, and what follows from both.

    Null texts and null ids take part in nothing; texts shorter than ``length`` share nothing. Repeated rows of one id count once (by text).
    Rows with equal text are one text with several members. Other columns of ``documents`` are not read.
    """

    def __init__(self, documents: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text"):
        self.s = settings
        self.documents = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null and text is not null")
        self.texts = self.documents.where(F.length("text") >= settings.length).withColumn("t", self._name(F.col("text")))
        self.members = written(self.texts.select("t", "doc_id").distinct())

    @staticmethod
    def _name(text: Column) -> Column:
        return F.xxhash64(text, F.length(text))

    @cached_property
    def found(self) -> DataFrame:
        """``FOUND`` of all texts, written once."""
        s = self.s
        marked = shared(spans(self.texts.select("t", "text"), s)).groupBy("t").agg(F.collect_set("h").alias("hs"))
        first = self.members.groupBy("t").agg(F.min("doc_id").alias("first"))
        wanted = marked.join(first, "t")
        wanted = written(wanted)
        some = sieved(self.documents, "doc_id", wanted.select(F.col("first").alias("doc_id")))
        texts = wanted.join(some, F.col("first") == F.col("doc_id")).where(self._name(F.col("text")) == F.col("t"))
        rows = written(places(texts.select("t", "first", "hs", "text"), s))
        hot = rows.groupBy("h").count().where(F.col("count") > s.hot).select("h")
        if not hot.limit(1).count():
            return written(resolved(rows, s), "kind")
        hot = written(hot)
        return written(resolved(rows.join(hot, "h", "left_anti").select(*rows.columns), s).unionByName(counted(rows.join(hot, "h", "left_semi").select(*rows.columns), s)), "kind")

    def _parts(self, kind: int) -> DataFrame:
        return self.found.where(F.col("kind") == kind).select("t", F.col("a").alias("from"), F.col("b").alias("to"))

    @cached_property
    def memberships(self) -> DataFrame:
        """(label, t) of the classes: the groups of several distinct texts that have a window in common."""
        return self.found.where("kind = 2").select(F.col("a").alias("label"), "t").distinct()

    def _copies(self) -> DataFrame:
        """(t, doc_id) of the texts that several documents have."""
        return self.members.join(self.members.groupBy("t").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("t"), "t").select("t", "doc_id")

    def classes(self) -> DataFrame:
        """(first_id, n_docs, doc_id): the distinct groups of documents that have a window in common or the whole text, each with its smallest
        document, their number, and one row a member; groups alike in both are listed as one. Every link lies in one of them."""
        m = self.memberships.join(self.members, "t").select("label", "doc_id").unionByName(self._copies().select(F.col("t").alias("label"), "doc_id")).distinct()
        size = m.groupBy("label").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_docs"))
        return m.join(size, "label").select("first_id", "n_docs", "doc_id").distinct()

    def pairs(self) -> DataFrame:
        """Distinct (doc_a, doc_b), doc_a < doc_b, with a stretch in common."""
        own = self.memberships
        texts = own.select("label", F.col("t").alias("ta")).join(own.select("label", F.col("t").alias("tb")), "label").where("ta < tb").select("ta", "tb").distinct()
        m = self.members
        a, b = m.select(F.col("t").alias("ta"), F.col("doc_id").alias("a")), m.select(F.col("t").alias("tb"), F.col("doc_id").alias("b"))
        unequal = texts.join(a, "ta").join(b, "tb").select("a", "b")
        several = self._copies()
        equal = several.select("t", F.col("doc_id").alias("a")).join(several.select("t", F.col("doc_id").alias("b")), "t").where("a < b").select("a", "b")
        both = unequal.union(equal).where("a <> b")
        return both.select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).distinct()

    def share(self) -> DataFrame:
        """(doc_id, n_chars, shared_chars, share) of every document with a text: how much of it stands in others too."""
        x = self._parts(0).groupBy("t", "from").agg(F.max("to").alias("to"))
        w = Window.partitionBy("t").orderBy("from", "to")
        x = x.withColumn("seen", F.coalesce(F.max("to").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        part = x.groupBy("t").agg(F.sum(F.greatest(F.lit(0), F.col("to") - F.greatest("from", "seen"))).alias("part"))
        size = self.members.groupBy("t").agg(F.count("*").alias("n"))
        own = self.members.join(size, "t").join(part, "t", "left")
        docs = self.documents.groupBy("doc_id").agg(F.max(F.length("text")).cast("bigint").alias("n_chars"))
        y = docs.join(own.select("doc_id", "n", "part").groupBy("doc_id").agg(F.max("n").alias("n"), F.max("part").alias("part")), "doc_id", "left")
        chars = F.when(F.col("n") > 1, F.col("n_chars")).otherwise(F.coalesce("part", F.lit(0))).cast("bigint")
        return y.select("doc_id", "n_chars", chars.alias("shared_chars"), F.when(F.col("n_chars") > 0, chars / F.col("n_chars")).otherwise(F.lit(0.0)).alias("share"))

    def kept(self) -> DataFrame:
        """(doc_id, text) of every document without the sentences that lie wholly in a stretch which a document of smaller id has too.
        A copy of such a document keeps an empty text."""
        rep = self.members.groupBy("t").agg(F.min("doc_id").alias("first"))
        parts = self._parts(1).groupBy("t").agg(F.collect_set(F.struct("from", "to")).alias("parts"))
        of = self.members.join(rep, "t").join(parts, "t", "left").select("doc_id", (F.col("doc_id") > F.col("first")).alias("copy"), "parts")
        of = of.groupBy("doc_id").agg(F.max("copy").alias("copy"), F.flatten(F.collect_list("parts")).alias("parts"))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, texts, copies, parts = (c.to_pylist() for c in batch.columns)
                out = ["" if copy else without(text, [(p["from"], p["to"]) for p in own or []]) for text, copy, own in zip(texts, copies, parts)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], names=["doc_id", "text"])

        return self.documents.join(of, "doc_id", "left").select("doc_id", "text", "copy", "parts").mapInArrow(scan, "doc_id bigint, text string")


def without(text: str, parts: list[tuple[int, int]]) -> str:
    """``text`` without the sentences that lie wholly in one of ``parts``."""
    if not parts:
        return text
    ends, merged = [m.end() for m in re.finditer(r"\n+|[.!?;\u3002\uff01\uff1f] ", text)], []
    for lo, hi in sorted(parts):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(hi, merged[-1][1])
        else:
            merged.append([lo, hi])
    out, at, k = [], 0, 0
    for end in [*ends, len(text)]:
        while k < len(merged) and merged[k][1] < end:
            k += 1
        if k == len(merged) or merged[k][0] > at:
            out.append(text[at:end])
        at = end
    return "".join(out)
