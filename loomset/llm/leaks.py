"""Evaluation passages inside training documents, by q-gram lemma filtering and banded alignment.

The q-gram index of the items goes to every task; the documents are scanned in one pass without a shuffle. Items of more than
``MAX_ITEM_CHARS`` characters in all are cut into blocks, each with an index and a pass of its own, so that an index has a bound however many
items there are. Every stage is vectorised over all documents of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of items in one index, which then takes about 24 bytes for each of them; what is beyond goes to further blocks.
MAX_ITEM_CHARS = 4_000_000
#: Places of shared q-grams that are put together at a time; more are taken in slices of documents, then of items.
MOST_PLACES = 4_000_000
#: Characters scanned at a time; longer texts are scanned whole, as a block of their own.
BLOCK_CHARS = 1_500_000
SPACE = 32
_STEP = 0x9E3779B97F4A7C15
SCHEMA = "item_id bigint, doc_id bigint, words int, near_words int, doc_from bigint, doc_to bigint"


@dataclass(frozen=True)
class Settings:
    """q: characters of a q-gram; step: every step-th q-gram of an item is indexed; edits: the edit budget of a passage, in characters;
    band: width of a diagonal band, each band overlapping the next by half; words: least number of consecutive words."""

    q: int = 12
    step: int = 4
    edits: int = 1
    band: int = 16
    words: int = 13


def normal(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The words of the texts in lower case, each followed by one space and each text led by one, as code points, and where each text
    begins (with the end as last entry). A backslash with letters is dropped, whatever else is neither letter nor digit parts words."""
    joined = "\n".join(t or "" for t in texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t or "") + 1 for t in texts], out=starts[1:])
    if codes.max(initial=0) < 128:
        kind, lower = _ASCII
    else:
        top = int(codes.max()) + 1
        kind, lower = np.zeros(top, np.uint8), np.arange(top, dtype=np.uint32)
        for c in np.unique(codes):
            ch = chr(c)
            kind[c] = 2 if ch.isalpha() else 1 if ch.isalnum() else 0
            if len(ch.lower()) == 1:
                lower[c] = ord(ch.lower())
    of = kind[codes]
    word = of > 0
    slash = np.flatnonzero(codes == 92)
    slash = slash[of[slash + 1] == 2]
    if len(slash):  # the letters after a backslash are its command
        ends = np.flatnonzero(of != 2)
        last = ends[np.searchsorted(ends, slash + 1)]
        change = np.zeros(len(codes) + 1, np.int32)
        np.add.at(change, slash, 1)
        np.add.at(change, last, -1)
        word &= np.cumsum(change[:-1]) == 0
    after = np.zeros_like(word)
    after[1:] = word[:-1]
    keep = word | after
    keep[starts[1:-1] - 1] = True  # each text is led by one space: the separator before it stands for it
    out = np.where(word, lower[codes], SPACE).astype(np.uint32)
    keep[-1] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    out = np.concatenate([[np.uint32(SPACE)], out[keep]])
    begin = at[starts].copy()
    begin[-1] = len(out) - 1
    return out, begin


_codes = np.arange(128)
_ASCII = (
    np.array([2 if chr(c).isalpha() else 1 if chr(c).isalnum() else 0 for c in _codes], np.uint8),
    np.array([ord(chr(c).lower()) for c in _codes], np.uint32),
)


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, put together from those of powers of two."""
    n, parts, power, h, width = len(codes) - q + 1, [], _STEP, codes.astype(np.uint64) + np.uint64(1), 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    while True:
        if q & width:
            parts.append((width, h, power))
        if width * 2 > q:
            break
        h = h[:-width] * np.uint64(power) + h[width:]
        power, width = power * power % 2**64, width * 2
    total, at = np.zeros(n, np.uint64), 0
    for width, h, power in parts:
        total = total * np.uint64(power) + h[at : at + n]
        at += width
    return (total ^ (total >> np.uint64(29))) * np.uint64(_STEP)


class Index:
    """Sampled q-grams of the items, with all places they stand at."""

    def __init__(self, ids: list[int], texts: list[str | None], s: Settings):
        self.s, self.ids, self.codes = s, [], []
        hashes, where, place = [], [], []
        for i, t in zip(ids, texts):
            codes, _ = normal([t])
            spaces = np.flatnonzero(codes == SPACE)
            if len(spaces) <= s.words:
                continue
            shortest = int(self._windows(codes).min())
            if shortest < s.q + s.step - 1:
                raise ValueError(f"item {i}: {s.words} words of {shortest} characters may hold no sampled {s.q}-gram; take a smaller q or step")
            g = grams(codes, s.q)
            at = np.arange(0, len(g), s.step)
            k = len(self.ids)
            self.ids.append(i)
            self.codes.append(codes)
            hashes.append(g[at])
            where.append(np.full(len(at), k, np.int64))
            place.append(at)
        self.least = np.array([self._least(c) for c in self.codes], np.int64)
        self.room = np.array([self._windows(c).max() - s.q for c in self.codes], np.int64)
        h, w, p = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, where, place))
        order = np.argsort(h, kind="stable")
        self.item, self.at = w[order], p[order]
        self.hash, self.first = np.unique(h[order].astype(np.uint64), return_index=True)
        self.last = np.append(self.first[1:], len(h)) if len(h) else self.first
        self.order = np.repeat(np.arange(len(self.hash)), self.last - self.first) * len(self.ids) + self.item  # by q-gram, then by item
        bits = max(16, int(np.ceil(np.log2(len(self.hash) * 16 + 1))))
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, np.bool_)
        self.seen[(self.hash >> self.shift).astype(np.int64)] = True
        self.longest = max(map(len, self.codes), default=0)

    def _windows(self, codes: np.ndarray) -> np.ndarray:
        """Lengths of all passages of the least number of words, with the spaces around them."""
        spaces = np.flatnonzero(codes == SPACE)
        return spaces[self.s.words :] - spaces[: -self.s.words] + 1

    def _least(self, codes: np.ndarray) -> int:
        """By the q-gram lemma: how many sampled q-grams a passage of the least length keeps after all edits of the budget."""
        s = self.s
        return max(1, (int(self._windows(codes).min()) - s.q + 1) // s.step - s.edits * -(-s.q // s.step))

    def search(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """Of each text and item with a passage in common: text number, item number, words without an edit, words within the edit budget, and
        begin and end of the first in the normal form. One row for each text and item."""
        none = tuple(np.zeros(0, np.int64) for _ in range(6))
        codes, begin = normal(texts)
        g = grams(codes, self.s.q)
        if not len(g) or not len(self.hash):
            return none
        hits = np.flatnonzero(self.seen[(g >> self.shift).astype(np.int64)])
        k = np.searchsorted(self.hash, g[hits])
        k[k == len(self.hash)] = 0
        true = self.hash[k] == g[hits]
        hits, k = hits[true], k[true]
        if not len(hits):
            return none
        doc = np.searchsorted(begin, hits, side="right") - 1
        upto = np.cumsum(self.last[k] - self.first[k])
        found, a, last = [], 0, np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) + 1  # where the hits of a document end
        while a < len(hits):
            before = upto[a - 1] if a else 0
            fits = int(np.searchsorted(upto[last - 1], before + MOST_PLACES, side="right")) - 1
            b = int(last[max(fits, int(np.searchsorted(last, a, side="right")))])  # one document at least
            parts = max(1, min(len(self.ids), -(-int(upto[b - 1] - before) // MOST_PLACES)))
            ends = np.linspace(0, len(self.ids), parts + 1).astype(np.int64)
            for lo, hi in zip(ends[:-1], ends[1:]):
                if region := self._regions(hits[a:b], k[a:b], doc[a:b], len(texts), len(codes), lo, hi):
                    found.append(self.align(codes, begin, *region))
            a = b
        if not found:
            return none
        d, i, words, near, start, end = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((start, -near, -words, i, d))
        order = order[np.append(True, (np.diff(d[order]) != 0) | (np.diff(i[order]) != 0))[: len(order)]]
        return tuple(x[order] for x in (d, i, words, near, start, end))

    def _regions(self, hits: np.ndarray, k: np.ndarray, doc: np.ndarray, texts: int, size: int, lo: int, hi: int) -> tuple[np.ndarray, ...]:
        """Diagonal bands of the items from lo to hi that have enough hits within one passage: document, item, diagonal, and the columns of the
        item from the first to the last of these hits."""
        s = self.s
        first, last = (self.first[k], self.last[k]) if hi - lo == len(self.ids) else (np.searchsorted(self.order, k * len(self.ids) + x) for x in (lo, hi))
        n = last - first
        row = np.repeat(np.arange(len(hits)), n)
        entry = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]
        item, place = self.item[entry], self.at[entry]
        half = s.band // 2
        low = (hits[row] - place) // half  # a band holds two halves; every diagonal lies in two bands
        span = (size + 4 * s.band + self.longest) // half + 2
        off = self.longest // half + 2
        pair = (item * texts + doc[row]) * span + low + off
        key, at = np.concatenate([pair, pair - 1]), np.tile(place, 2)
        order = np.lexsort((at, key))
        key, at = key[order], at[order]
        need = self.least[key // span // texts]
        start = np.arange(len(key)) - need + 1  # this hit and the need - 1 before it must lie within one passage
        back = np.maximum(start, 0)
        kept = (start >= 0) & (key[back] == key) & (at - at[back] <= self.room[key // span // texts])
        key, from_, to = key[kept], at[back[kept]], at[kept] + s.q
        one = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        if not len(one):
            return ()
        from_, to, key = np.minimum.reduceat(from_, one), np.maximum.reduceat(to, one), key[one]
        return key // span % texts, key // span // texts, (key % span - off) * half, from_, to

    def align(self, codes: np.ndarray, begin: np.ndarray, doc: np.ndarray, item: np.ndarray, band: np.ndarray, from_: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, ...]:
        """Banded alignment of the regions, all at once, over the columns of the hits and the length of a passage on either side. For each number
        of edits up to the budget it keeps, on every diagonal, how many characters of the item before a column align with that many edits at
        most; where a word ends, this tells how many whole words do. A region stays if these are a passage."""
        s, found = self.s, []
        pad = self.room[item] + s.q
        size = np.array([len(c) for c in self.codes])[item]
        from_, to = np.maximum(0, from_ - pad), np.minimum(size, to + pad)
        by_length = np.argsort(to - from_, kind="stable")
        for lo in range(0, len(doc), 2048):
            part = by_length[lo : lo + 2048]
            d, i, b, left, n = doc[part], item[part], band[part], from_[part], (to - from_)[part]
            width = s.band + 2 * s.edits
            text = np.zeros((len(i), int(n.max())), np.uint32)
            for r, x in enumerate(i):
                text[r, : n[r]] = self.codes[x][left[r] : left[r] + n[r]]
            spaces = np.zeros((len(i), text.shape[1] + 1), np.int32)
            np.cumsum(text == SPACE, axis=1, out=spaces[:, 1:])
            at = (b + left)[:, None] - s.edits + np.arange(width)[None, :]
            first, last = begin[d][:, None], begin[d + 1][:, None]
            run = [np.zeros((len(i), width), np.int32) for _ in range(s.edits + 1)]
            words, near, end, length = (np.zeros(len(i), np.int64) for _ in range(4))
            for c in range(text.shape[1]):
                p = at + c
                inside = (p >= first) & (p <= last) & (c < n)[:, None]
                same = inside & (codes[np.clip(p, 0, len(codes) - 1)] == text[:, c][:, None])
                new = []
                for k in range(s.edits + 1):
                    x = np.where(same, run[k] + 1, 0)
                    if k:
                        x = np.maximum(x, np.where(inside, run[k - 1] + 1, 0))  # another character
                        x[:, :-1] = np.maximum(x[:, :-1], np.where(inside[:, :-1], run[k - 1][:, 1:] + 1, 0))  # one that the text lacks
                        x[:, 1:] = np.maximum(x[:, 1:], np.where(inside[:, 1:], new[k - 1][:, :-1], 0))  # one more in the text
                    new.append(np.minimum(x, c + 1))
                run = new
                r = np.flatnonzero((text[:, c] == SPACE) & (c < n))
                if len(r):
                    for k, most in ((0, words), (s.edits, near)):
                        m = run[k][r]
                        j = m.argmax(axis=1)
                        m = m[np.arange(len(r)), j]
                        w = spaces[r, c + 1] - spaces[r, c + 1 - m] - 1
                        better = w > most[r]
                        if k == 0:
                            end[r[better]], length[r[better]] = p[r, j][better], m[better]
                        most[r[better]] = w[better]
            kept = near >= s.words
            found.append(tuple(x[kept] for x in (d, i, words, near, end - length + 1 - begin[d], end + 1 - begin[d])))
        return tuple(np.concatenate(x) for x in zip(*found))


def leaked(documents: DataFrame, items: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents and items with a passage in common within the edit budget: item_id, doc_id, words (longest run of the item's words that stands
    in the document without an edit), near_words (the same within the budget, at least ``settings.words``), and where the former stands
    in the document's normal form.

    One row for each pair; a document or item with a null id or text, or with fewer words than asked, has none. Equal rows give equal results;
    an empty table on either side gives an empty result. Other columns are not read. ``edits=0`` asks for exact passages alone.
    """
    rows = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("x")).where("i is not null and x is not null").distinct()
    size = rows.agg(F.coalesce(F.sum(F.length("x")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // MAX_ITEM_CHARS))
    own = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    out = None
    for k in range(blocks):
        part = _searched(own, rows.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k), settings)
        out = part if out is None else out.unionByName(part)
    return out


def _searched(documents: DataFrame, items: DataFrame, settings: Settings) -> DataFrame:
    own = sorted(map(tuple, items.collect()))  # one block
    sent = documents.sparkSession.sparkContext.broadcast(Index([r[0] for r in own], [r[1] for r in own], settings))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        ids = np.array(index.ids, np.int64)
        for batch in batches:
            docs, texts, size, block = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0, 0
            for end in range(1, len(texts) + 1):
                size += len(texts[end - 1])
                if size < BLOCK_CHARS and end < len(texts):
                    continue
                doc, item, words, near, a, b = index.search(texts[block:end])
                if len(doc):
                    own = np.array(docs[block:end], np.int64)
                    cols = (ids[item], own[doc], words.astype(np.int32), near.astype(np.int32), a.astype(np.int64), b.astype(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["item_id", "doc_id", "words", "near_words", "doc_from", "doc_to"])
                block, size = end, 0

    return documents.mapInArrow(scan, SCHEMA)


def leaked_items(documents: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Distinct (item_id, doc_id) where at least ``settings.words`` consecutive words of the item stand in the document."""
    return leaked(documents, items, settings).where(F.col("words") >= settings.words).select("item_id", "doc_id").distinct()
