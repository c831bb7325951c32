"""Freely typed values mapped to the entries of a reference list: a trie of the entries, searched with a Levenshtein automaton."""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import written

#: Characters of reference entries in one trie, which then takes about 40 bytes for each of them in every worker; a longer list is cut into
#: blocks that are searched one after the other.
MAX_LIST_CHARS = 2_000_000
#: Length, of the value or the entry, from which on so many slips are allowed. A slip is a letter too many, missing, wrong, or two changed places.
SLIPS = ((15, 3), (6, 2), (4, 1))

# What may stand around a value. Namespaces before it, multiplicities behind it, commands of typesetting around it.
_MULTIPLICITY = re.compile(r"[\s\[(]*(?:\d+\s*\.\.\s*(?:\d+|\*|n)|\*)[\s\])]*$")
_COMMAND = re.compile(r"\\[A-Za-z]+\s*\{([^{}]*)\}")
_NAMESPACE = re.compile(r"^(?:urn:[^#\s]*#|[A-Za-z][A-Za-z0-9]*\s*::|[A-Za-z][A-Za-z0-9]*:(?!:))(?=.)", re.S)
_PACKAGE = re.compile(r"^[A-Z][A-Za-z0-9]*\.(?=[A-Z][A-Za-z0-9]*$)")
_XSD = re.compile(r"^xsd(?:[\s:_\-.]+)(?=.)", re.I)


def bare(s: str) -> str:
    """Letters and digits of the compatibility form, without letter case."""
    return "".join(c for c in unicodedata.normalize("NFKC", s).casefold() if c.isalnum())


def readings(value: str) -> list[str]:
    """Bare forms a value may be read as, the fullest first: as it stands, without what stands around it, without a namespace."""
    out = [value]
    s = value
    while (t := _COMMAND.sub(r"\1", s)) != s:
        s = t
    s = s.replace("$", " ").replace("\\_", "_").strip()
    s = _MULTIPLICITY.sub("", s).strip()
    out.append(s)
    for cut in (_NAMESPACE, _XSD, _PACKAGE):
        if (t := cut.sub("", s)) != s:
            out.append(t.lstrip(":"))
    return list(dict.fromkeys(x for x in map(bare, out) if x))


def slips(n: int) -> int:
    """Slips allowed where the longer of value and entry has n letters and digits."""
    return next((k for least, k in SLIPS if n >= least), 0)


class Trie:
    """Bare forms of entries, label and alias paths alike, with single ways drawn together: a node is (edges by first letter, entries that end
    here), an edge (letters, node)."""

    def __init__(self, entries: list[tuple[int, str]]):
        self.forms: dict[str, set[int]] = {}
        for entry, text in entries:
            for form in readings(text):
                self.forms.setdefault(form, set()).add(entry)
        self.root: tuple[dict, tuple[int, ...]] = ({}, ())
        todo = [(sorted(self.forms), 0, self.root)]
        while todo:
            own, at, node = todo.pop()  # sorted forms with their first letters in common
            rest = own[1:] if own and len(own[0]) == at else own
            k = 0
            while k < len(rest):
                c, end = rest[k][at], k + 1
                while end < len(rest) and rest[end][at] == c:
                    end += 1
                a, b, same = rest[k], rest[end - 1], at + 1
                while same < min(len(a), len(b)) and a[same] == b[same]:
                    same += 1
                below = ({}, tuple(sorted(self.forms[a])) if len(a) == same else ())
                node[0][c] = (a[at:same], below)
                todo.append((rest[k:end], same, below))
                k = end

    def search(self, form: str, most: int) -> dict[int, int]:
        """All entries within ``most`` slips of ``form``, and within what their length allows, each with its least distance.

        The automaton's states are bit sets of places in ``form``, one set for each number of slips so far; a branch of the trie is left
        as soon as no state is alive.
        """
        m, end = len(form), 1 << len(form)
        full = (end << 1) - 1
        at: dict[str, int] = {}
        for k, c in enumerate(form):
            at[c] = at.get(c, 0) | 1 << k
        first = [((1 << (k + 1)) - 1) & full for k in range(most + 1)]  # letters of the value that the entry lacks
        found: dict[int, int] = {}
        stack = [(self.root, first, [0] * (most + 1), 0)]
        while stack:
            (edges, entries), states, swapped, depth = stack.pop()
            if entries:
                for k, s in enumerate(states[: slips(max(m, depth)) + 1]):
                    if s & end:
                        for e in entries:
                            found[e] = min(k, found.get(e, k))
                        break
            for letters, child in edges.values():
                now, half = states, swapped
                for c in letters:
                    here = at.get(c, 0)
                    new, next_, alive = [], [0] * (most + 1), 0
                    for k in range(most + 1):
                        x = (now[k] & here) << 1
                        if k:
                            x |= (now[k - 1] << 1) | now[k - 1] | (new[k - 1] << 1) | (half[k] & here) << 2
                            next_[k] = now[k - 1] & (here >> 1)
                        x &= full
                        new.append(x)
                        alive |= x | next_[k]
                    now, half = new, next_
                    if not alive:
                        break
                if alive:
                    stack.append((child, now, half, depth + len(letters)))
        return found

    def candidates(self, value: str) -> list[tuple[int, int, int]]:
        """(slips, number of the reading, entry) of every entry that a reading of ``value`` is within the slips its length allows, the nearest first;
        of several readings that reach an entry the nearest counts. One search a reading."""
        best: dict[int, tuple[int, int]] = {}
        for k, form in enumerate(readings(value)):
            for entry, d in self.search(form, slips(len(form) + 1)).items():
                best[entry] = min((d, k), best.get(entry, (d, k)))
        return sorted((d, k, entry) for entry, (d, k) in best.items())

    def nearest(self, value: str) -> int:
        """The entry ``value`` is, or 0: of all readings the one with the fewest slips counts, and among its entries the nearest, which must be
        the only one."""
        for form in readings(value):  # written as an entry is: nothing to search
            if exact := self.forms.get(form):
                return next(iter(exact)) if len(exact) == 1 else 0
        return chosen(self.candidates(value))


def chosen(candidates: list[tuple[int, int, int]]) -> int:
    """The entry of the only nearest candidate, or 0."""
    return candidates[0][2] if candidates and (len(candidates) == 1 or candidates[1][:2] != candidates[0][:2]) else 0


_tries: dict[str, dict[str, Trie]] = {}
_CANDIDATE = "array<struct<slips:int,reading:int,canon_id:bigint>>"


def _searched(distinct: DataFrame, entries: DataFrame, every: bool) -> DataFrame:
    """(list_name, value, found) of the distinct values: with ``every`` all candidates, else those that decide. ``entries`` fit in one trie."""
    lists: dict[str, list[tuple[int, str]]] = {}
    for r in entries.collect():  # one block
        lists.setdefault(r.list_name, []).append((r.canon_id, r.text))
    sent, name = distinct.sparkSession.sparkContext.broadcast(lists), uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _tries:  # built once a worker
            _tries.clear()
            _tries[name] = {k: Trie(v) for k, v in sent.value.items()}
        tries = _tries[name]
        kind = pa.list_(pa.struct([("slips", pa.int32()), ("reading", pa.int32()), ("canon_id", pa.int64())]))
        for batch in batches:
            found = []
            for n, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n not in tries:
                    own = []
                elif every:
                    own = tries[n].candidates(t)
                else:
                    own = next(([(0, k, e) for e in sorted(tries[n].forms[f])] for k, f in enumerate(readings(t)) if f in tries[n].forms), None)
                    own = tries[n].candidates(t) if own is None else own
                found.append([dict(zip(("slips", "reading", "canon_id"), c)) for c in own])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)], names=["list_name", "value", "found"])

    # the work is in the values, not in their bytes: a shuffle that is not coalesced, nor left out as a repetition of that of ``distinct``
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return distinct.repartition(n, F.xxhash64("list_name", "value")).mapInArrow(scan, f"list_name string, value string, found {_CANDIDATE}")


def found(values: DataFrame, entries: DataFrame, every: bool = True) -> DataFrame:
    """(list_name, value, found) of every distinct (list_name, value): the entries of its list within the slips its length allows, the nearest
    first. Entries beyond ``MAX_LIST_CHARS`` go to further tries, whose candidates are put together."""
    own = entries.select("list_name", F.col("canon_id").cast("bigint").alias("canon_id"), F.explode(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("text"))
    own = own.where("text is not null and canon_id is not null and list_name is not null").distinct()
    blocks = max(1, -(-own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // MAX_LIST_CHARS))
    distinct = values.select(F.col("list_name").cast("string"), F.col("value").cast("string")).where("list_name is not null and value is not null").distinct()
    if blocks == 1:
        return _searched(distinct, own, every)
    distinct = written(distinct)
    parts = [_searched(distinct, own.where(F.pmod(F.xxhash64("canon_id"), F.lit(blocks)) == k), every) for k in range(blocks)]
    return reduce(DataFrame.unionByName, parts).groupBy("list_name", "value").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))


def mapped(values: DataFrame, entries: DataFrame) -> DataFrame:
    """(list_name, value, canon_id) of every distinct (list_name, value): the entry of its list that it is, or 0.

    Values come down to the distinct ones before any is searched. Null values and null lists have no row; an empty value, or one without a
    letter or digit, is none of the entries. Entries with a null id, list or label take no part except by their aliases; null aliases are
    skipped. If two entries are equally near, the value is none of them. An empty list maps everything to 0.
    """
    x = found(values, entries, every=False)
    first, second = F.get("found", F.lit(0)), F.get("found", F.lit(1))
    one = second.isNull() | (second["slips"] != first["slips"]) | (second["reading"] != first["reading"])
    return x.select("list_name", "value", F.coalesce(F.when(one, first["canon_id"]), F.lit(0).cast("bigint")).alias("canon_id"))


def assigned(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """(source_field, row_key, pos, canon_id) of every row (source_field, list_name, row_key, pos, value) whose value is not literally a label
    of its list, 0 standing for none. The labels are few (see ``mapped``); the values join back on themselves, hot ones split by AQE."""
    labels = entries.where("label is not null").select("list_name", F.col("label").alias("value")).distinct()
    free = rows.where("value is not null").join(F.broadcast(labels), ["list_name", "value"], "left_anti")
    return free.join(mapped(free.select("list_name", "value"), entries), ["list_name", "value"]).select("source_field", "row_key", "pos", "canon_id").distinct()
