"""Copies that formatting hides: range-partition and sort canonical records, then scan adjacent runs comparing full keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import written

SCHEMA = "id bigint, head bigint, copies bigint, key string, run int"


def bare(c: Column) -> Column:
    """Letters, digits and joined marks only, in lower case."""
    return F.lower(F.regexp_replace(c.cast("string"), r"[^\p{L}\p{N}\p{M}]", ""))


def bare_entries(c: Column) -> Column:
    """The set of entries of a list set apart by ``;``, ``|`` or line breaks, each ``key=value`` or ``key:value``, in canonical order."""
    entries = F.transform(F.split(c.cast("string"), r"[;|\r\n]"), lambda e: F.concat(bare(F.regexp_extract(e, r"(?s)^([^=:]*)", 1)), F.lit("="), bare(F.regexp_extract(e, r"(?s)^[^=:]*[=:](.*)$", 1))))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(entries, lambda e: e != "="))), ";")


def canonical_key(plain: list[str], entry_lists: list[str]) -> Column:
    """One string from all fields; a null field differs from an empty one."""
    parts = [bare(F.col(c)) for c in plain] + [bare_entries(F.col(c)) for c in entry_lists]
    return F.concat_ws("\x1f", *[F.coalesce(p, F.lit("\x00")) for p in parts])


class Collapsed:
    """The operator over records with a canonical key: ``copies()`` and ``kept()``.

    The records are range-partitioned by (key, id), so that any number of copies of one record spreads over tasks, and sorted on disk
    where memory doesn't hold them. Each task scans its rows once. A run that goes on in the next partition is put together from its parts:
    at most two of them a partition, which alone are aggregated and broadcast.

    Rows with a null id count as copies but are not listed; a repeated id is listed once; an empty table has no runs; other columns are not
    read. Of equal records the smallest id is kept.
    """

    def __init__(self, records: DataFrame, id_col: str, key: Column):
        own = records.select(F.col(id_col).cast("bigint").alias("id"), key.alias("key"))
        order = [F.col("key").asc(), F.col("id").asc_nulls_last()]
        self.scan = written(own.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(adjacent_runs, SCHEMA))
        edges = self.scan.where("run = 2")  # two a partition at most
        edges = edges.groupBy("key").agg(F.min("head").alias("first"), F.collect_list(F.struct("head", "copies")).alias("parts")).where(F.size("parts") > 1)
        self.joined = edges.select(F.explode("parts").alias("p"), "first").select(F.col("p.head").alias("head"), "first").where("head is not null").distinct()

    def copies(self) -> DataFrame:
        """(keep_id, copy_id) of every record that is not kept."""
        x = self.scan.where("run = 0 and id is not null").join(F.broadcast(self.joined), "head", "left")
        return x.select(F.coalesce("first", "head").alias("keep_id"), F.col("id").alias("copy_id")).where("keep_id <> copy_id").distinct()

    def kept(self) -> DataFrame:
        """(keep_id, copies) of every distinct record, with the exact number of rows it had."""
        runs = self.scan.where("run > 0").join(F.broadcast(self.joined), "head", "left")
        return runs.groupBy(F.coalesce("first", "head").alias("keep_id"), F.when(F.col("head").isNull(), F.col("key")).alias("key")).agg(F.sum("copies").alias("copies")).drop("key")


def adjacent_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key: each row with the head of its run (run 0), and each run with its length (run 1; 2, with its key, if it touches
    an end of the partition)."""
    names = ["id", "head", "copies", "key", "run"]
    key, head, copies, first = None, None, 0, True

    def rows(ids, heads, counts, keys, run):
        n = len(heads)
        null = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([null if ids is None else ids, heads, null if counts is None else pa.array(counts, pa.int64()), pa.nulls(n, pa.string()) if keys is None else pa.array(keys, pa.string()), pa.array(run, pa.int32())], names=names)

    for batch in batches:
        ids, keys = batch.column(0), batch.column(1)
        n = len(ids)
        if not n:
            continue
        new = np.ones(n, np.bool_)
        new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = keys[0].as_py() != key
        start = np.flatnonzero(new)
        which = np.cumsum(new) - 1  # -1: still the run of the batch before
        heads = ids.take(pa.array(start))
        if new[0]:
            all_heads = heads.take(pa.array(which))
        else:
            all_heads = pa.concat_arrays([pa.array([head], pa.int64()), heads]).take(pa.array(which + 1))
        yield rows(ids, all_heads, None, None, np.zeros(n, np.int32))
        length = np.diff(np.append(start, n))
        if len(start):
            if key is not None:
                copies += int(start[0])
                yield rows(None, pa.array([head], pa.int64()), [copies], [key if first or head is None else None], [2 if first else 1])
                first = False
            if len(start) > 1:
                inner, edge = heads.slice(0, len(start) - 1), np.ones(len(start) - 1, np.int32)
                named = [None] * len(edge)
                if first:
                    edge[0], named[0], first = 2, keys[int(start[0])].as_py(), False
                for k in np.flatnonzero(pc.is_null(inner).to_numpy(zero_copy_only=False)):
                    named[k] = keys[int(start[k])].as_py()
                yield rows(None, inner, length[:-1], named, edge)
            key, head, copies = keys[int(start[-1])].as_py(), heads[len(heads) - 1].as_py(), int(length[-1])
        else:
            copies += n
    if key is not None:
        yield rows(None, pa.array([head], pa.int64()), [copies], [key], [2])
