"""Mixing sources to target weights, by Sainte-Lague apportionment of equal-token blocks.

Tokens are counted once over every text. Sources get integer quotas of blocks by the highest quotients share / (2 k + 1); each source's
quota is apportioned over its shards by their tokens; within a shard, documents are taken in seeded order until its quota is filled. What a
source can give is counted over all its shards, and small sources have fewer of them.
Only sums by source and shard reach the driver: their number is bounded by ``MAX_CELLS``.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..frames import written

#: Most pairs of a target source and a shard whose sums come to the driver.
MAX_CELLS = 1_000_000
#: Blocks of tokens that a source should hold for each of its shards.
SHARD_BLOCKS = 64
#: Fixed value: the way the public vocabulary parts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_loaded: dict[str, object] = {}


@dataclass(frozen=True)
class Settings:
    """vocabulary: ranks of a public byte-level tokenizer, at the same place on every node; block: tokens of a block;
    shard_docs: documents a shard should hold; seed: fixes which documents are taken; total: tokens wanted, by default as many as every
    source can give its share of."""

    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    block: int = 256
    shard_docs: int = 2_000_000
    least_shards: int = 16
    seed: int = 42
    total: int | None = None


def encoder(path: str):
    """The tokenizer, loaded once a worker."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("loomset", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def token_counts(documents: DataFrame, vocabulary: str, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, source, tokens) of every document; a null text has 0 tokens."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "source", "tokens"])

    own = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(scan, "doc_id bigint, source string, tokens bigint")


def sainte_lague(weights: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats of each weight by the highest quotients weight / (2 k + 1), none above its cap; ties go to the first. All seats are given unless
    the caps don't hold them. Works by the divisor, so that the number of seats doesn't matter."""
    w, cap = np.array(weights, float), np.array(caps, np.int64)
    cap = np.where(w > 0, cap, 0)
    if seats >= cap.sum():
        return cap.tolist()
    lo, hi = 0.0, 1.0

    def given(x: float) -> np.ndarray:
        return np.minimum(np.floor(np.minimum(w * x + 0.5, 2**62)).astype(np.int64), cap)

    while given(hi).sum() <= seats and hi < 1e300:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if given(mid).sum() <= seats else (lo, mid)
    got = given(lo)
    while got.sum() < seats:
        quotient = np.where(got < cap, w / (2 * got + 1), -1.0)
        got[int(np.argmax(quotient))] += 1
    return got.tolist()


class Mixture:
    """The operator over (doc_id, source, text) and targets (source, target_share, max_repeats).

    A source of one side only takes no part: without documents its share can't be given (the others then share the whole in their
    proportions), without target its documents aren't used; both stand in ``shares``. Null sources are a source without target; null texts
    and empty ones have no tokens and aren't used. A document listed twice counts as often as it is listed. A target with a null or
    non-positive share or max_repeats gets nothing; a source with several targets raises an error, and so do sources that can't give one block
    together. Empty tables give empty results.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, settings: Settings = Settings()):
        s = self.s = settings
        self.targets = targets.select(F.col("source").cast("string").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats"))
        self.tokens = written(token_counts(documents, s.vocabulary))
        count = self.tokens.count()
        self.shards = max(s.least_shards, -(-count // s.shard_docs))
        goal = {r.source: r for r in self.targets.limit(MAX_CELLS).collect() if r.source is not None}
        if len(goal) * self.shards > MAX_CELLS:
            raise ValueError(f"{len(goal)} sources in {self.shards} shards exceed {MAX_CELLS} cells")
        if self.targets.where("source is not null").count() != len(goal):
            raise ValueError("a source has several targets")
        self.sharded = self.tokens.where("tokens > 0").withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(s.seed)), F.lit(self.shards)).cast("int"))
        used = self.sharded.join(F.broadcast(documents.sparkSession.createDataFrame([(x,) for x in goal], "source string")), "source", "left_semi")  # at most MAX_CELLS names
        cells: dict[str, dict[int, int]] = {}
        for r in used.groupBy("source", "shard").agg(F.sum("tokens").alias("n")).collect():  # bounded: sources * shards
            cells.setdefault(r.source, {})[r.shard] = r.n
        self.parts = {x: min(self.shards, max(1, sum(c.values()) // (s.block * SHARD_BLOCKS))) for x, c in cells.items()}
        for x, c in cells.items():
            merged: dict[int, int] = {}
            for k, n in c.items():
                merged[k % self.parts[x]] = merged.get(k % self.parts[x], 0) + n
            cells[x] = merged
        self.quotas = self._quotas(goal, cells)

    def _quotas(self, goal: dict, cells: dict[str, dict[int, int]]) -> list[tuple[str, int, int, int]]:
        """(source, shard, tokens there, tokens to take)."""
        s = self.s
        names = sorted(x for x in cells if (goal[x].target_share or 0) > 0 and (goal[x].max_repeats or 0) > 0)
        shards = {x: sorted(cells[x]) for x in names}
        most = {x: [cells[x][k] * goal[x].max_repeats for k in shards[x]] for x in names}
        room = {x: [-(-n // s.block) for n in most[x]] for x in names}  # the last block may be a part of one
        weights = [goal[x].target_share for x in names]
        sums = [sum(most[x]) for x in names]
        caps = [-(-n // s.block) for n in sums]
        blocks = s.total // s.block if s.total is not None else int(min((n / s.block / w for n, w in zip(sums, weights)), default=0) * sum(weights))
        if names and s.total is None and not blocks:
            raise ValueError(f"the sources can't give one block of {s.block} tokens in their shares")
        out = []
        for x, n, cap in zip(names, sainte_lague(weights, blocks, caps) if names else [], caps):
            for k, q, top in zip(shards[x], sainte_lague([float(cells[x][k]) for k in shards[x]], n, room[x]), most[x]):
                out.append((x, k, cells[x][k], top if n == cap else min(q * s.block, top)))
        return out

    def _quota_frame(self) -> DataFrame:
        return self.tokens.sparkSession.createDataFrame(self.quotas, "source string, shard int, there bigint, quota bigint")

    def chosen(self) -> DataFrame:
        """(doc_id, source, tokens, repeats) of every document that is used: whole passes over its shard, and once more if the middle of
        it lies in what is left of the shard's quota, in seeded order."""
        w = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(self.s.seed + 1), "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        parts = self.tokens.sparkSession.createDataFrame(list(self.parts.items()), "source string, parts int")
        x = self.sharded.join(F.broadcast(parts), "source").withColumn("shard", F.col("shard") % F.col("parts"))
        x = x.join(F.broadcast(self._quota_frame()), ["source", "shard"])  # at most MAX_CELLS rows
        x = x.withColumn("until", F.sum("tokens").over(w)).withColumn("passes", F.floor(F.col("quota") / F.col("there")))
        again = (2 * F.col("until") - F.col("tokens") <= 2 * (F.col("quota") - F.col("passes") * F.col("there"))).cast("int")
        return x.select("doc_id", "source", "tokens", (F.col("passes") + again).cast("int").alias("repeats")).where("repeats > 0")

    def shares(self) -> DataFrame:
        """For each source of either side: its target, what it has, its quota and what it gives, in tokens and as a share of all."""
        took = written(self.chosen().groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("mixed_tokens"), F.max("repeats").alias("most_repeats")))
        there = self.tokens.groupBy("source").agg(F.sum("tokens").alias("available_tokens"))
        quota = self._quota_frame().groupBy("source").agg(F.sum("quota").alias("quota_tokens"))
        x = there.join(self.targets, there.source.eqNullSafe(self.targets.source), "full").select(F.coalesce(there.source, self.targets.source).alias("source"), "target_share", "max_repeats", "available_tokens")
        for y in (quota, took):
            x = x.join(y, "source", "left")
        x = x.fillna(0, ["available_tokens", "quota_tokens", "mixed_tokens", "most_repeats"])
        total = took.agg(F.sum("mixed_tokens")).first()[0] or 1
        return x.select("source", "target_share", "max_repeats", "available_tokens", "quota_tokens", "mixed_tokens", "most_repeats", (F.col("mixed_tokens") / F.lit(total)).alias("actual_share"))
