"""Orphan references kept up to date by a stream of changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.orphans import KEY, REFERENCE, Orphans


def follow(changes: DataFrame, checkpoint: str, state: Orphans | None = None, report: Callable[[DataFrame, int], None] | None = None, **trigger: object) -> tuple[Orphans, StreamingQuery]:
    """Feeds a stream of changes (kind ``reference`` or ``parent``, with the columns of both) to the state, batch by batch. The state lies beside the
    checkpoint and is taken up again with it; a batch that comes again after a failure changes nothing. ``report`` gets the counts after
    each batch."""
    own = state or Orphans(f"{checkpoint.rstrip('/')}/loomset-orphans")

    def step(batch: DataFrame, number: int) -> None:
        refs = batch.where("kind = 'reference'").select(*REFERENCE)
        own.advance(refs, batch.where("kind = 'parent'").select(*KEY, "created_at", "deleted_at"), number)
        if report:
            report(own.snapshot(), number)

    q = changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    return own, q


def as_changes(references: DataFrame, parents: DataFrame) -> DataFrame:
    """Both tables as one table of changes, to be written where a stream reads them."""
    null = lambda *cols: [F.lit(None).cast(t).alias(c) for c, t in cols]
    a = references.select(F.lit("reference").alias("kind"), *REFERENCE, *null(("created_at", "timestamp"), ("deleted_at", "timestamp")))
    b = parents.select(F.lit("parent").alias("kind"), *null(("source_table", "string"), ("ref_id", "bigint")), *KEY, *null(("ref_at", "timestamp")), "created_at", "deleted_at")
    return a.unionByName(b)
