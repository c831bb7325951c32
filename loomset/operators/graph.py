"""Graphs of packages and classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..frames import cut


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) of every node, component being the least id it is joined with through ``edges`` (a, b).

    Each round, every node points to the least of what its neighbours point to, hooks what it pointed to there, and then pointers are
    halved; rounds grow with the logarithm of a component's size. Nulls join nothing; an edge's end that is no node is left out.
    """
    own = nodes.select("id").where("id is not null").distinct()
    ends = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    ends = cut(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    point = own.withColumn("to", F.col("id"))
    if not ends.limit(1).count():
        return point.withColumnRenamed("to", "component")
    point = cut(point)
    while True:
        far = point.select(F.col("id").alias("b"), F.col("to").alias("seen"))
        least = ends.join(far, "b").groupBy(F.col("a").alias("id")).agg(F.min("seen").alias("seen"))
        x = point.join(least, "id", "left").select("id", "to", F.least("to", "seen").alias("new"))
        hooked = x.select("id", "new").unionByName(x.select(F.col("to").alias("id"), "new")).groupBy("id").agg(F.min("new").alias("new"))
        up = hooked.select(F.col("id").alias("new"), F.col("new").alias("top"))
        step = cut(hooked.join(up, "new", "left").join(point, "id").select("id", F.least("new", "top").alias("to"), (F.least("new", "top") < F.col("to")).alias("moved")))
        point = step.select("id", "to")
        if not step.where("moved").limit(1).count():
            return point.withColumnRenamed("to", "component")


def transitive_closure(edges: DataFrame, within: list[str] | None = None) -> DataFrame:
    """(…within, a, b) of all pairs with a path from a to b over (…within, a, b), loops included. Paths double in length each round, and only
    pairs not seen before go on."""
    within = within or []
    every = cut(edges.select(*within, "a", "b").where("a is not null and b is not null").distinct())
    new = every
    while new.limit(1).count():
        on = every.select(*within, F.col("a").alias("b"), F.col("b").alias("c"))
        back = new.select(*within, F.col("a").alias("b"), F.col("b").alias("c"))
        longer = new.join(on, [*within, "b"]).select(*within, "a", F.col("c").alias("b"))
        longer = longer.unionByName(every.join(back, [*within, "b"]).select(*within, "a", F.col("c").alias("b"))).distinct()
        new = cut(longer.join(every, [*within, "a", "b"], "left_anti"))
        every = cut(every.unionByName(new))
    return every


def levels(nodes: DataFrame, edges: DataFrame, within: list[str] | None = None) -> DataFrame:
    """(…within, id, level) of nodes (…within, id): 0 without predecessor over edges (…within, a, b), else one more than its highest
    predecessor; null for what is on or behind a loop. One round a level."""
    within = within or []
    key = [*within, "id"]
    open_ = cut(nodes.select(*key).distinct())
    left = cut(edges.select(*within, "a", "b").where("a <> b").distinct().join(nodes.select(*within, F.col("id").alias("a")).distinct(), [*within, "a"], "left_semi").join(nodes.select(*within, F.col("id").alias("b")).distinct(), [*within, "b"], "left_semi"))
    done, level = None, 0
    while True:
        free = cut(open_.join(left.select(*within, F.col("b").alias("id")), key, "left_anti").withColumn("level", F.lit(level)))
        if not free.limit(1).count():
            break
        done = free if done is None else done.unionByName(free)
        open_ = cut(open_.join(free, key, "left_anti"))
        left = cut(left.join(free.select(*within, F.col("id").alias("a")), [*within, "a"], "left_anti"))
        level += 1
    rest = open_.withColumn("level", F.lit(None).cast("int"))
    return rest if done is None else done.unionByName(rest)


def emit_order(nodes: DataFrame, edges: DataFrame, within: list[str]) -> DataFrame:
    """(…within, id, rank) of nodes (…within, id, ord): predecessors first, by level, then by ``ord``; where a document's graph has a loop, by
    id alone."""
    x = levels(nodes, edges, within).join(nodes.select(*within, "id", "ord"), [*within, "id"])
    x = x.withColumn("looped", F.max(F.col("level").isNull()).over(Window.partitionBy(*within)))
    free = ~F.col("looped")
    w = Window.partitionBy(*within).orderBy(F.when(free, F.col("level")), F.when(free, F.col("ord")), "id")
    return x.select(*within, "id", F.row_number().over(w).alias("rank"))
