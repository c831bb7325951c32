"""Parent-child links to full hierarchies: path, depth and root of every node, its descendants, and the loops told apart.

Links point from a node to at most one parent, so a connected component is a tree or has exactly one loop. Components are found by pointer
doubling (each round joins every node with what its ancestor knows, so a tree of depth d takes log2(d) rounds), then co-located, and each is
walked depth first with node colouring. A component of more than ``max_component`` nodes never goes to one task: its paths are put together
by the same doubling, its loop is the image of enough steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import cut

#: Most nodes of a component that are walked in one task.
MAX_COMPONENT = 200_000
SCHEMA = "id bigint, root bigint, depth int, path string"


def single_parent(links: DataFrame) -> DataFrame:
    """(id, parent) with one row a node, from rows that may repeat; the least of several parents counts."""
    return links.where("id is not null").groupBy("id").agg(F.min("parent").alias("parent"))


def _components(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, parent, comp) of the nodes of trees, comp being the root; the same of the others, with comp the least node of the loop they lead to
    and on_loop."""
    known = nodes.select("id", F.col("parent").alias("far"), F.when(F.col("parent").isNull(), F.col("id")).alias("root"))
    known, open_ = cut(known), -1
    while True:
        left = known.where("root is null").count()
        if left in (0, open_):  # depths have no gaps: a round that reaches no root leaves only loops
            break
        open_ = left
        up = known.select(F.col("id").alias("far"), F.col("far").alias("next"), F.col("root").alias("top"))
        waiting = known.where("root is null").join(up, "far").select("id", F.col("next").alias("far"), F.col("top").alias("root"))
        known = cut(known.where("root is not null").unionByName(waiting))
    trees = known.where("root is not null").select("id", F.col("root").alias("comp")).join(nodes, "id")
    loops = nodes.join(known.where("root is null").select("id"), "id")
    if not left:
        return trees, loops.select("id", "parent", F.col("id").alias("comp"), F.lit(True).alias("on_loop"))
    step = cut(loops.select("id", F.col("parent").alias("far"), F.least("id", "parent").alias("least"), F.lit(True).alias("moved")))
    seen = None
    while True:
        # As long a walk again reaches no fewer nodes: all of them are on loops. No least changed: each is that of its whole loop, as two
        # walks in a row, which hold different nodes unless they go around, have the same one.
        ends, moved = step.agg(F.countDistinct("far"), F.count_if("moved")).first()
        if ends == seen and not moved:
            break
        seen = ends
        up = step.select(F.col("id").alias("far"), F.col("far").alias("next"), F.col("least").alias("other"))
        step = cut(step.join(up, "far").select("id", F.col("next").alias("far"), F.least("least", "other").alias("least"), (F.col("other") < F.col("least")).alias("moved")))
    ring = step.select(F.col("far").alias("id")).distinct().join(step, "id").select(F.col("id").alias("far"), F.col("least").alias("comp"))
    loops = loops.join(step.select("id", "far"), "id").join(ring, "far").select("id", "parent", "comp")
    return trees, loops.join(ring.select(F.col("far").alias("id"), F.lit(True).alias("on_loop")), "id", "left").fillna(False, ["on_loop"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks each component of rows (comp, id, parent) that come ordered by comp."""
    names = ["id", "root", "depth", "path"]
    held: list[tuple[int, int | None]] = []
    now, out = None, [[] for _ in names]

    def component(rows: list[tuple[int, int | None]]) -> None:
        parent = dict(rows)
        children: dict[int, list[int]] = {}
        for i, p in rows:
            if p is not None:
                children.setdefault(p, []).append(i)
        seen: set[int] = set()
        for start in (i for i, p in rows if p is None):
            stack = [(start, 0, str(start))]
            while stack:
                i, depth, path = stack.pop()
                seen.add(i)
                for col, v in zip(out, (i, start, depth, path)):
                    col.append(v)
                stack += [(c, depth + 1, f"{path}/{c}") for c in children.get(i, ())]
        # white: not met; grey: on the walk that is under way; black: left. A link to a grey node closes a loop.
        colour: dict[int, int] = {}
        loop: set[int] = set()
        for i in parent:
            if i in seen or i in colour:
                continue
            walk = []
            while i is not None and i not in colour:
                colour[i] = 1
                walk.append(i)
                i = parent.get(i)
            if i is not None and colour[i] == 1:
                loop.update(walk[walk.index(i) :])
            colour.update(dict.fromkeys(walk, 2))
        for i in colour:
            for col, v in zip(out, (i, 0, -1, "cycle" if i in loop else "below cycle")):
                col.append(v)

    def emit() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string())
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
        for c in out:
            c.clear()
        return batch

    for batch in batches:
        for comp, i, p in zip(*(c.to_pylist() for c in batch.columns)):
            if comp != now and held:
                component(held)
                held = []
                if len(out[0]) > 20_000:
                    yield emit()
            now = comp
            held.append((i, p))
    if held:
        component(held)
    if out[0]:
        yield emit()


def _paths_by_doubling(nodes: DataFrame) -> DataFrame:
    """(id, root, depth, path) of trees of any size."""
    root = F.col("parent").isNull()
    known = nodes.select("id", F.col("parent").alias("far"), F.when(root, F.col("id")).alias("root"), F.when(root, 0).otherwise(1).alias("depth"), F.col("id").cast("string").alias("path"))
    known = cut(known)
    while known.where("root is null").limit(1).count():
        up = known.select(F.col("id").alias("far"), F.col("far").alias("next"), F.col("root").alias("top"), F.col("depth").alias("more"), F.col("path").alias("before"))
        waiting = known.where("root is null").join(up, "far").select("id", F.col("next").alias("far"), F.col("top").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), F.concat_ws("/", "before", "path").alias("path"))
        known = cut(known.where("root is not null").unionByName(waiting))
    return known.select("id", "root", "depth", "path")


def _nodes(links: DataFrame) -> DataFrame:
    """(id, parent) of every node, a parent that is no node being none."""
    own = single_parent(links.select(F.col("id").cast("bigint"), F.col("parent").cast("bigint")))
    there = own.select(F.col("id").alias("parent"), F.lit(True).alias("there"))
    return cut(own.join(there, "parent", "left").select("id", F.when(F.col("there"), F.col("parent")).alias("parent")))


def cycles(links: DataFrame) -> DataFrame:
    """(loop, id, parent, closes) of every node on a loop of ``links`` (id, parent): its loop, named by the least node on it, and the link to its
    parent. ``closes`` marks the back edge of a walk that begins at the least node. Nulls and repeated rows as for ``hierarchy``."""
    _, loops = _components(_nodes(links))
    return loops.where("on_loop").select(F.col("comp").alias("loop"), "id", "parent", (F.col("parent") == F.col("comp")).alias("closes"))


def hierarchy(links: DataFrame, max_component: int = MAX_COMPONENT) -> DataFrame:
    """(id, root, depth, path) of every node of ``links`` (id, parent).

    A root has depth 0; ``path`` joins the ids from root to node with ``/``. A node on a loop has root 0, depth -1 and path ``cycle``, one that
    leads up to a loop ``below cycle``. A null parent, or one that is no id, makes a root; a null id is no node; repeated rows count once, and of
    several parents the least counts. An empty table has no nodes; other columns are not read.
    """
    trees, loops = _components(_nodes(links))
    trees, loops = cut(trees.select("id", "parent", "comp")), cut(loops)
    sizes = trees.select("comp").unionByName(loops.select("comp")).groupBy("comp").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > max_component).select("comp")
    every = trees.unionByName(loops.select("id", "parent", "comp"))
    if not large.limit(1).count():
        return _walked(every)
    walked = _walked(every.join(large, "comp", "left_anti"))
    doubled = _paths_by_doubling(trees.join(large, "comp", "left_semi").select("id", "parent"))
    name = F.when(F.col("on_loop"), "cycle").otherwise("below cycle")
    around = loops.join(large, "comp", "left_semi").select("id", F.lit(0).cast("bigint").alias("root"), F.lit(-1).alias("depth"), name.alias("path"))
    return walked.unionByName(doubled).unionByName(around)


def _walked(nodes: DataFrame) -> DataFrame:
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the work is in the nodes, not in their bytes: not to be coalesced or left out
    rows = nodes.select("comp", "id", "parent").repartition(n, F.xxhash64("comp")).sortWithinPartitions("comp", "id")
    return rows.mapInArrow(_walk, SCHEMA)


def descendants(paths: DataFrame) -> DataFrame:
    """(id, descendant, distance) of every node and each node below it, from the result of ``hierarchy``: every path names its node's ancestors.
    Nodes on or below loops have none."""
    x = paths.where("depth > 0").select(F.col("id").alias("descendant"), "depth", F.posexplode(F.split("path", "/")).alias("at", "up"))
    return x.where("at < depth").select(F.col("up").cast("bigint").alias("id"), "descendant", (F.col("depth") - F.col("at")).alias("distance"))


def class_links(classes: DataFrame, properties: DataFrame) -> DataFrame:
    """(id, parent) of every class: the class that the first non-external entry of ``parents`` with a class name names by package and name;
    without such an entry, the class that ``inherited_from`` of its first attribute with one names. Of re-delivered rows the latest counts."""
    latest = classes.where("class_id is not null").groupBy("class_id").agg(F.max_by(F.struct("package", "name", "parents"), F.coalesce("loaded_at", F.lit(0).cast("timestamp"))).alias("c"))
    own = latest.select(F.col("class_id").alias("id"), "c.package", "c.name", F.get(F.filter("c.parents", lambda p: p["class_name"].isNotNull() & ~F.coalesce(p["is_external"], F.lit(False))), 0).alias("entry"))
    named = own.groupBy("package", "name").agg(F.min("id").alias("parent"))
    by_entry = own.where("entry is not null").select("id", F.col("entry.package").alias("package"), F.col("entry.class_name").alias("name"))
    first = by_entry.join(named, ["package", "name"], "left").select("id", "parent")
    heirs = properties.where("inherited_from is not null and class_id is not null").groupBy("class_id").agg(F.min_by("inherited_from", F.struct("attr_ord", "attr_id")).alias("name"))
    by_name = own.where("name is not null").groupBy("name").agg(F.min("id").alias("parent"))
    rest = own.where("entry is null").select("id").join(heirs.withColumnRenamed("class_id", "id"), "id", "left").join(by_name, "name", "left").select("id", "parent")
    return first.unionByName(rest)
