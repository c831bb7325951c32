"""Deeply nested records to flat tables: each list becomes a child table that carries the ordinals of its ancestors.

Typed columns are followed by their schema. Of semi-structured text one pass takes the extraction out of its envelopes and infers the merged
schema of all records (only its distinct paths reach the driver); the extraction is parsed to VARIANT, and every path that is a list in any
record becomes a table, a lone object counting as a list of one. The nodes of all tables of a record come from one expression and one
explosion in the JVM, so that the source is read once, however many tables follow from it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..frames import written

#: Most distinct paths of a merged schema; more mean that data stand in field names, which no set of tables can hold.
MAX_PATHS = 20_000


@dataclass
class Shape:
    """Merged kinds of a place in the records, and what lies below it. ``listed``: a list somewhere."""

    kinds: set[str] = field(default_factory=set)
    listed: bool = False
    fields: dict[str, Shape] = field(default_factory=dict)


def _finite(text: str) -> float | str:
    x = float(text)
    return x if x - x == 0 else text  # a number no double holds stays text


def _no_constant(text: str) -> None:
    raise ValueError(f"{text} is no JSON")


_read = json.JSONDecoder(parse_float=_finite, parse_constant=_no_constant).decode


def unwrapped(text: str | None, key: str):
    """The extraction in ``text``: the object that has ``key``, directly, in envelopes of any depth, or as text in either; None if there is none.
    All values of an envelope are searched; of several extractions the one that lies least deep counts, then the first by the names of the
    fields that lead to it. A list is no envelope."""
    level = [] if text is None else [text]
    while level:
        inner = []
        for v in level:
            if isinstance(v, str):
                try:
                    inner.append(_read(v))
                except (ValueError, RecursionError):
                    pass
            else:
                inner += [x for _, x in sorted(v.items()) if isinstance(x, dict) or (isinstance(x, str) and x.lstrip(" \t\r\n")[:1] in ("{", '"'))]
        level = [x for x in inner if isinstance(x, str | dict)]
        if found := next((x for x in level if isinstance(x, dict) and key in x), None):
            return found
    return None


_KINDS = {dict: "object", list: "list", str: "string", bool: "boolean", int: "bigint", float: "double"}


def extractions(df: DataFrame, id_col: str, text_col: str, key: str) -> tuple[DataFrame, Shape]:
    """(rec_id, text) of the extraction of every row that has one, and the merged schema of what lies under ``key`` in all of them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, names = Shape(), ["rec_id", "text", "path", "kind"]
        places = 0
        for batch in batches:
            ids, texts = [], []
            for i, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (found := unwrapped(text, key)) is None:
                    continue
                out = json.dumps({key: found[key]}, ensure_ascii=False, separators=(",", ":"))
                ids.append(i)
                texts.append(out.encode("utf-8", "replace").decode())
                stack = [(found[key], top)]
                while stack:
                    v, at = stack.pop()
                    kind = _KINDS.get(type(v), "null")
                    at.kinds.add(kind)
                    if kind == "list":
                        stack += [(x, at) for x in v]
                    elif kind == "object":
                        for k, x in v.items():
                            if (below := at.fields.get(k)) is None:
                                below, places = at.fields.setdefault(k, Shape()), places + 1
                            stack.append((x, below))
                if places > MAX_PATHS:
                    raise ValueError(f"the merged schema has more than {MAX_PATHS} paths")
            none = pa.nulls(len(ids), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), none, none], names=names)
        paths, stack = [], [([], top)]
        while stack:
            path, at = stack.pop()
            paths += [(json.dumps(path), k) for k in sorted(at.kinds)]
            stack += [([*path, k], x) for k, x in at.fields.items()]
        none = (pa.nulls(len(paths), pa.int64()), pa.nulls(len(paths), pa.string()))
        yield pa.RecordBatch.from_arrays([*none, *(pa.array([p[k] for p in paths], pa.string()) for k in (0, 1))], names=names)

    own = df.select(F.col(id_col).cast("bigint").alias("rec_id"), F.col(text_col).cast("string").alias("text"))
    all_ = written(own.mapInArrow(scan, "rec_id bigint, text string, path string, kind string"))
    found = all_.where("path is not null").select("path", "kind").distinct().limit(7 * MAX_PATHS + 1).collect()
    if len({r.path for r in found}) > MAX_PATHS:
        raise ValueError(f"the merged schema has more than {MAX_PATHS} paths")
    top = Shape()
    for r in found:
        at = top
        for k in json.loads(r.path):
            at = at.fields.setdefault(k, Shape())
        at.kinds.add(r.kind)
        at.listed |= r.kind == "list"
    return all_.where("text is not null").select("rec_id", "text"), top


@dataclass
class _Level:
    """A child table: the list of its nodes in a node of the table above, which of them are nodes, their fields, and the tables below."""

    name: str
    items: Callable[[Column], Column]
    real: Callable[[Column], Column]
    kind: T.StructType
    fields: Callable[[Column], list[Column]]
    below: list[_Level] = field(default_factory=list)

    def walk(self) -> Iterator[_Level]:
        yield self
        for x in self.below:
            yield from x.walk()

    def node(self, x: Column) -> Column:
        return F.struct(*[c.alias(f.name) for c, f in zip(self.fields(x), self.kind)]) if len(self.kind) else F.lit(None).cast("struct<none:boolean>")

    @property
    def none(self) -> Column:
        return F.lit(None).cast(self.kind if len(self.kind) else "struct<none:boolean>")


class Flattened:
    """Child tables by path (names joined with dots): (rec_id, path ARRAY<INT>, node), ``path`` being the 0-based ordinals of all its ancestors
    and itself, ``node`` its fields but for lists of objects, which are tables themselves. Null elements keep their place but have no row;
    neither has anything that isn't an object in a list that holds objects. ``table`` gives fields as columns, ``keys`` the nodes of all
    tables without their fields. A row that is repeated has its nodes repeated; a null id is kept.
    """

    def __init__(self, source: DataFrame, root: Column, tops: list[_Level]):
        self.source, self.root, self.tops = source, root, tops
        self.levels = {x.name: x for top in tops for x in top.walk()}

    def __contains__(self, path: str) -> bool:
        return path in self.levels

    @classmethod
    def typed(cls, df: DataFrame, id_col: str, *columns: str) -> Flattened:
        """From list columns of structs; null and empty lists have no rows."""
        source = df.select(F.col(id_col).cast("bigint").alias("rec_id"), F.struct(*columns).alias("root"))
        return cls(source, F.col("root"), [_typed_level(c, lambda x, c=c: x[c], df.schema[c].dataType.elementType) for c in columns])

    @classmethod
    def text(cls, df: DataFrame, id_col: str, text_col: str, key: str) -> Flattened:
        """From JSON text with the list ``key`` at its top or in envelopes. Text that is no JSON, or nested deeper than its parser goes (thousands
        of levels), has no nodes. Of a field that an object has twice the last counts."""
        source, shape = extractions(df, id_col, text_col, key)
        tops = [_variant_level(key, key, shape)] if shape.kinds else []
        return cls(source.select("rec_id", F.parse_json("text").alias("root")), F.col("root"), tops)

    def _exploded(self, fields: bool) -> DataFrame:
        """The nodes of all tables: rec_id, number t of the table, path, and with ``fields`` one struct a table, null in rows of the others."""
        at = {name: k for k, name in enumerate(self.levels)}

        def row(level: _Level, path: Column, x: Column) -> Column:
            structs = [(o.node(x) if o is level else o.none).alias(f"n{k}") for k, o in enumerate(self.levels.values())] if fields else []
            return F.struct(F.lit(at[level.name]).alias("t"), path.alias("path"), *structs)

        def rows(level: _Level, of: Column, above: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                path = F.concat(above, F.array(i))
                own = [F.array(row(level, path, x)), *(rows(b, x, path) for b in level.below)]
                return F.when(level.real(x), F.concat(*own)).otherwise(F.array())

            return F.coalesce(F.flatten(F.transform(level.items(of), one)), F.array())

        every = F.concat(*[rows(top, self.root, F.array().cast("array<int>")) for top in self.tops])
        return self.source.select("rec_id", F.explode(every).alias("r")).select("rec_id", "r.*")

    def keys(self) -> DataFrame:
        """(rec_id, table, path) of every node."""
        if not self.tops:
            return self.source.select("rec_id", F.lit("").alias("table"), F.array().cast("array<int>").alias("path")).limit(0)
        return self._exploded(False).select("rec_id", F.element_at(F.array(*map(F.lit, self.levels)), F.col("t") + 1).alias("table"), "path")

    @cached_property
    def _rows(self) -> DataFrame:
        return written(self._exploded(True), "t")

    @cached_property
    def nodes(self) -> dict[str, DataFrame]:
        """All tables; their rows are written once, each table in a part of its own."""
        return {name: self._rows.where(F.col("t") == k).select("rec_id", "path", F.col(f"n{k}").alias("node")) for k, name in enumerate(self.levels)}

    def table(self, path: str) -> DataFrame:
        """Node and parent keys (rec_id and ordinals), the ordinal, and every field that is no list; fields of inner objects joined with ``_``.
        A field whose name is taken gets ``_`` behind it. Kinds that differ between records become text."""
        x = self.nodes[path]
        key = lambda p: F.concat_ws("/", F.col("rec_id").cast("string"), F.transform(p, lambda i: i.cast("string")))
        cols = {"rec_id": F.col("rec_id"), "node_key": key(F.col("path")), "parent_key": key(F.slice("path", 1, F.size("path") - 1)), "ord": F.element_at("path", -1)}
        for name, c in _flat(self.levels[path].kind, F.col("node")):
            cols[_free(name, cols)] = c
        return x.select(*[c.alias(k) for k, c in cols.items()])


def _free(name: str, taken) -> str:
    low = {k.lower() for k in taken}
    while name.lower() in low:
        name += "_"
    return name


def _flat(kind: T.StructType, at: Column, prefix: str = "") -> list[tuple[str, Column]]:
    out = []
    for f in kind:
        if isinstance(f.dataType, T.StructType):
            out += _flat(f.dataType, at[f.name], f"{prefix}{f.name}_")
        elif not isinstance(f.dataType, T.ArrayType):
            out.append((prefix + f.name, at[f.name]))
    return out


def _objects(kind: T.DataType) -> bool:
    """Whether a list of objects lies in ``kind``."""
    if isinstance(kind, T.ArrayType):
        return isinstance(kind.elementType, T.StructType)
    return isinstance(kind, T.StructType) and any(_objects(f.dataType) for f in kind)


def _typed_level(name: str, items: Callable[[Column], Column], kind: T.DataType) -> _Level:
    if not isinstance(kind, T.StructType):
        return _Level(name, items, lambda x: x.isNotNull(), T.StructType([T.StructField("value", kind)]), lambda x: [x])

    def without(t: T.StructType) -> T.StructType:
        return T.StructType([T.StructField(f.name, without(f.dataType) if _objects(f.dataType) else f.dataType) for f in t if not isinstance(f.dataType, T.ArrayType) or not _objects(f.dataType)])

    def pick(t: T.StructType, x: Column) -> list[Column]:
        return [F.when(x[f.name].isNotNull(), F.struct(*[c.alias(g.name) for c, g in zip(pick(f.dataType, x[f.name]), without(f.dataType))])) if _objects(f.dataType) else x[f.name] for f in t if f.name in without(t).names]

    level = _Level(name, items, lambda x: x.isNotNull(), without(kind), lambda x: pick(kind, x))

    def below(t: T.StructType, at: Callable[[Column], Column], prefix: str) -> None:
        for f in t:
            of = lambda x, n=f.name, at=at: at(x)[n]
            if isinstance(f.dataType, T.ArrayType):
                level.below.append(_typed_level(prefix + f.name, of, f.dataType.elementType))
            elif isinstance(f.dataType, T.StructType):
                below(f.dataType, of, f"{prefix}{f.name}.")

    below(kind, lambda x: x, f"{name}.")
    return level


def _place(*names: str) -> str:
    return "$" + "".join("['" + n.replace("\\", "\\\\").replace("'", "\\'") + "']" for n in names)


def _variant_level(field_name: str, name: str, shape: Shape, way: tuple[str, ...] = ()) -> _Level:
    place = _place(*way, field_name)

    def items(x: Column) -> Column:
        lone = F.try_variant_get(x, place, "variant")
        return F.coalesce(F.try_variant_get(x, place, "array<variant>"), F.when(lone.isNotNull() & ~F.is_variant_null(lone), F.array(lone)))

    def real(x: Column) -> Column:
        known = x.isNotNull() & ~F.coalesce(F.is_variant_null(x), F.lit(True))
        # an object: no plain kind takes it, and it is no list
        return known & F.try_variant_get(x, "$", "map<string,variant>").isNotNull() if shape.fields or not shape.kinds - {"null", "list", "object"} else known

    named = _variant_fields(shape)
    taken: list[str] = []
    for n, *_ in named:
        taken.append(_free(n, taken))
    kind = T.StructType([T.StructField(n, T.DataType.fromDDL(k)) for n, (_, _, k) in zip(taken, named)])
    level = _Level(name, items, real, kind, lambda x: [F.try_variant_get(x, p, k) for _, p, k in named])

    def below(of: Shape, path: tuple[str, ...], prefix: str) -> None:
        for k, inner in of.fields.items():
            if inner.listed:
                level.below.append(_variant_level(k, f"{prefix}.{k}", inner, path))
            elif inner.fields:
                below(inner, (*path, k), f"{prefix}.{k}")

    below(shape, (), name)
    return level


def _variant_fields(shape: Shape, way: tuple[str, ...] = ()) -> list[tuple[str, str, str]]:
    """Name, place and kind of every field that is no list."""
    out = []
    plain = shape.kinds - {"null", "list", "object"}
    if plain and not shape.fields:
        out.append(("_".join(way) or "value", _place(*way), min(plain) if len(plain) == 1 else "string"))
    for k in sorted(shape.fields):
        if not shape.fields[k].listed:
            out += _variant_fields(shape.fields[k], (*way, k))
    return out
