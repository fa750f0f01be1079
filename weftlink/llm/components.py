"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import storage


#: From so many edges on, minima are written before they are joined, so that the join of a hot centre can be split.
MANY = 1_000_000
#: Up to so many edges of whole numbers, one task makes the rounds in its memory (16 bytes an edge, some copies).
FEW = 500_000


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, component) of the ends of edges (a, b): each round links the roots of both ends to the lesser one, and every id to its root."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while len(x):
        np.minimum.at(root, np.maximum(root[x], root[y]), np.minimum(root[x], root[y]))
        while not np.array_equal(root, up := root[root]):
            root = up
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return ids, ids[root]


def _in_one_task(edges: DataFrame) -> DataFrame:
    """connected of a table (u, v) of few edges of whole numbers."""
    kind = edges.schema["u"].dataType.simpleString()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, schema)
        found = least_reachable(*(table.column(c).to_numpy() for c in ("u", "v")))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["id", "component"])

    schema = pa.schema([(c, pa.int64() if kind == "bigint" else pa.int32()) for c in ("u", "v")])
    return edges.coalesce(1).mapInArrow(join, f"id {kind}, component {kind}")


def _each(*pairs: tuple[str, str], names: tuple[str, str] = ("u", "v")) -> Column:
    """A row for each of these pairs of columns."""
    return F.inline(F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(p, names)]) for p in pairs]))


def _round_in_one_task(now: DataFrame) -> DataFrame:
    """One round of large and small stars of a table (u, v) of few edges, v the lesser: windows over one partition, so nothing is dealt."""
    least = F.min("v").over(Window.partitionBy("u"))
    wide = now.coalesce(1).select(_each(("u", "v"), ("v", "u"))).withColumn("m", F.least("u", least))
    large = wide.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return large.withColumn("m", least).select(_each(("u", "m"), ("v", "m"))).where("u <> v").distinct()


def _star(pairs: DataFrame, many: bool) -> tuple[DataFrame, DataFrame | None]:
    """For (u, v) rows the least of u and its v, beside each row; and the table to drop afterwards, if there is one."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    made = storage.cut(least, "least") if many else None
    return pairs.join(least if made is None else made, F.col("u") == F.col("c")).drop("c"), made


def connected(edges: DataFrame, native: bool = False) -> DataFrame:
    """(id, component) for every id on an edge (a, b); component is the least id reachable.

    Each round links every neighbour to the least one of its centre, first the larger
    neighbours, then the smaller; the rows never outnumber the edges, and a round that
    changes nothing ends the loop (about log of the longest path). Minima are taken in
    partial aggregates, so a centre with most of the edges is no hot group; the join back
    is a plain equality join, between plain exchanges where edges are many, which adaptive
    execution can split. Every round is written to the shared folder. Where edges are FEW,
    the same is done by one task in its memory: their rounds are hardly any work, but each
    is a plan of many stages for the driver. native=True runs no Python on the executors:
    the rounds of FEW edges are then DataFrame expressions over one partition, a task each.
    Loops and null ends are ignored; without edges the result is empty.
    """
    now = storage.cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        few = native and before is not None and before[0] <= FEW  # of the table before this one; no round has more edges than that before
        state = (now.coalesce(1) if few else now).agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        if native and state[0] <= FEW:
            before, after = state, storage.cut(_round_in_one_task(now), "edges")
            storage.drop_cut(now)
            now = after
            continue
        if before is None and state[0] <= FEW and {k for _, k in now.dtypes} in ({"bigint"}, {"int"}):
            out = _in_one_task(now)
            out._weftlink_path = now._weftlink_path
            return out
        before = state
        many = state[0] > MANY
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        wide, first = _star(both, many)
        large = wide.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        turned = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        turned = storage.cut(turned, "edges") if many else turned
        small, second = _star(turned, many)
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = storage.cut(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        for x in (now, first, second, turned if many else None):
            if x is not None:
                storage.drop_cut(x)
        now = after
    if few:  # stars by now: each u has one v
        out = now.coalesce(1).select(_each(("u", "v"), ("v", "v"), names=("id", "component"))).distinct()
        out._weftlink_path = now._weftlink_path
        return out
    out = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component").unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
    out._weftlink_path = now._weftlink_path  # for drop_cut, once the result has been written elsewhere
    return out
