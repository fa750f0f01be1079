"""Near-duplicate vectors from a forest of random-projection trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from . import components, storage

#: Trees; vectors that a leaf may hold; share of a node that goes to both of its children.
TREES, LEAF, SPILL = 8, 1024, 0.12
#: Rows of a node, about, whose projections set its thresholds, and levels split in one round at most.
SAMPLE, LEVELS = 4096, 4
#: A node that cannot be split below this share of its size in a round is dense: its vectors are compared in blocks.
DENSE = 0.9
#: A node is tight, and dense too, where this share of the pairs of TIGHT_ROWS of its vectors are links: comparing all
#: pairs costs 1 / TIGHT times its links at most, while splits would part links.
TIGHT, TIGHT_ROWS = 0.25, 256
#: Vectors of a block of a dense node, in leaves; columns of homes that are held against each other at once.
BLOCK_LEAVES, HOME_COLUMNS = 8, 512
ROUNDS = 24


def _plane(node: int, dims: int) -> np.ndarray:
    """The random direction of a node: a function of its number, which the path from its tree's root makes, so it needs no storage."""
    seed = int(bw.mix(np.array([node], np.int64).view(np.uint64))[0])
    return np.random.default_rng(seed).standard_normal(dims)


def _child(node: int, right: int) -> int:
    return int(bw.mix(np.array([node], np.int64).view(np.uint64) * np.uint64(2) + np.uint64(right + 0x51ED270B))[0] >> np.uint64(1))


def _tight(vectors: np.ndarray, least: float) -> bool:
    """True if TIGHT of the pairs of a sample, evenly spread over the rows, have cosine `least` or more."""
    v = vectors[:: max(1, len(vectors) // TIGHT_ROWS)][:TIGHT_ROWS]
    n = len(v)
    return n > 1 and np.count_nonzero(v @ v.T >= least) - n >= TIGHT * n * (n - 1)


def fit_node(vectors: np.ndarray, node: int, levels: int, spill: float, least: float = 2.0) -> list[tuple[int, float, float]]:
    """(node, low, high) of a subtree: what projects below high goes left, above low goes right; a tight node has nan and is not split."""
    out, work = [], [(node, vectors)]
    for _ in range(levels):
        after = []
        for own, v in work:
            if _tight(v, least):
                out.append((own, float("nan"), float("nan")))
                continue
            p = v @ _plane(own, v.shape[1])
            low, high = np.quantile(p, (0.5 - spill / 2, 0.5 + spill / 2)) if len(p) else (0.0, 0.0)
            out.append((own, float(low), float(high)))
            after += [(_child(own, 0), v[p <= high]), (_child(own, 1), v[p >= low])]
        work = after
    return out


def route(vectors: np.ndarray, node: int, limits: dict[int, tuple[float, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, tight) for every leaf that a vector reaches; one that lies between low and high reaches both children."""
    work, found = [(node, np.arange(len(vectors)))], []
    while work:
        own, rows = work.pop()
        low, high = limits.get(own, (np.nan, np.nan))
        if np.isnan(low):
            found.append((rows, own, own in limits))
            continue
        p = vectors[rows] @ _plane(own, vectors.shape[1])
        work += [(_child(own, 0), rows[p <= high]), (_child(own, 1), rows[p >= low])]
    return np.concatenate([r for r, _, _ in found]), np.concatenate([np.full(len(r), n, np.int64) for r, n, _ in found]), np.concatenate([np.full(len(r), t, bool) for r, _, t in found])


def _unit(column: pa.Array) -> np.ndarray:
    """Unit vectors, all of one length, in double precision, scaled by the largest component first so that no square overflows or vanishes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    v = np.asarray(column.flatten()).reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))
    v = v / np.abs(v).max(axis=1, keepdims=True, initial=0)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def distinct_vectors(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """(members, distinct): vec_id with rep, and rep with its vector, number of members and dimensions.

    Equal vectors are one point from the start. Null, zero and non-finite vectors have rep null.
    """
    top = F.array_max(F.transform("u", lambda x: F.abs(x)))
    finite = F.forall("u", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("u")).withColumn("__row", F.monotonically_increasing_id())
    base = base.withColumn("u", F.when(F.coalesce(finite & (top > 0), F.lit(False)), F.col("u")))
    units = storage.cut(base.withColumns({"h": F.xxhash64("u"), "h2": F.xxhash64(F.lit(1), "u"), "dims": F.size("u")}), "vectors")
    groups = units.where("u IS NOT NULL").groupBy("h", "h2", "dims").agg(F.min("__row").alias("rep"), F.count("*").alias("copies"))
    groups = storage.cut(groups, "groups")
    g = groups.select(F.col("h").alias("gh"), F.col("h2").alias("gh2"), F.col("dims").alias("gd"), "rep", "copies")
    same = (F.col("h") == F.col("gh")) & (F.col("h2") == F.col("gh2")) & (F.col("dims") == F.col("gd")) & F.col("u").isNotNull()
    members = units.select("vec_id", "h", "h2", "dims", "u").join(g, same, "left").select("vec_id", "rep", "copies")
    distinct = units.select(F.col("__row").alias("rep"), "u").join(groups.select("rep", "copies", "dims"), "rep")
    out = storage.cut(members, "members"), storage.cut(distinct, "distinct")
    storage.drop_cut(units)
    storage.drop_cut(groups)
    return out


def forest_leaves(distinct: DataFrame, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, sample: int = SAMPLE, least: float = 0.9) -> DataFrame:
    """(rep, node, dense): the leaves of every vector in all trees; only numbers are kept, vectors stay where they are.

    Vectors of each length (dims) have trees of their own: the length is part of the root's number.
    Every round splits all nodes that are too large by LEVELS levels, each fitted on a
    hash sample of about `sample` of its own rows, so that nothing that is gathered grows
    with the input; the rows of leaves are done. A node whose sample is tight, and one that
    a round cannot thin out, is left as it is and marked dense. Thresholds are broadcast
    while they are few and joined by node beyond that.
    """
    roots = F.array(*[F.shiftrightunsigned(F.xxhash64(F.lit(t), "dims"), 1) for t in range(1, trees + 1)])
    now = storage.cut(distinct.select("rep", F.explode(roots).alias("node")), "nodes")
    vectors = distinct.select("rep", "u")
    done: list[DataFrame] = []
    for turn in range(ROUNDS):
        big = storage.cut(now.groupBy("node").agg(F.count("*").alias("c")).where(F.col("c") > leaf), "big")
        n_big = big.count()
        hint = F.broadcast if n_big * 256 <= storage.BROADCAST_BYTES else (lambda x: x)
        done.append(storage.cut(now.join(hint(big.select("node")), "node", "left_anti").select("rep", "node", F.lit(False).alias("dense")), "leaves"))
        if not n_big:
            storage.drop_cut(now)
            break

        def fit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            # as many levels as this node still needs
            need = int(np.ceil(np.log(key[1].as_py() / leaf) / -np.log(0.5 + spill / 2)))
            found = fit_node(_unit(table.column("u")), key[0].as_py(), max(1, min(LEVELS, need)), spill, least)
            return pa.table({"node": pa.array([key[0].as_py()], pa.int64()), "own": pa.array([[x[0] for x in found]], pa.list_(pa.int64())), "low": pa.array([[x[1] for x in found]], pa.list_(pa.float64())), "high": pa.array([[x[2] for x in found]], pa.list_(pa.float64()))})

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table = pa.Table.from_batches([batch])
                node, rep, size = (table.column(c).to_numpy() for c in ("node", "rep", "c"))
                _, first, back = np.unique(node, return_index=True, return_inverse=True)
                for g, at in enumerate(first):
                    own = np.flatnonzero(back == g)
                    limits = dict(zip(table.column("own")[at].as_py(), zip(table.column("low")[at].as_py(), table.column("high")[at].as_py())))
                    r, n, tight = route(_unit(table.column("u").take(pa.array(own))), int(node[at]), limits)
                    yield pa.RecordBatch.from_arrays([pa.array(rep[own[r]]), pa.array(n), pa.array(size[own[r]]), pa.array(tight)], names=["rep", "node", "parent", "tight"])

        work = now.join(hint(big), "node")
        draw = F.pmod(F.xxhash64("rep", "node", F.lit(turn)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        drawn = work.where(draw < F.lit(float(sample)) / F.col("c")).select("rep", "node", "c")
        fitted = storage.cut(drawn.join(vectors, "rep").groupBy("node", "c").applyInArrow(fit, "node long, own array<long>, low array<double>, high array<double>"), "limits")
        routed = work.join(vectors, "rep").join(hint(fitted), "node").select("rep", "node", "c", "u", "own", "low", "high")
        after = storage.cut(routed.mapInArrow(split, "rep long, node long, parent long, tight boolean"), "nodes")
        sizes = after.groupBy("node").agg(F.count("*").alias("c"), F.max("parent").alias("p"), F.max("tight").alias("tight"))
        thick = sizes.where(F.col("tight") | ((F.col("c") > leaf) & (F.col("c") >= F.lit(DENSE) * F.col("p"))))
        thick = storage.small(storage.cut(thick.select("node"), "thick"), 16)
        done.append(storage.cut(after.join(thick, "node", "left_semi").select("rep", "node", F.lit(True).alias("dense")), "leaves"))
        left = storage.cut(after.join(thick, "node", "left_anti").select("rep", "node"), "nodes")
        for x in (now, after, fitted):
            storage.drop_cut(x)
        now = left
    else:
        done.append(now.select("rep", "node", F.lit(True).alias("dense")))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def _met_before(homes: np.ndarray, owner: np.ndarray, i: np.ndarray, j: np.ndarray, home: int) -> np.ndarray:
    """For rows i against rows j, true where both are in a leaf that comes before `home` in order; homes lists the leaves of all rows, owner their rows."""

    def places(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.full(owner[-1] + 1, -1)
        place[own] = np.arange(len(own))
        keep = (place[owner] >= 0) & (homes < home)
        return place[owner][keep], homes[keep]

    ri, hi = places(i)
    rj, hj = places(j)
    names = np.intersect1d(hi, hj)
    met = np.zeros((len(i), len(j)), bool)
    for at in range(0, len(names), HOME_COLUMNS):
        some = names[at : at + HOME_COLUMNS]
        sides = []
        for n, r, h in ((len(i), ri, hi), (len(j), rj, hj)):
            k = np.searchsorted(some, h)
            ok = (k < len(some)) & (some[np.minimum(k, len(some) - 1)] == h)
            m = np.zeros((n, len(some)), np.float32)
            m[r[ok], k[ok]] = 1
            sides.append(m)
        met |= sides[0] @ sides[1].T > 0
    return met


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels with those of i and j made one, the least of each class."""
    while True:
        apart = root[i] != root[j]
        if not apart.any():
            return root
        i, j = i[apart], j[apart]
        a, b = root[i], root[j]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, root[root]):
            root = root[root]


def links_of(u: np.ndarray, copies: np.ndarray, flat: np.ndarray, cuts: np.ndarray, left: np.ndarray, right: np.ndarray, home: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) by row: copies linked to it in this leaf first, and its class, for rows left against rows right (all pairs once if equal)."""
    n, root = np.zeros(len(u)), np.arange(len(u))
    same = len(left) == len(right) and np.array_equal(left, right)
    owner = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    step = max(1, (1 << 21) // max(len(right), 1))
    for at in range(0, len(left), step):
        own = left[at : at + step]
        other = right[at:] if same else right
        s = u[own] @ u[other].T
        near = s >= least - 1e-9
        if same:
            near &= np.arange(len(other))[None, :] > np.arange(len(own))[:, None]
        # at the border the pair is summed in one order, whatever block it is in
        x, y = np.nonzero(near & (s <= least + 1e-9))
        near[x, y] = np.einsum("ij,ij->i", u[own[x]], u[other[y]]) >= least
        i, j = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(i):
            continue
        own, other = own[i], other[j]
        near = near[np.ix_(i, j)]
        near &= ~_met_before(flat, owner, own, other, home)
        n[own] += near @ copies[other].astype(np.float64)
        n[other] += copies[own].astype(np.float64) @ near
        x, y = np.nonzero(near)
        root = _merge(root, own[x], other[y])
    return n, root


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """Links between vectors of cosine `least` or more that share a leaf: vec_id, n_links, component_id, kept.

    In a leaf all pairs are compared in double precision; so are those of a dense node, which
    is not split, block by block. A pair that several leaves hold is counted in the first
    of them only, which both vectors' leaf lists tell, so counts are sums and no pair is
    ever sent; for components each leaf sends the least member of each vector's class.
    Copies of one vector are one point with a count.

    Defined cases: null, empty and zero vectors and those with null or non-finite
    components link with nothing; vectors of different lengths never link, those of each
    length are compared among themselves; a cosine within 1e-9 of `least` is summed anew in
    one order, so ties do not depend on blocks; repeated rows are copies of one vector; a
    null id stays null and is no component's name where there is another; an empty table
    gives an empty result; labels and other columns are not read.
    """
    members, points = distinct_vectors(rows, id_col, vector_col)
    leaves = forest_leaves(points, trees, leaf, spill, least=least)
    # every leaf of a vector, in order: a few dozen numbers
    homes = leaves.groupBy("rep").agg(F.array_sort(F.collect_list("node")).alias("homes"))
    dense = leaves.where("dense").groupBy("node").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / (BLOCK_LEAVES * leaf))).cast("int").alias("blocks"))
    full = points.select("rep", "u", "copies").join(homes, "rep").withColumn("node", F.explode("homes"))
    full = full.join(storage.small(storage.cut(dense, "dense"), 16), "node", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    # a dense node's vectors go to all pairs of blocks that theirs is in
    block = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int")
    full = full.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    full = full.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))

    def compare(table: pa.Table) -> pa.Table:
        u = _unit(table.column("u"))
        rep, copies, block = (table.column(c).to_numpy() for c in ("rep", "copies", "block"))
        home = table.column("node")[0].as_py()
        lists = table.column("homes").combine_chunks()
        flat, cuts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        n, root = links_of(u, copies, flat, cuts, np.flatnonzero(block == x), np.flatnonzero(block == y), home, least)
        has, far = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(u)))
        return pa.table({
            "rep": pa.array(np.concatenate([rep[has], rep[far]]), pa.int64()), "n": pa.array(np.concatenate([n[has].astype(np.int64), np.zeros(len(far), np.int64)]), pa.int64()),
            "to": pa.array([*[None] * len(has), *rep[root[far]].tolist()], pa.int64()),
        })

    links = full.select("node", "x", "y", "rep", "u", "copies", "block", "homes").groupBy("node", "x", "y").applyInArrow(compare, "rep long, n long, to long")
    links = storage.cut(links, "links")
    found = components.connected(links.where("to IS NOT NULL").select(F.col("rep").alias("a"), F.col("to").alias("b")))
    totals = links.groupBy("rep").agg(F.sum("n").alias("far"))
    least_id = members.where("rep IS NOT NULL").groupBy("rep").agg(F.min("vec_id").alias("least"), F.max("copies").alias("copies"))
    points = least_id.join(found, F.col("rep") == F.col("id"), "left").withColumn("comp", F.coalesce("component", "rep")).drop("id", "component").join(totals, "rep", "left")
    points = storage.cut(points, "points")
    names = points.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = points.join(names, "comp").select("rep", "component_id", (F.coalesce("far", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = members.select("vec_id", "rep").join(known, "rep", "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"))
