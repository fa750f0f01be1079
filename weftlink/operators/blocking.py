"""Candidate pairs: guarded joins on blocking keys, and top-k joins on n-gram cosine."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import tables

#: Score columns of merged candidates, and the text views that are compared.
SCORES = ["tfidf_name", "tfidf_name_addr", "embed_cos"]
VIEWS = {"name": ["name_core"], "name_addr": ["name_core", "addr_norm"]}
#: Records of a block of one side, about; sums of pairs, and products, that a task holds at once.
BLOCK, CELLS = 12_000, 4 << 20


def key_columns(same_country: bool = True) -> list[Column]:
    """Up to seven blocking keys of a normalized record, null where a part is missing.

    Postcode with each of the two longest words of the name, each of the first three
    localities with the name's first four letters, sound code with the last of those
    localities, and house number with street. Repeated keys are not merged: they count.
    """
    country = F.col("country") if same_country else F.lit("*")
    tokens = F.filter(F.split("name_core", " "), lambda t: t != "")
    # longest first; words of one length keep their order
    ranked = F.transform(
        F.array_sort(F.transform(tokens, lambda t, i: F.struct((-F.length(t)).alias("n"), i.alias("i"), t.alias("t")))), lambda s: s["t"]
    )
    places = F.slice(F.filter(F.split("localities", "[|]"), lambda x: x != ""), 1, 3)
    prefix = F.left(F.replace(F.col("name_core"), F.lit(" "), F.lit("")), F.lit(4))

    def key(kind: str, *parts: Column) -> Column:
        ok = reduce(lambda a, b: a & b, [F.coalesce(p != "", F.lit(False)) for p in parts])
        return F.when(ok, F.concat_ws("|", F.lit(kind), country, *parts))

    keys = [key("pc", F.col("postcode"), F.try_element_at(ranked, F.lit(i))) for i in (1, 2)]
    keys += [key("loc", F.try_element_at(places, F.lit(i)), prefix) for i in (1, 2, 3)]
    keys.append(key("ph", F.col("name_key"), F.try_element_at(places, F.lit(-1))))
    keys.append(key("hn", F.col("house_no"), F.col("street_tok")))
    return keys


def record_keys(records: DataFrame, same_country: bool = True, id_col: str = "idx") -> DataFrame:
    """(id, key): one row for each key of each record."""
    return records.select(id_col, F.explode(F.array_compact(F.array(*key_columns(same_country)))).alias("key"))


def join_keys(left: DataFrame, right: DataFrame, max_block_pairs: int, id_col: str = "idx") -> DataFrame:
    """(l_idx, r_idx, from_keys): pairs that share a key of at most max_block_pairs pairs, repeated keys counted.

    Counts are aggregated once for both sides by one grouping over their union; the guard
    bounds every block, so the join's output grows with the number of blocks.
    """
    both = left.select("key", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select("key", F.lit(0).alias("l"), F.lit(1).alias("r")))
    counts = both.groupBy("key").agg(F.sum("l").cast("long").alias("nl"), F.sum("r").cast("long").alias("nr"))
    fine = counts.where((F.col("nl") > 0) & (F.col("nr") > 0) & (F.col("nl") * F.col("nr") <= max_block_pairs)).select("key")
    lk = left.join(fine, "key", "left_semi").select("key", F.col(id_col).alias("l_idx")).distinct()
    rk = right.join(fine, "key", "left_semi").select("key", F.col(id_col).alias("r_idx")).distinct()
    return lk.join(rk, "key").select("l_idx", "r_idx").distinct().withColumn("from_keys", F.lit(True))


def char_grams(c: Column, n: int = 3) -> Column:
    """n-grams of every word with a space before and after; a shorter padded word is one gram."""
    padded = F.transform(F.filter(F.split(c, r"\s+"), lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams(w):
        last = F.greatest(F.length(w) - n + 1, F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(w, i, n))

    return F.flatten(F.transform(padded, grams))


def word_grams(c: Column) -> Column:
    """Words as they stand between white space."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def tfidf_weights(docs: DataFrame, grams: Column, by: list[str], ids: list[str], min_df: int = 1, max_df: float = 1.0, fit: DataFrame | None = None, or_all: bool = False) -> DataFrame:
    """(by, ids, gram, w): L2-normed weights (1 + ln tf) * (1 + ln((1 + N) / (1 + df))) inside each group.

    Grams in fewer than min_df or more than max_df * N documents do not count; a group
    whose max_df * N is under min_df has none. N and df are those of fit, some of docs, if
    it is given, else of docs; grams that fit lacks do not count. With or_all a group in
    which no gram comes min_df times has all its grams.
    """
    tf = docs.select(*by, *ids, F.explode(grams).alias("gram")).groupBy(*by, *ids, "gram").agg(F.count("*").alias("tf"))
    seen = tf if fit is None else fit.select(*by, *ids, F.explode(grams).alias("gram")).distinct()
    # counted by a column of tf, so that both uses of it have the same columns and one exchange serves both
    df = seen.groupBy(*by, "gram").agg(F.count("*" if fit is not None else F.when(F.col("tf") > 0, 1)).alias("df"))
    total = (docs if fit is None else fit).groupBy(*by).agg(F.count("*").alias("n"))
    fine = df.join(F.broadcast(total) if not by else total, by) if by else df.crossJoin(F.broadcast(total))  # one row without groups
    fine = fine.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * F.col("n")) & (F.lit(max_df) * F.col("n") >= min_df))
    if or_all:
        top = df.groupBy(*by).agg(F.max("df").alias("top")).where(F.col("top") < min_df).select(*by)
        fine = fine.unionByName(df.join(total, by).join(top, by, "left_semi"))
    idf = fine.select(*by, "gram", (1 + F.log((1 + F.col("n")) / (1 + F.col("df")))).alias("idf"))
    raw = tf.join(idf, [*by, "gram"]).select(*by, *ids, "gram", ((1 + F.log("tf")) * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*by, *ids)))
    return raw.withColumn("w", F.col("w") / norm)


def tfidf_candidates(
    left: DataFrame, right: DataFrame, score: str, text_col: str = "_text", country_col: str = "country",
    ngram: int = 3, min_df: int = 2, max_df: float = 0.02, k_forward: int = 40, k_reverse: int = 3, threshold: float = 0.3, same_country: bool = True,
) -> DataFrame:
    """(l_idx, r_idx, score): for each left record its best right ones above the threshold, and the other way.

    An inverted index: gram weights of both sides meet on (country, gram), max_df bounding
    every posting list, and products are summed by pair. Records are dealt to blocks, and
    each two blocks of one country meet once in one task, which sums their products in its
    memory and sends on only its best rows: the products, which grow with the square of the
    records, are neither dealt nor written. Ranks are by score, then the other side's id.
    """
    country = F.coalesce(F.col(country_col), F.lit("")) if same_country else F.lit("*")
    both = left.select(F.lit("l").alias("side"), F.col("idx"), country.alias("country"), F.col(text_col).alias("text")).unionByName(
        right.select(F.lit("r").alias("side"), F.col("idx"), country.alias("country"), F.col(text_col).alias("text"))
    )
    weights = tfidf_weights(both, char_grams(F.col("text"), ngram), ["country"], ["side", "idx"], min_df, max_df)
    listed = F.sort_array(F.collect_list(F.struct("gram", "w")))  # sums in one order, whatever the tasks
    vectors = tables.written(weights.groupBy("country", "side", "idx").agg(listed.alias("v")).select("country", "side", "idx", F.col("v.gram").alias("grams"), F.col("v.w").alias("w")))
    blocks = lambda side: F.greatest(F.lit(1), F.ceil(F.count_if(F.col("side") == side) / BLOCK)).cast("int")
    sizes = vectors.groupBy("country").agg(blocks("l").alias("ln"), blocks("r").alias("rn"))
    dealt = vectors.join(sizes, "country").withColumn("is_left", F.col("side") == "l")
    own = lambda n: F.pmod(F.xxhash64("idx"), F.col(n)).cast("int")
    spots = F.when(F.col("is_left"), F.transform(F.sequence(F.lit(0), F.col("rn") - 1), lambda y: F.struct(own("ln").alias("x"), y.alias("y"))))
    spots = spots.otherwise(F.transform(F.sequence(F.lit(0), F.col("ln") - 1), lambda x: F.struct(x.alias("x"), own("rn").alias("y"))))
    dealt = dealt.select("country", "is_left", "idx", "grams", "w", F.explode(spots).alias("b")).select("country", "b.x", "b.y", "is_left", "idx", "grams", "w")
    kind = both.schema["idx"].dataType.simpleString()

    def best(table: pa.Table) -> pa.Table:
        at = table.column("is_left").to_numpy(zero_copy_only=False)
        sides = [table.filter(pa.array(x)).combine_chunks() for x in (at, ~at)]
        i, j, s = _best_products(*sides, k_forward, k_reverse, threshold)
        return pa.table({"l_idx": sides[0].column("idx").take(pa.array(i)), "r_idx": sides[1].column("idx").take(pa.array(j)), score: pa.array(s, pa.float64())})

    sums = dealt.groupBy("country", "x", "y").applyInArrow(best, f"l_idx {kind}, r_idx {kind}, `{score}` double")
    forward = Window.partitionBy("l_idx").orderBy(F.round(score, 9).desc(), "r_idx")
    reverse = Window.partitionBy("r_idx").orderBy(F.round(score, 9).desc(), "l_idx")
    ranked = sums.withColumn("__f", F.row_number().over(forward)).withColumn("__r", F.row_number().over(reverse))
    return ranked.where((F.col("__f") <= k_forward) | (F.col("__r") <= k_reverse)).drop("__f", "__r")


def _first_of_each(group: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Whether each row is among the first k of its group; order sorts the rows by group first."""
    sorted_ = group[order]
    new = np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(order) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    out = np.zeros(len(order), bool)
    out[order] = rank < k
    return out


def _best_products(left: pa.Table, right: pa.Table, k_forward: int, k_reverse: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, sum of products) of the rows of two blocks (idx, grams, w): the best of each row above the threshold, both ways.

    Some left rows at a time, so that their sums with all right rows, and the products, are
    CELLS at most (one row's, where it alone has more).
    """
    n_l, n_r = left.num_rows, right.num_rows
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not n_l or not n_r:
        return none
    lists = [pc.list_flatten(t.column("grams")) for t in (left, right)]
    codes = pa.chunked_array([c for x in lists for c in x.chunks], pa.string()).combine_chunks().dictionary_encode()
    code = (codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    code_l, code_r = code[: len(lists[0])], code[len(lists[0]) :]
    w_l, w_r = (pc.list_flatten(t.column("w")).to_numpy() for t in (left, right))
    ends = np.cumsum(pc.list_value_length(left.column("grams")).to_numpy())
    row_r = np.repeat(np.arange(n_r), pc.list_value_length(right.column("grams")).to_numpy())
    by_gram = np.argsort(code_r, kind="stable")
    row_r, w_r = row_r[by_gram], w_r[by_gram]
    start = np.searchsorted(code_r[by_gram], np.arange(code.max() + 2))
    n = start[code_l + 1] - start[code_l]
    before = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends])]  # products of the rows before each
    row_l = np.repeat(np.arange(n_l), np.diff(np.concatenate([[0], ends])))
    place_l, place_r = (np.unique(t.column("idx").to_numpy(zero_copy_only=False), return_inverse=True)[1] for t in (left, right))

    def cut(i: np.ndarray, j: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rank = -np.floor(s * 1e9 + 0.5)
        keep = _first_of_each(i, np.lexsort((place_r[j], rank, i)), k_forward) | _first_of_each(j, np.lexsort((place_l[i], rank, j)), k_reverse)
        return i[keep], j[keep], s[keep]

    found, held, lo = [none], 0, 0
    while lo < n_l:
        hi = max(lo + 1, min(n_l, lo + CELLS // n_r, int(np.searchsorted(before, before[lo] + CELLS, "right")) - 1))
        some = slice(ends[lo - 1] if lo else 0, ends[hi - 1])
        m = n[some]
        at = np.repeat(start[code_l[some]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        key = np.repeat((row_l[some] - lo) * n_r, m) + row_r[at]
        sums = np.bincount(key, np.repeat(w_l[some], m) * w_r[at], (hi - lo) * n_r)
        hits = np.flatnonzero(sums > threshold)
        found.append(cut(hits // n_r + lo, hits % n_r, sums[hits]))
        held += len(found[-1][0])
        if held > CELLS:
            found = [cut(*(np.concatenate(x) for x in zip(*found)))]
            held = len(found[0][0]) // 2  # else a block of many rows would be cut at every step
        lo = hi
    return cut(*(np.concatenate(x) for x in zip(*found)))


def map_product(a: Column, b: Column) -> Column:
    """Sum of the products of the values that two maps have under equal keys."""
    common = F.array_intersect(F.map_keys(a), F.map_keys(b))
    return F.aggregate(common, F.lit(0.0), lambda acc, k: acc + F.element_at(a, k) * F.element_at(b, k))


def merge_candidates(frames: list[DataFrame]) -> DataFrame:
    """One row for each pair with its best scores: 0.0 and false where a source does not have it."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    for c in SCORES:
        if c not in every.columns:
            every = every.withColumn(c, F.lit(None).cast("double"))
    if "from_keys" not in every.columns:
        every = every.withColumn("from_keys", F.lit(None).cast("boolean"))
    best = [F.coalesce(F.max(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in SCORES]
    return every.groupBy("l_idx", "r_idx").agg(*best, F.coalesce(F.bool_or("from_keys"), F.lit(False)).alias("from_keys"))


def top_k(df: DataFrame, score: str, k: int, by: str = "l_idx", tie: str = "r_idx") -> DataFrame:
    """The k rows of each group with the highest scores; the engine cuts groups before the shuffle too."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.col(score).desc(), tie))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def vector_candidates(left: DataFrame, right: DataFrame, k_forward: int = 30, k_reverse: int = 3, score: str = "embed_cos", block: int = 2000) -> DataFrame:
    """(l_idx, r_idx, score): exact inner-product neighbours of unit vectors, both ways, inside a country.

    Each side is dealt to blocks of about `block` records and each pair of blocks of one
    country meets once in one task, which sends on only its best rows: exact search is
    quadratic work, but no task's memory or output is.
    """
    import numpy as np
    import pyarrow as pa

    def dealt(df: DataFrame, side: str) -> DataFrame:
        sizes = df.groupBy("country").agg(F.count("*").alias("n"))
        parts = sizes.select(F.col("country"), F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("int").alias(f"{side}n"))
        both = df.join(parts, "country").withColumn(f"{side}b", F.pmod(F.xxhash64("idx"), F.col(f"{side}n")).cast("int"))
        return both

    ln = left.groupBy("country").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("int").alias("o"))
    rn = right.groupBy("country").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("int").alias("o"))
    l = dealt(left, "x").join(rn, "country").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("o") - 1))).select("country", F.col("xb").alias("x"), "y", F.lit(True).alias("is_left"), "idx", "vector")
    r = dealt(right, "x").join(ln, "country").withColumn("x", F.explode(F.sequence(F.lit(0), F.col("o") - 1))).select("country", "x", F.col("xb").alias("y"), F.lit(False).alias("is_left"), "idx", "vector")

    def best(table: pa.Table) -> pa.Table:
        side = table.column("is_left").to_numpy(zero_copy_only=False)
        idx = table.column("idx").to_numpy()
        vectors = np.array(table.column("vector").to_pylist(), np.float64)
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        if not len(a) or not len(b):
            return pa.table({"l_idx": pa.array([], pa.int64()), "r_idx": pa.array([], pa.int64()), score: pa.array([], pa.float64())})
        s = vectors[a] @ vectors[b].T
        keep = np.zeros(s.shape, bool)
        f, v = min(k_forward, len(b)), min(k_reverse, len(a))
        # ties at the cut stay: the ranks over all blocks decide by id
        keep |= s >= -np.partition(-s, f - 1, axis=1)[:, f - 1 : f]
        keep |= s >= -np.partition(-s, v - 1, axis=0)[v - 1 : v, :]
        i, j = np.nonzero(keep)
        return pa.table({"l_idx": pa.array(idx[a[i]], pa.int64()), "r_idx": pa.array(idx[b[j]], pa.int64()), score: pa.array(s[i, j])})

    found = l.unionByName(r).groupBy("country", "x", "y").applyInArrow(best, f"l_idx long, r_idx long, {score} double")
    forward = Window.partitionBy("l_idx").orderBy(F.round(score, 9).desc(), "r_idx")
    reverse = Window.partitionBy("r_idx").orderBy(F.round(score, 9).desc(), "l_idx")
    ranked = found.withColumn("__f", F.row_number().over(forward)).withColumn("__r", F.row_number().over(reverse))
    return ranked.where((F.col("__f") <= k_forward) | (F.col("__r") <= k_reverse)).drop("__f", "__r")


def indexed_vector_candidates(
    left: DataFrame, right: DataFrame, k_forward: int = 30, k_reverse: int = 3, score: str = "embed_cos", cells: int = 256, probes: int = 16, rows_per_cell: int = 64, seed: int = 7
) -> DataFrame:
    """vector_candidates over an index of cells: each right record is in the cell of its nearest centre, each left one looks into `probes` cells.

    Centres come from a hash sample of at most cells * rows_per_cell right vectors by a few
    rounds of spherical k-means on the driver; they are `cells` vectors, whatever the input.
    Every record is indexed. Work is about probes / cells of the exact search's; cells of
    many records are compared block by block as countries are there. With probes = cells
    the result is exact.
    """
    import numpy as np
    import pyarrow as pa

    drawn = right.orderBy(F.xxhash64(F.lit(seed), "idx"), "idx").limit(cells * rows_per_cell).select("vector").collect()  # bounded by the parameters
    if not drawn:
        return vector_candidates(left, right, k_forward, k_reverse, score)
    sample = np.array([r["vector"] for r in drawn], np.float64)
    centres = sample[: min(cells, len(sample))]
    for _ in range(8):
        nearest = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-300), centres)
    n = len(centres)

    def near(df: DataFrame, most: int) -> DataFrame:
        def assign(batches):
            for batch in batches:
                v = np.array(batch.column(2).to_pylist(), np.float64).reshape(len(batch), -1)
                order = np.argsort(-(v @ centres.T), axis=1, kind="stable")[:, :most].astype(np.int32)
                at = pa.array(np.repeat(np.arange(len(batch)), order.shape[1]))
                yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns], pa.array(order.ravel())], names=["idx", "country", "vector", "cell"])

        kind = df.schema["idx"].dataType.simpleString()
        rows = df.select("idx", F.col("country").cast("string").alias("country"), F.col("vector").cast("array<double>").alias("vector"))
        out = rows.mapInArrow(assign, f"idx {kind}, country string, vector array<double>, cell int")
        return out.select("idx", F.concat_ws("/", F.coalesce("country", F.lit("")), F.col("cell").cast("string")).alias("country"), "vector")

    return vector_candidates(near(left, min(probes, n)), near(right, 1), k_forward, k_reverse, score)
