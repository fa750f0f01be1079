"""N-gram Jaccard join by vertical partitioning, and the groups that its links make."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as bl
from . import bytewords as bw
from . import components, sketch, storage

#: Words of a shingle and the least Jaccard similarity in percent, unless told otherwise.
SHINGLE, PERCENT = 5, 80
#: Pieces that the global order of shingles is cut into.
FRAGMENTS = 4
#: Star rounds go on while the pairs that are left are more than so many for each prefix entry, and fall to this share in a round.
PAIRS_EACH, SHRINKS = 4, 0.7
#: Bits of a key for the hash, below those of the estimated count.
_HASH_BITS = 51


def shingle_sets(data: np.ndarray, borders: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, documents) of the distinct shingles of each document, sorted by document and hash.

    A document of fewer words than a shingle has one: all its words. One without words has none.
    """
    starts, ends, first = bw.word_spans(data, borders)
    words = bw.span_hashes(data, starts, ends)
    hashes, at = bw.window_hashes(words, first, size)
    doc = np.searchsorted(first, at, "right") - 1
    n_words = np.diff(first)
    for m in range(1, size):
        short = np.flatnonzero(n_words == m)
        if len(short):
            whole = np.full(len(short), m, np.uint64)
            for j in range(m):
                whole = bw.mix(whole * np.uint64(0x9E3779B97F4A7C15) + words[first[short] + j])
            hashes, doc = np.append(hashes, whole), np.append(doc, short)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    if len(hashes):
        fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1]))
        hashes, doc = hashes[fresh], doc[fresh]
    return hashes, doc


def _source(size: int, id_at: int, text_at: int):
    def source(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, object]]:
        data, borders = bw.buffers(batch.column(text_at).cast(pa.large_string()))
        data = bw.lower_ascii(data)
        ids = batch.column(id_at).cast(pa.int64())
        for lo, hi in bw.slices(borders):
            hashes, doc = shingle_sets(data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo], size)
            yield hashes, (ids.slice(lo, hi - lo), doc)

    return source


def _order_keys(hashes: np.ndarray, estimate: np.ndarray) -> np.ndarray:
    """Positive numbers that sort by count, then by hash: counts below 64 are told apart, larger ones to 1.6 %."""
    part, power = np.frexp(estimate.astype(np.float64))
    code = (power.astype(np.uint64) << np.uint64(6)) | ((part - 0.5) * 128).astype(np.uint64)
    return ((code << np.uint64(_HASH_BITS)) | (hashes >> np.uint64(64 - _HASH_BITS))).view(np.int64)


def ordered_sets(blocks: bl.Blocks, size: int, percent: int, id_at: int = 0, text_at: int = 1) -> DataFrame:
    """Of every document its set's size and 128-bit hash, and in the global order the shingles that others may have.

    The global order is by estimated count, then hash. Shingles that the count-min sketch
    puts at one are no other document's; where they are so many that the rest is less
    than `percent` of the set, nothing can be similar, and `keys` is null.
    """
    plan = sketch.Plan(blocks.bytes // sketch.HASH_BYTES, top=(1 << 32) - 1)
    answers = sketch.counted(blocks, _source(size, id_at, text_at), plan)

    def sets(block: int, batch: pa.RecordBatch, found: pa.Table) -> pa.Table:
        at, out = block << bl.ROW_BITS, []
        for hashes, estimate, (ids, doc) in sketch.estimated(batch, _source(size, id_at, text_at), plan, found):
            n_docs = len(ids)
            node = np.arange(at, at + n_docs)
            at += n_docs
            n = np.bincount(doc, minlength=n_docs)
            first = np.concatenate([[0], np.cumsum(n)])
            sums = []
            for salt in (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93):
                total = np.zeros(len(hashes) + 1, np.uint64)
                np.cumsum(bw.mix(hashes ^ np.uint64(salt)), out=total[1:])
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            shared = estimate >= 2
            n_shared = np.bincount(doc[shared], minlength=n_docs)
            alive = (n > 0) & (100 * n_shared >= percent * n)
            pick = shared & alive[doc]
            keys = _order_keys(hashes[pick], estimate[pick])
            order = np.lexsort((keys, doc[pick]))
            borders = np.concatenate([[0], np.cumsum(np.where(alive, n_shared, 0))])
            lists = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(keys[order]), mask=pa.array(~alive))
            out.append(pa.RecordBatch.from_arrays([ids, pa.array(node), pa.array(n, pa.int64()), pa.array(sums[0]), pa.array(sums[1]), lists], names=["doc_id", "node", "n", "h1", "h2", "keys"]))
        return pa.Table.from_batches(out)

    return storage.cut(bl.together(blocks, answers, sets, "doc_id long, node long, n long, h1 long, h2 long, keys array<long>"), "sets")


def _least_overlap(na: Column, nb: Column, percent: int) -> Column:
    """Shingles that sets of these sizes must share."""
    return F.ceil(F.lit(percent) * (na + nb) / F.lit(100 + percent))


def _cuts(sets: DataFrame) -> list[int]:
    """Inner borders of the fragments: quantiles of the global order, from a few keys of each set."""
    picks = F.array(*[F.element_at("keys", F.greatest(F.lit(1), F.ceil(F.size("keys") * q)).cast("int")) for q in (0.125, 0.375, 0.625, 0.875)])
    inner = [i / FRAGMENTS for i in range(1, FRAGMENTS)]
    found = sets.select(F.explode(picks).alias("k")).agg(F.percentile_approx("k", inner, 1000).alias("q")).first()["q"]
    return sorted(set(found or []))


def _fragments(sets: DataFrame, cuts: list[int]) -> DataFrame:
    """(node, fragment, piece): every set cut at the same borders of the global order."""
    low, high = [None, *cuts], [*cuts, None]

    def piece(lo, hi):
        def inside(x):
            ok = F.lit(True)
            if lo is not None:
                ok = ok & (x >= F.lit(lo))
            if hi is not None:
                ok = ok & (x < F.lit(hi))
            return ok

        return F.filter("keys", inside)

    pieces = F.array(*[piece(a, b) for a, b in zip(low, high)])
    return sets.select("node", F.posexplode(pieces).alias("fragment", "piece")).where(F.size("piece") > 0)


def _linked(pairs: DataFrame, sets: DataFrame, fragments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose partial overlaps, counted in each fragment and summed, are enough."""
    fa = fragments.select(F.col("node").alias("a"), "fragment", F.col("piece").alias("pa"))
    fb = fragments.select(F.col("node").alias("b"), "fragment", F.col("piece").alias("pb"))
    partial = pairs.join(fa, "a").join(fb, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).cast("long").alias("x"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("x").alias("x"))
    return total.where(100 * F.col("x") >= percent * (F.col("na") + F.col("nb") - F.col("x"))).select("a", "b")


def similar_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between distinct sets that join exactly the sets that all links join.

    Two sets that are similar share a shingle among the first of each in the global order,
    and after the first such shingle both have enough left (prefix and position filters).
    Each shingle's group is first compared with one member, the one with the fewest rarer
    shingles, which joins near copies of one text in a linear number of pairs. While much is
    left, one of the members still apart is compared with the others, again and again. Of
    what then is apart, all pairs of a group are compared, but for those that are joined
    already and those that the filters rule out; so no link between groups is lost.
    """
    ahead = F.col("n") - F.size("keys")
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / 100) + 1 - ahead
    tokens = (
        sets.where(prefix > 0)
        .select("node", "n", ahead.alias("s"), F.posexplode(F.slice("keys", F.lit(1), F.least(prefix, F.size("keys").cast("long")).cast("int"))).alias("p", "k"))
        .select("k", "node", "n", (F.col("s") + F.col("p")).alias("pos"))
    )
    tokens = storage.cut(tokens, "tokens")
    groups = tokens.groupBy("k").agg(F.count("*").alias("c"), F.min("n").alias("least")).where("c > 1")
    most = F.col("n") - F.col("pos")
    partner = F.greatest(F.col("least"), F.ceil(F.col("n") * F.lit(percent) / 100))
    tokens2 = tokens.join(groups, "k").where(most >= _least_overlap(F.col("n"), partner, percent)).select("k", "node", "n", "pos")
    tokens2 = storage.cut(tokens2, "tokens")
    storage.drop_cut(tokens)
    n_tokens = tokens2.count()
    fragments = _fragments(sets, _cuts(sets))

    def enough(na, pa_, nb, pb):
        return F.least(F.col(na) - F.col(pa_), F.col(nb) - F.col(pb)) >= _least_overlap(F.col(na), F.col(nb), percent)

    def verified(found: DataFrame) -> DataFrame:
        pairs = storage.cut(found.distinct(), "pairs")
        out = storage.cut(_linked(pairs, sets, fragments, percent), "links")
        storage.drop_cut(pairs)
        return out

    # of each group the members by class; at first every member is one of its own
    marked, edges, before = storage.cut(tokens2.withColumn("comp", F.col("node")), "marked"), None, None
    while True:
        centre = F.min(F.struct("pos", "node", "n", "comp")).alias("m")
        # the first round's centre is of the class that all others are held against; later ones are of other classes
        own = marked if edges is None else marked.where("apart")
        centres = own.groupBy("k").agg(centre).select("k", F.col("m.node").alias("cn"), F.col("m.n").alias("csize"), F.col("m.pos").alias("cpos"), F.col("m.comp").alias("ccomp"))
        centres = storage.cut(centres, "centres")
        starred = marked.join(centres, "k").where((F.col("comp") != F.col("ccomp")) & enough("n", "pos", "csize", "cpos"))
        found = verified(starred.select(F.least("cn", "node").alias("a"), F.greatest("cn", "node").alias("b"), F.when(F.col("cn") < F.col("node"), F.col("csize")).otherwise(F.col("n")).alias("na"), F.when(F.col("cn") < F.col("node"), F.col("n")).otherwise(F.col("csize")).alias("nb")))
        first = centres.select("k", F.col("cn").alias("first")) if edges is None else marked.select("k", "first").distinct()
        edges = found if edges is None else storage.cut(edges.unionByName(found), "links")
        reached = components.connected(edges)
        joined = storage.cut(reached, "joined")
        storage.drop_cut(reached)
        classes = tokens2.join(joined, F.col("node") == F.col("id"), "left").select("k", "node", "n", "pos", F.coalesce("component", "node").alias("comp"))
        lead = first.join(joined, F.col("first") == F.col("id"), "left").select(F.col("k").alias("fk"), "first", F.coalesce("component", "first").alias("fcomp"))
        after = storage.cut(classes.join(lead, F.col("k") == F.col("fk")).withColumn("apart", F.col("comp") != F.col("fcomp")).drop("fk", "fcomp"), "marked")
        for x in (marked, centres, joined):
            storage.drop_cut(x)
        marked = after
        sizes = marked.groupBy("k", "comp").agg(F.count("*").cast("double").alias("c")).groupBy("k").agg((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))).alias("p"))
        left = (sizes.agg(F.sum("p")).first()[0] or 0.0) / 2
        if left <= PAIRS_EACH * n_tokens or (before is not None and left > SHRINKS * before):
            break
        before = left
    apart = marked.where("apart").select("k", *[F.col(c).alias("l_" + c) for c in ("node", "n", "pos", "comp")])
    rest = apart.join(marked, "k").where((F.col("l_comp") != F.col("comp")) & (~F.col("apart") | (F.col("l_node") < F.col("node"))) & enough("l_n", "l_pos", "n", "pos"))
    rest = verified(rest.select(F.col("l_node").alias("a"), F.col("node").alias("b"), F.col("l_n").alias("na"), F.col("n").alias("nb")))
    out = storage.cut(edges.unionByName(rest), "links")
    for x in (edges, rest, marked, tokens2):
        storage.drop_cut(x)
    return out


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Groups of documents that links join: doc_id, node, n_shingles, component_id and leader.

    Texts are lower-cased in A-Z and cut into words; a set holds the distinct runs of
    `size` words. Two documents link when 100 * intersection >= percent * union.
    component_id is the smallest id reachable; leader marks one row of each group, of
    the smallest id; node is the row's number. docs is read once, into blocks; all passes
    work on these, so any DataFrame will do and its partitions may change meanwhile.

    Defined cases: a text of fewer words than a shingle is one shingle; null and empty
    texts have no set and link with nothing; equal sets, repeated rows too, are one node
    from the start and are not paired; rows that share an id are separate rows of one
    result; a row without an id links like any other and its group's id is the smallest
    that is not null; a very long text is a block of its own, held whole by one task at a
    time; an empty table gives an empty result; other columns are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = bl.write(own)
    out = groups_of(blocks, size, percent)
    blocks.drop()
    return out


def groups_of(blocks: bl.Blocks, size: int, percent: int, id_at: int = 0, text_at: int = 1) -> DataFrame:
    """jaccard_groups of a corpus in blocks, whose columns id_at and text_at are ids and texts."""
    rows = ordered_sets(blocks, size, percent, id_at, text_at)
    alive = rows.where("keys IS NOT NULL")
    same = alive.groupBy("h1", "h2", "n").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("m"))
    same = storage.cut(same.select("h1", "h2", "n", F.col("m.node").alias("rep"), F.col("m.doc_id").alias("rep_id")), "same")
    sets = storage.cut(alive.join(same.select(F.col("rep").alias("node")), "node", "left_semi").select("node", "n", "keys"), "sets")
    links = similar_pairs(sets, percent)
    reached = components.connected(links)
    found = storage.cut(reached, "components")
    storage.drop_cut(reached)
    ids = same.join(found, F.col("rep") == F.col("id"), "left").withColumn("comp", F.coalesce("component", "rep"))
    ids = storage.cut(ids.select("h1", "h2", "n", "rep", "rep_id", "comp"), "ids")
    for x in (same, sets, links, found):
        storage.drop_cut(x)
    least = ids.groupBy("comp").agg(F.min(F.struct(F.col("rep_id").isNull().alias("none"), F.col("rep_id"), F.col("rep"))).alias("m"))
    least = storage.cut(least.select("comp", F.col("m.rep_id").alias("component_id"), F.col("m.rep").alias("lead")), "least")
    by_set = storage.cut(ids.join(least, "comp").select("h1", "h2", "n", "component_id", "lead"), "groups")
    storage.drop_cut(ids)
    storage.drop_cut(least)
    near = alive.select("doc_id", "node", "n", "h1", "h2").join(by_set, ["h1", "h2", "n"]).select("doc_id", "node", F.col("n").alias("n_shingles"), "component_id", (F.col("node") == F.col("lead")).alias("leader"))
    far = rows.where("keys IS NULL").select("doc_id", "node", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("leader"))
    return near.unionByName(far)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each group of jaccard_groups, its leader; all columns are kept.

    docs is read once, with all columns, into blocks; the rows that go are dealt to their
    blocks by number and texts are not dealt at all. Cases as in jaccard_groups.
    """
    blocks = bl.write(docs)
    groups = groups_of(blocks, size, percent, docs.columns.index(id_col), docs.columns.index(text_col))
    gone = groups.where("NOT leader").select(F.shiftright("node", bl.ROW_BITS).alias("block"), F.col("node").bitwiseAND(F.lit((1 << bl.ROW_BITS) - 1)).alias("__row"))

    def rest(block: int, batch: pa.RecordBatch, found: pa.Table) -> pa.Table:
        keep = np.ones(batch.num_rows, bool)
        keep[found.column("__row").to_numpy()] = False
        return pa.Table.from_batches([batch.filter(pa.array(keep))])

    return bl.together(blocks, gone, rest, docs.schema)
