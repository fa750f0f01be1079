"""Near-duplicate lines by a segment-partition edit join, in DataFrame expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import components, storage

#: Shorter lines (in code points) link with equal ones only: below it the edit join has not three characters a segment.
MIN_CHARS = 9
#: Edits between linked lines.
MAX_EDITS = 2
#: Lines that hold more than one in so many of all lines are looked up once for all their copies; there are no more of them than this.
HEAVY = 50_000
#: Bytes of a code point in the encoding that keys are cut from: there, a place needs no counting.
_WIDTH = 4
#: Letters counted together, a byte lane of the signature each.
_LANES = ("eéèê", "aáäà", "oóöí", "tñl", "nm", "sßc", "ruüd", "ihp")


def places(edits: int) -> list[tuple[int, int, int, bool]]:
    """(segment, characters less, shift, own): where a line looks for the segments of lines of its length and up to `edits` less.

    Of each of these lengths and segments it tries only the places that an alignment with at
    most i edits before segment i and edits - i after it allows; those of its own segments,
    which are what others find it by, are among them.
    """
    return [
        (i, less, shift, less == 0 and shift == 0)
        for less in range(edits + 1) for i in range(edits + 1) for shift in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1)
    ]


def _keys(lines: DataFrame, edits: int, own_only: bool) -> DataFrame:
    """(id, own, key) rows of lines (id, line, length): the index's if own_only, else the probes.

    A line is cut into edits + 1 even segments, longer ones last. Places are exploded from a
    constant table, so that one short expression makes all keys and stays compiled.
    """
    table = [p for p in places(edits) if p[3] or not own_only]
    spots = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("i", "less", "shift", "own"), p)]) for p in table])
    x = lines.select("id", F.encode("line", "UTF-32").alias("wide"), "length", F.explode(spots).alias("p"))
    n, m, i = edits + 1, F.col("length") - F.col("p.less"), F.col("p.i")
    base = ((m - m % n) / n).cast("int")
    short = F.lit(n) - m % n  # so many segments of the base length come first
    start = i * base + F.greatest(F.lit(0), i - short) + F.col("p.shift")
    size = base + (i >= short).cast("int")
    return x.select("id", F.col("p.own").alias("own"), F.xxhash64(i, m, F.substring("wide", start * _WIDTH + 1, size * _WIDTH)).alias("key"))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, th, pos, line, length, id, id2): lines of min_chars and shorter ones that are not blank.

    th tells texts of one doc_id apart; id and id2 are two hashes of the line, which together name it.
    """
    split = F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    every = docs.select("doc_id", F.xxhash64("text").alias("th"), split).withColumn("length", F.length("line"))
    every = every.where((F.col("length") >= min_chars) | F.col("line").rlike(r"\S"))
    return every.withColumns({"id": F.xxhash64("line"), "id2": F.xxhash64(F.lit(1), "line")})


def _signature(line: Column) -> Column:
    """Counts of eight groups of letters, modulo 256, in the bytes of a long; all are taken on the lower-case line, which may be longer."""
    low = F.lower(line)
    lanes = [(F.length(low) - F.length(F.translate(low, letters, ""))) % 256 for letters in _LANES]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(x.cast("long"), 8 * i) for i, x in enumerate(lanes)])


def _may_be_near(a: Column, b: Column, edits: int) -> Column:
    """False only if signatures differ so that more than `edits` edits lie between: each adds and takes one letter at most.

    Lanes go round at 256, so a difference is the one of -128..127 that fits; a greater one is none that `edits` edits make.
    """
    more, less = [], []
    for i in range(len(_LANES)):
        d = F.shiftrightunsigned(a, 8 * i).bitwiseAND(F.lit(255)) - F.shiftrightunsigned(b, 8 * i).bitwiseAND(F.lit(255))
        d = (d + 128).bitwiseAND(F.lit(255)) - 128
        more.append(F.greatest(d, F.lit(0)))
        less.append(F.greatest(-d, F.lit(0)))
    return (reduce(lambda x, y: x + y, more) <= edits) & (reduce(lambda x, y: x + y, less) <= edits)


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "pos")


def repeated_lines(seen: DataFrame) -> DataFrame:
    """(id, id2, first, c): lines that come more than once, with their first place and number, from (doc_id, th, pos, id, id2) rows."""
    return seen.groupBy("id", "id2").agg(F.min(_place()).alias("first"), F.count("*").alias("c")).where("c > 1")


def near_lines(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = MAX_EDITS, heavy: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(texts, edges): edges (a, b) join the nodes of texts (id, id2, node, line) with at most `edits` edits between them, directly or in steps.

    The index holds of every segment key the least line that has it, by partial aggregates,
    so that it has a row for each key however many lines share it. Every line probes it; a
    find is a row that joins the line to that one centre. These pairs are verified first.
    Only where a group still falls into classes are the lines that are not in their
    centre's class compared with the others of their group, the signatures of letter counts
    ruling most out inside the join. Equal lines are one node, so no pair of them is made.
    Verified are pairs by the banded edit distance of the engine.

    heavy (id, id2, first), if given, names lines of which the first place alone is looked
    up; it is broadcast, so its rows must be bounded. Every edit within reach is found,
    but edges inside a class that others join already are left out. Null and empty texts
    and an empty table give empty tables; repeated rows and lines change nothing.
    """
    if min_chars < 3 * (edits + 1):
        raise ValueError("lines need three characters a segment")
    lines = _lines(docs, min_chars).where(F.col("length") >= min_chars)
    asked = lines
    if heavy is not None:
        once = F.broadcast(heavy.select(F.col("id").alias("hid"), F.col("id2").alias("hid2"), "first"))
        asked = lines.join(once, (F.col("id") == F.col("hid")) & (F.col("id2") == F.col("hid2")), "left").where(F.col("first").isNull() | (F.col("first") == _place()))
    asked = asked.select("id", "line", "length")
    # written, so that the join is between plain exchanges: a key that very many lines probe is split by adaptive execution
    index = storage.cut(_keys(asked, edits, True).groupBy("key").agg(F.min("id").alias("centre")), "index")
    probes = _keys(asked, edits, False)
    finds = probes.join(index, "key").where("id <> centre")
    finds = storage.cut(finds.groupBy("key", "id", "centre").agg(F.max("own").alias("own")), "finds")
    storage.drop_cut(index)
    ids = finds.select("id").unionByName(finds.select(F.col("centre").alias("id"))).distinct()
    ids = storage.cut(ids, "ids")
    texts = lines.select("id", "id2", "line").join(storage.small(ids, 16), "id").dropDuplicates(["id", "id2"])
    texts = storage.cut(texts.withColumns({"sig": _signature(F.col("line")), "node": F.monotonically_increasing_id()}), "texts")
    storage.drop_cut(ids)

    def verified(pairs: DataFrame) -> DataFrame:
        side = lambda s: texts.select(F.col("node").alias(s), F.col("line").alias(f"l{s}"))
        near = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(F.levenshtein("la", "lb", edits) >= 0)
        return storage.cut(near.select("a", "b"), "near")

    named = texts.select("id", "node", "sig")
    member = storage.cut(
        finds.select("key", "id", "own").unionByName(finds.select("key", F.col("centre").alias("id"), F.lit(True).alias("own")).distinct()).join(named, "id").select("key", "node", "sig", "own"), "members"
    )
    centre = finds.select("key", F.col("centre").alias("id")).distinct().join(named, "id").select("key", F.col("node").alias("c"), F.col("sig").alias("csig"))
    centre = storage.cut(centre, "centres")
    starred = member.join(centre, "key").where((F.col("node") != F.col("c")) & _may_be_near(F.col("sig"), F.col("csig"), edits))
    edges = verified(starred.select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")))
    reached = components.connected(edges, native=True)
    classes = storage.cut(reached, "classes")
    storage.drop_cut(reached)
    of = classes.select(F.col("id").alias("cid"), "component")
    member2 = member.join(of, F.col("node") == F.col("cid"), "left").withColumn("class", F.coalesce("component", "node")).drop("cid", "component")
    lead = centre.join(of, F.col("c") == F.col("cid"), "left").groupBy(F.col("key").alias("k")).agg(F.min(F.coalesce("component", "c")).alias("lead"))
    marked = storage.cut(member2.join(lead, F.col("key") == F.col("k")).withColumn("apart", F.col("class") != F.col("lead")).drop("k", "lead"), "marked")
    apart = marked.where("apart").select("key", *[F.col(c).alias(f"l_{c}") for c in ("node", "sig", "own", "class")])
    rest = apart.join(marked, "key").where(
        (F.col("l_class") != F.col("class")) & (F.col("l_own") | F.col("own")) & (~F.col("apart") | (F.col("l_node") < F.col("node"))) & _may_be_near(F.col("l_sig"), F.col("sig"), edits)
    )
    more = verified(rest.select(F.least("l_node", "node").alias("a"), F.greatest("l_node", "node").alias("b")))
    out = storage.cut(edges.unionByName(more), "edges")
    for x in (finds, member, centre, classes, marked, edges, more):
        storage.drop_cut(x)
    return texts, out


def line_verdicts(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = MAX_EDITS) -> DataFrame:
    """(doc_id, th, gone): for each document with lines to remove their numbers, from 0.

    The lines that links join, equal ones first of all, are one class; its first line, by
    document id (null last), text hash and place, stays, the others go. Lines that come
    once and link with none take no part in any join.
    """
    seen = storage.cut(_lines(docs, min_chars).select("doc_id", "th", "pos", "id", "id2"), "seen")
    repeated = storage.cut(repeated_lines(seen), "repeated")
    many = repeated.where(F.col("c") * HEAVY > F.lit(seen.count()))
    texts, edges = near_lines(docs, min_chars, edits, many)
    reached = components.connected(edges, native=True)
    linked = texts.join(reached, F.col("node") == reached["id"]).select(texts["id"].alias("lid"), F.col("id2").alias("lid2"), "component")
    linked = storage.cut(linked, "linked")
    for x in (texts, edges, reached):
        storage.drop_cut(x)
    same = (F.col("id") == F.col("lid")) & (F.col("id2") == F.col("lid2"))
    near = storage.cut(seen.join(storage.small(linked, 32), same).select("doc_id", "th", "pos", "component"), "seen")
    # written first, so that the joins that follow are between plain exchanges, which adaptive execution can split
    firsts = storage.cut(near.groupBy(F.col("component").alias("cc")).agg(F.min(_place()).alias("first")), "firsts")
    alone = storage.cut(repeated.join(storage.small(linked, 32), same, "left_anti").select(F.col("id").alias("rid"), F.col("id2").alias("rid2"), "first"), "firsts")
    later = ~_place().eqNullSafe(F.col("first"))
    a = near.join(firsts, F.col("component") == F.col("cc")).where(later).select("doc_id", "th", "pos")
    b = seen.join(alone, (F.col("id") == F.col("rid")) & (F.col("id2") == F.col("rid2"))).where(later).select("doc_id", "th", "pos")
    gone = storage.cut(a.unionByName(b).groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("pos")).alias("gone")), "gone")
    for x in (seen, repeated, linked, near, firsts, alone):
        storage.drop_cut(x)
    return gone


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, edits: int = MAX_EDITS) -> DataFrame:
    """For every document doc_id, n_lines, n_removed and removed (numbers of the lines that go, from 0).

    Defined cases: null text has no lines, an empty one has one; lines under min_chars
    code points go only where an equal line stays, and of these blank ones never; equal
    lines of one document count, the first stays; a very long text is many lines or one
    long one, all of it is read; rows that share id and text are judged alike; rows that share
    an id only are told apart by their texts; a null id comes after all others; an empty
    table gives an empty result; other columns are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    verdicts = line_verdicts(own, min_chars, edits)
    n = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0))
    rows = own.select("doc_id", F.xxhash64("text").alias("th"), F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"))
    v = verdicts.select(F.col("doc_id").alias("vd"), F.col("th").alias("vt"), "gone")
    joined = rows.join(v, rows["doc_id"].eqNullSafe(v["vd"]) & (rows["th"] == v["vt"]), "left")
    return joined.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, edits: int = MAX_EDITS) -> DataFrame:
    """docs without the lines of line_report, with the columns of docs, whatever their names.

    A document that loses lines and has nothing but blank ones left goes altogether; one
    that loses nothing is returned as it is. Cases as in line_report.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = storage.free_names(docs, 3)
    v = line_verdicts(own, min_chars, edits).select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "th", "gone"), names)])
    vd, vt, gone = (v[n] for n in names)
    # texts are dealt by their key but not sorted, at every size alike
    joined = docs.join(v.hint("shuffle_hash"), docs[id_col].cast("long").eqNullSafe(vd) & (F.xxhash64(docs[text_col].cast("string")) == vt), "left")
    left = F.array_join(F.filter(F.split(docs[text_col], "\n", -1), lambda x, i: ~F.array_contains(gone, i)), "\n")
    kept = F.when(gone.isNull(), docs[text_col]).otherwise(left)
    return joined.where(gone.isNull() | kept.rlike(r"\S")).select(*[kept.alias(c) if c == text_col else docs[c] for c in docs.columns])
