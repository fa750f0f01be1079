"""Mixing sources to target weights, in DataFrame expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import storage

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights dealt to the sources in code point order, again and again.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source is repeated more often than this.
MAX_RATE = 3.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(seed: str, key: Column) -> Column:
    """A double in [0, 1) from md5 of seed and key: 52 bits, the same on every run and engine."""
    hexed = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(hexed, 16, 10).cast("double") / F.lit(float(1 << 52))


def _numbered(sources: DataFrame) -> DataFrame:
    """Number the sources in code point order, null last, without one task for all of them.

    Rows are dealt by range, counted by partition, and each partition numbers its own
    rows from the sum of the counts before it; the window over the counts has one row
    for each partition.
    """
    parts = sources.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = sources.withColumn("__null", F.col("source").isNull().cast("int"))
    dealt = storage.cut(ordered.repartitionByRange(int(parts), "__null", "source").withColumn("__p", F.spark_partition_id()), "sources")
    counts = dealt.groupBy("__p").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    own = Window.partitionBy("__p").orderBy("__null", "source")
    return (
        dealt.withColumn("__rn", F.row_number().over(own) - 1)
        .join(F.broadcast(starts), "__p")
        .withColumn("__rank", F.col("__start") + F.col("__rn"))
        .drop("__p", "__rn", "__start", "__null")
    )


def source_targets(sources: DataFrame, weights=WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """Targets of (source, source_size) rows: weight's share of all words, at most max_rate times the source.

    What a capped source leaves is shared again by weight among the others until none
    is above its cap. Each round is one aggregate of three numbers over the sources;
    a round that caps nothing ends the loop, so there are at most as many rounds as
    distinct ratios of size to weight and in practice a handful.
    """
    cases = reduce(lambda c, kv: c.when(F.col("__rank") % len(weights) == kv[0], F.lit(kv[1])), list(enumerate(weights))[1:], F.when(F.col("__rank") % len(weights) == 0, F.lit(weights[0])))
    table = storage.cut(_numbered(sources).withColumn("__w", cases).withColumn("__cap", F.lit(max_rate) * F.col("source_size")), "ranked")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = 0.0
    while True:
        capped = F.col("__w") * F.lit(level) > F.col("__cap")
        held, free = table.agg(
            F.coalesce(F.sum(F.when(capped, F.col("__cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("__w"))), F.lit(0.0)),
        ).first()
        if not free or (total - held) / free <= level:
            break
        level = (total - held) / free
    target = F.least(F.col("__cap"), F.col("__w") * F.lit(level))
    return table.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    max_rate: float = MAX_RATE,
    seed: str = "mix",
) -> DataFrame:
    """How many copies of each document the mix takes.

    Returns one row per input row: id (as doc_id), source, size, source_size, target, rate
    and copies. copies is floor(rate) plus one more with the probability of the fraction,
    drawn from md5(seed, id); a rerun draws the same.

    Defined cases: null text has size 0; a null source is a source of its own, after all
    others; a source without words has target and rate 0, so its documents get no copy;
    a null id draws as the text 'null'; repeated rows with one id draw alike; a very long
    text is counted whole and weighs all its words; a draw equal to the fraction gives no
    copy; an empty table gives an empty result; other columns of docs are not read.
    """
    sized = storage.cut(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes"
    )
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_rate)
    targets = storage.small(storage.cut(targets, "targets"), 64)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = targets.withColumnRenamed("source", "__s")
    extra = unit_hash(seed, F.col("doc_id")) < F.col("rate") - F.floor("rate")
    return (
        sized.join(t, sized["source"].eqNullSafe(t["__s"]))
        .drop("__s")
        .withColumn("rate", rate)
        .withColumn("copies", (F.floor("rate") + extra.cast("long")).cast("long"))
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    max_rate: float = MAX_RATE,
    seed: str = "mix",
) -> DataFrame:
    """The mixed corpus: every row of docs as often as the mix takes it, with the columns of docs.

    Sizes are summed by source in one scan; the second scan gets each source's rate and
    repeats its rows by exploding a sequence of at most ceil(max_rate) numbers, so texts
    are not dealt out. Columns may have any names. Cases as in mix_sources.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(word_count(F.col(text_col))).alias("source_size"))
    targets = source_targets(storage.cut(sizes, "sizes"), weights, max_rate)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    name, share, copies, k = storage.free_names(docs, 4)
    t = storage.small(storage.cut(targets.select(F.col("source").alias(name), rate.alias(share)), "rates"), 64)
    joined = docs.join(t, docs[source_col].eqNullSafe(t[name]))
    extra = unit_hash(seed, docs[id_col]) < t[share] - F.floor(t[share])
    taken = joined.withColumn(copies, (F.floor(t[share]) + extra.cast("long")).cast("int")).where(F.col(copies) > 0)
    return taken.withColumn(k, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[docs[c] for c in docs.columns])
