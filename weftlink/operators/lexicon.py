"""Token maps learned from matched pairs: transliterations and abbreviations."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scripts, similarity as S, text

#: What separates raw words; combining marks belong to their words.
_BREAKS = r"[\s,.;:/\\()\[\]{}|\"'!?&#@*_+=<>~`^%$-]+"


def raw_words(c: Column) -> Column:
    return F.filter(F.split(c, _BREAKS), lambda t: t != "")


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _foreign(words: pd.Series) -> pd.Series:
    return words.map(lambda ws: [scripts.script_of(w) != "latin" for w in ws])


@F.pandas_udf(T.StringType())
def _closest(src: pd.Series, dst: pd.Series) -> pd.Series:
    """Of the words of dst, three letters at least and not src itself, the most alike by Jaro-Winkler, 0.7 at least; the last one on ties."""

    def pick(s: str, ds) -> str | None:
        best, found = 0.7, None
        for d in ds:
            if len(d) >= 3 and d != s and (v := S.jaro_winkler(s, d)) >= best:
                best, found = v, d
        return found

    return pd.Series([pick(s, d) for s, d in zip(src, dst)])


def directed(pairs: DataFrame) -> DataFrame:
    """(field, x, y): every pair's names and addresses, both ways."""
    rows = [F.struct(F.lit(f).alias("field"), F.col(a).alias("x"), F.col(b).alias("y")) for f in ("name", "addr") for a, b in ((f"l_{f}", f"r_{f}"), (f"r_{f}", f"l_{f}"))]
    return pairs.select(F.explode(F.array(*rows)).alias("d")).select("d.field", F.coalesce("d.x", F.lit("")).alias("x"), F.coalesce("d.y", F.lit("")).alias("y"))


def transliterations(rows: DataFrame) -> DataFrame:
    """(field, src, dst): cleaned words written in another script on one side beside the closest word of the all-Latin other side."""
    words = rows.where(scripts.script(F.col("y")) == "latin").withColumn("w", raw_words(F.col("x"))).withColumn("foreign", _foreign("w")).where(F.exists("foreign", lambda f: f))
    words = words.withColumn("odd", F.filter("w", lambda t, i: F.element_at("foreign", i + 1)))
    cleaned = words.select("field", "y", F.explode("odd").alias("t")).withColumn("clean", text.clean(F.col("t"))).withColumn("dst_words", text.words(text.clean(F.col("y"))))
    each = cleaned.select("field", F.explode(text.words(F.col("clean"))).alias("src"), "dst_words").where((F.length("src") >= 3) & ~F.col("src").rlike("[0-9]"))
    each = each.withColumn("dst_words", F.filter("dst_words", lambda t: ~t.rlike("[0-9]")))
    return each.withColumn("dst", _closest("src", "dst_words")).select("field", "src", "dst")


def abbreviations(rows: DataFrame) -> DataFrame:
    """(field, src, dst): words on one side only, and words on the other side only that they shorten."""
    both = rows.where((scripts.script(F.col("x")) == "latin") & (scripts.script(F.col("y")) == "latin"))
    c = both.select("field", text.words(text.clean(F.col("x"))).alias("a"), text.words(text.clean(F.col("y"))).alias("b"))
    c = c.select("field", F.array_except("a", "b").alias("a"), F.array_except("b", "a").alias("b"))
    a = c.select("field", "b", F.explode(F.filter("a", lambda t: ~t.rlike("[0-9]"))).alias("src"))
    fits = F.filter("b", lambda t: ~t.rlike("[0-9]") & S.subsequence_abbreviation(F.col("src"), t))
    return a.select("field", "src", F.explode_outer(fits).alias("dst"))


def chosen(seen: DataFrame, min_count: int, min_share: float) -> DataFrame:
    """(field, src, dst, n): for each word its most frequent partner, often enough and in a large enough share of its occurrences."""
    # one pass: seen is made by comparing words, and two branches would make it twice
    counts = seen.groupBy("field", "src", "dst").agg(F.count("*").alias("n"))
    word = Window.partitionBy("field", "src")
    fine = counts.withColumn("total", F.sum("n").over(word)).where(F.col("dst").isNotNull() & (F.col("n") >= min_count) & (F.col("n") / F.col("total") >= min_share))
    rank = F.row_number().over(word.orderBy(F.col("n").desc(), "dst"))
    return fine.withColumn("__rank", rank).where("__rank = 1").select("field", "src", "dst", "n")


def mine_lexicon(pairs: DataFrame, min_count: int = 5, abbrev_min_count: int = 20, min_share: float = 0.6) -> DataFrame:
    """(field, src, dst) from l_name, r_name, l_addr, r_addr of matched pairs; an abbreviation stands before a transliteration."""
    rows = directed(pairs)
    found = chosen(transliterations(rows), min_count, min_share).withColumn("rank", F.lit(2)).unionByName(chosen(abbreviations(rows), abbrev_min_count, min_share).withColumn("rank", F.lit(1)))
    return found.groupBy("field", "src").agg(F.min_by("dst", "rank").alias("dst"))


def as_maps(lexicon: DataFrame) -> dict[str, dict[str, str]]:
    """{"name": {...}, "addr": {...}} on the driver: a vocabulary, not data."""
    out: dict[str, dict[str, str]] = {"name": {}, "addr": {}}
    for r in lexicon.collect():
        out[r["field"]][r["src"]] = r["dst"]
    return out
