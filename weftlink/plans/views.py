"""Linkage records, candidate pairs and probabilities made from the test tables, whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text
from ..operators import blocking
from ..sources import tables

#: Pairs of a block at most.
BLOCK_PAIRS = 5000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a record: its first line is the name, the others are the address; the role goes by doc_id."""
    d = table(spark, sf_dir, "documents")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    source = F.when(F.col("doc_id") % 3 == 0, "S1").when(F.col("doc_id") % 3 == 1, "S2").otherwise("S3")
    return d.select(
        F.col("doc_id").alias("idx"), F.concat(source, F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), F.element_at(lines, 1).alias("business_name"),
        F.array_join(F.slice(lines, F.lit(2), F.size(lines)), ", ").alias("business_address"), F.col("lang").alias("country"), source.alias("source"),
    )


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records with cleaned names, written once: for what needs no addresses."""
    r = records(spark, sf_dir).drop("business_address")
    return tables.written(r.withColumn("name_core", text.clean(F.col("business_name"))))


def simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records with normalized columns that SQL can state too, cleaned and written once, whatever number of branches reads them."""
    r = records(spark, sf_dir).withColumns({"name_core": text.clean(F.col("business_name")), "addr_norm": text.clean(F.col("business_address"))})
    return tables.written(r.withColumns({
        "postcode": F.regexp_extract("addr_norm", r"\b([0-9]{5})\b", 1), "house_no": F.regexp_extract("addr_norm", r"([0-9]+)", 1), "street_tok": F.regexp_extract("addr_norm", r"([a-z]{6,})", 1),
        "name_key": F.regexp_extract("name_core", r"^([a-z]+)", 1), "localities": F.array_join(F.regexp_extract_all("addr_norm", F.lit(r"[a-z]{7,}"), F.lit(0)), "|"),
        "num_tokens": S.numbers(F.col("addr_norm")),
    }))


def sides(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("source = 'S1'").drop("source"), df.where("source <> 'S1'")


def truth(df: DataFrame) -> DataFrame:
    """Pairs of both sides with equal cleaned names of 20 letters at least."""
    l, r = sides(df.where(F.length("name_core") >= 20))
    return l.select("name_core", F.col("idx").alias("l_idx")).join(r.select("name_core", F.col("idx").alias("r_idx")), "name_core").select("l_idx", "r_idx")


def left_ids(df: DataFrame) -> DataFrame:
    return sides(df)[0].select(F.col("idx").alias("l_idx"))


def candidates(df: DataFrame) -> DataFrame:
    l, r = sides(df)
    return blocking.join_keys(blocking.record_keys(l), blocking.record_keys(r), BLOCK_PAIRS)


def probabilities(df: DataFrame) -> DataFrame:
    """(l_idx, r_idx, p): candidates with the Jaccard similarity of the words of their names for a probability."""
    l, r = sides(df)
    x = candidates(df).join(l.select(F.col("idx").alias("l_idx"), F.col("name_core").alias("ln")), "l_idx").join(r.select(F.col("idx").alias("r_idx"), F.col("name_core").alias("rn")), "r_idx")
    return x.select("l_idx", "r_idx", F.round(F.coalesce(S.jaccard(F.col("ln"), F.col("rn")), F.lit(0.0)), 6).alias("p"))
