"""Raw TSV sources, record numbering, ground truth, and id-list output."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD = ["entity_id", "business_name", "business_address", "country"]
#: Folder of the data inside an archive (fixed value).
ARCHIVE_ROOT = "student_resource/dataset"


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated text with a header, no quoting, every column a string and '' where a value is missing."""
    raw = spark.read.options(sep="\t", header=True, quote="", escape="", inferSchema=False).csv(path)
    return raw.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in raw.columns])


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which executors share; one of our own only in a local session without that setting."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.weftlink.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="weftlink-")
        spark.conf.set("spark.weftlink.shared.dir", found)
    return found.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, read again: what several branches of a plan need is made once."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to twice as many tasks as there are cores: a small file is one split and so one task, whatever is made of its rows."""
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def raw_path(cfg: dict, split: str, name: str, scratch: str) -> str:
    """Where a raw file can be read: raw_dir first, else taken out of raw_zip into scratch (Spark reads no zip)."""
    paths = cfg.get("paths", cfg)
    if paths.get("raw_dir"):
        return os.path.join(paths["raw_dir"], split, name)
    target = os.path.join(scratch, split, name)
    if not os.path.exists(target):
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with zipfile.ZipFile(paths["raw_zip"]) as z, z.open(f"{ARCHIVE_ROOT}/{split}/{name}") as src, open(target, "wb") as out:
            while block := src.read(1 << 20):
                out.write(block)
    return target


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """df with idx 0..n-1 in the given order, numbered by range partitions from the counts before them."""
    dealt = written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    counts = dealt.groupBy("__part").agg(F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    out = dealt.withColumn("__rn", own).join(F.broadcast(starts), "__part")  # one row for each partition
    return out.select((F.col("start") + F.col("__rn")).cast("long").alias("idx"), *df.columns)


def two_sides(s1: DataFrame, s2: DataFrame, s3: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered left records, and right ones with their source, S2 before S3."""
    right = s2.withColumn("source", F.lit("S2")).unionByName(s3.withColumn("source", F.lit("S3")))
    return numbered(s1, ["entity_id"]), numbered(right, ["source", "entity_id"])


def parse_truth(raw: DataFrame, s1: DataFrame, right: DataFrame) -> DataFrame:
    """(l_idx, r_idx) from lists of ids; ids that no record has drop out."""
    each = raw.select("source1_entity_id", F.explode(F.split("matched_entity_ids", ",")).alias("right_id")).where("right_id <> ''")
    l = s1.select(F.col("entity_id").alias("source1_entity_id"), F.col("idx").alias("l_idx"))
    r = right.select(F.col("entity_id").alias("right_id"), F.col("idx").alias("r_idx"))
    return each.join(l, "source1_entity_id").join(r, "right_id").select("l_idx", "r_idx").distinct()


def unresolved(raw: DataFrame, s1: DataFrame, right: DataFrame) -> int:
    """Listed pairs whose ids no record has."""
    each = raw.select("source1_entity_id", F.explode(F.split("matched_entity_ids", ",")).alias("right_id")).where("right_id <> ''")
    lost_left = each.join(s1.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_anti")
    lost_right = each.join(right.select(F.col("entity_id").alias("right_id")), "right_id", "left_anti")
    return lost_left.unionByName(lost_right).distinct().count()


def id_lists(s1: DataFrame, right: DataFrame, pairs: DataFrame, value_col: str) -> DataFrame:
    """(source1_entity_id, value_col): for every left record its right ids, sorted, unique, joined by commas; '' without any."""
    names = right.select(F.col("idx").alias("r_idx"), F.col("entity_id").alias("rid"))
    lists = pairs.select("l_idx", "r_idx").distinct().join(names, "r_idx").groupBy("l_idx").agg(F.array_join(F.array_sort(F.collect_set("rid")), ",").alias(value_col))
    out = s1.select(F.col("idx").alias("l_idx"), F.col("entity_id").alias("source1_entity_id")).join(lists, "l_idx", "left")
    return out.select("source1_entity_id", F.coalesce(value_col, F.lit("")).alias(value_col))


def write_tsv(df: DataFrame, path: str) -> None:
    """Unquoted TSV parts with a header below path; spaces and empty values stay as they are."""
    df.write.mode("overwrite").options(
        sep="\t", header=True, quote="", escape="", emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_single_tsv(df: DataFrame, path: str) -> None:
    """The same as one local file, streamed through the driver row by row: for outputs that a person hands in."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\t".join(df.columns) + "\n")
        for row in df.orderBy(df.columns[0]).toLocalIterator():
            f.write("\t".join("" if v is None else str(v) for v in row) + "\n")


def checked(df: DataFrame, key: str = "idx") -> DataFrame:
    """df, if its key is 0..n-1 without gaps; else an error."""
    n, distinct, top = df.agg(F.count("*"), F.count_distinct(key), F.max(key)).first()
    if n and not n == distinct == top + 1:
        raise ValueError(f"{key} is not 0..n-1: {n} rows, {distinct} distinct, largest {top}")
    return df
