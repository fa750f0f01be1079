"""The pipeline's stages chain, keep the columns and carry out their decisions, on the test tables and on awkward ones."""

import collections
import re

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import BASE, PYTHON, ROWS, brute_groups, edit_words, plan, words, written_plans
from weftlink.llm import storage

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = storage.cut(stage(spark, docs, SF))
        if i < 4:
            assert docs.columns == columns
        if i == 0:
            bad = docs.join(labels.where("quality = 0"), "doc_id").count()
            assert docs.count() < n and bad <= 0.1 * labels.where("quality = 0").count()
            good = labels.where("quality = 1").join(before, "doc_id")
            assert docs.join(good.select("doc_id"), "doc_id").count() >= 0.95 * good.count()
        if i == 1:
            lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where(r"line rlike '\\\\S'")
            assert lines.count() == lines.distinct().count() and docs.where("n_chars <> length(text)").count() == 0
        if i == 2:
            # one row of each group that brute force finds, and rows without words untouched
            rows = [(r.doc_id, r.text, r.source) for r in before.collect()]
            groups = collections.Counter(c for (_, size, c), k in brute_groups(rows, 5, 80).items() for _ in range(k) if size)
            assert docs.count() == len(groups) + sum(1 for _, t, _ in rows if not WORD.findall(t or ""))
            assert {r.doc_id for r in docs.collect()} >= set(groups)
        if i == 3:
            taken = collections.Counter(r.doc_id for r in docs.collect())
            assert set(taken) <= {r.doc_id for r in before.collect()} and max(taken.values()) <= 3
        if i == 4:
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()}
            firsts = docs.where("piece = 0").groupBy("doc_id").count().collect()
            assert {r.doc_id: r["count"] for r in firsts} == dict(collections.Counter(r.doc_id for r in before.collect()))
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_line_dedup_runs_no_python(spark, monkeypatch):
    """The stage on the test table, whose lines have near copies: rounds are made, and no plan of the stage runs Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plans = written_plans(monkeypatch)
    after = dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, SF)
    assert 0 < after.count() < docs.count() and len(plans) > 10 and not any(PYTHON.search(p) for p in [*plans, plan(after)])


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def test_awkward_tables(spark, folder):
    """Nulls, repeated rows and ids, long texts and columns with clashing names; then no rows at all."""
    good = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    rows = [(None if i is None else 10_000 + i, t, s) for i, t, s in ROWS] + [(20_000, BASE, "z"), (20_001, edit_words(BASE, 2, 5), None), (20_002, words(40, 77), None)]
    more = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = good.unionByName(more).withColumn("lang", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("long"))
    for c in ("__gone", "__kept", "__copies", "__k", "__0", "__1", "__rate", "__node", "block", "file", "start", "size", "component"):
        docs = docs.withColumn(c, F.lit(c))
    for given in (docs, docs.where("false")):
        at = storage.cut(given)
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            after = storage.cut(stage(spark, at, folder))
            if i < 4:
                assert after.columns == docs.columns and after.where("__k <> '__k' OR block <> 'block'").count() == 0
            if i in (0, 2):
                assert after.count() <= at.count()
            at = after
        assert np.array_equal(sorted(at.columns), sorted(["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]))
        assert (at.count() > 0) == (given is docs)
