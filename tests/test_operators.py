"""Blocking, features, decisions, metrics, lexicon, folds and tables on literals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftlink.operators import blocking, decide, features, lexicon, metrics, model, split
from weftlink.plans import config, sessions
from weftlink.sources import tables


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def pred(spark, data):
    return spark.createDataFrame(data, "l_idx long, r_idx long, p double")


def test_keys_and_guard(spark):
    df = spark.createDataFrame([(0, "US", "royal royal palace", "12345", "RYL", "main|oak|elm|fir", "9", "pine"), (1, "US", "", "", "", "", "", "")], "idx long, country string, name_core string, postcode string, name_key string, localities string, house_no string, street_tok string")
    assert [k for _, k in rows(blocking.record_keys(df), "idx", "key")] == sorted(["pc|US|12345|palace", "pc|US|12345|royal", "loc|US|main|roya", "loc|US|oak|roya", "loc|US|elm|roya", "ph|US|RYL|elm", "hn|US|9|pine"])
    keys = spark.createDataFrame([(0, "a"), (1, "a"), (1, "a"), (2, "b")], "idx long, key string")
    assert rows(blocking.join_keys(keys, keys, 8), "l_idx", "r_idx") == [(2, 2)]  # a counts 3 x 3 pairs
    assert len(rows(blocking.join_keys(keys, keys, 9), "l_idx", "r_idx")) == 5
    assert blocking.join_keys(keys, keys, 0).count() == 0


def test_tfidf(spark):
    l = spark.createDataFrame([(0, "US", "sunrise bakery"), (1, "US", "blue harbor"), (2, "FR", "sunrise bakery")], "idx long, country string, _text string")
    r = spark.createDataFrame([(0, "US", "blue harbour"), (1, "US", "sunrise bakry")], "idx long, country string, _text string")
    got = blocking.tfidf_candidates(l, r, "s", min_df=1, max_df=1.0)
    assert rows(got, "l_idx", "r_idx") == [(0, 1), (1, 0)]
    assert blocking.tfidf_candidates(l, r, "s", min_df=9, max_df=1.0).count() == 0


def test_merge_and_top_k(spark):
    a = spark.createDataFrame([(0, 0, True), (0, 1, True)], "l_idx long, r_idx long, from_keys boolean")
    b = spark.createDataFrame([(0, 1, 0.5), (1, 1, 0.7), (0, 1, 0.6)], "l_idx long, r_idx long, tfidf_name double")
    out = blocking.merge_candidates([a, b])
    assert out.columns == ["l_idx", "r_idx", "tfidf_name", "tfidf_name_addr", "embed_cos", "from_keys"]
    assert rows(out, *out.columns) == [(0, 0, 0.0, 0.0, 0.0, True), (0, 1, 0.6, 0.0, 0.0, True), (1, 1, 0.7, 0.0, 0.0, False)]
    assert rows(blocking.top_k(out, "tfidf_name", 1), "l_idx", "r_idx") == [(0, 1), (1, 1)]


def test_context(spark):
    c = spark.createDataFrame([(0, 0, 0.9), (0, 1, 0.4), (1, 0, 0.95), (2, 5, 0.1)], "l_idx long, r_idx long, cheap_score double")
    got = {(r.l_idx, r.r_idx): (r.rank_l, r.rank_r, r.n_cands_l, r.n_claims_r, r.other_r_idx, r.mutual_best) for r in features.context_features(c).collect()}
    assert got == {(0, 0): (1, 2, 2, 2, 1, 0), (0, 1): (2, 1, 2, 1, 0, 0), (1, 0): (1, 1, 1, 2, None, 1), (2, 5): (1, 1, 1, 1, None, 1)}


def test_decisions(spark):
    p = pred(spark, [(0, 1, 0.9), (0, 2, 0.1), (1, 3, 0.2), (2, 2, 0.8), (2, 6, 0.7)])
    assert rows(decide.by_expected_f05(p), "l_idx", "r_idx") == [(0, 1), (2, 2), (2, 6)]
    assert rows(decide.one_owner(pred(spark, [(0, 1, 0.5), (1, 1, 0.9), (3, 1, 0.9), (2, 2, 0.1)])), "l_idx", "r_idx") == [(1, 1), (2, 2)]
    c = spark.createDataFrame([(0, "US"), (1, "FR"), (2, None)], "idx long, country string")
    assert rows(decide.scale_unseen(pred(spark, [(0, 0, 0.8), (1, 0, 0.8), (2, 0, 0.8), (9, 0, 0.8)]), c, ["US"], 0.5), "l_idx", "p") == [(0, 0.8), (1, 0.4), (2, 0.4), (9, 0.4)]
    truth = spark.createDataFrame([(0, 1), (2, 2)], "l_idx long, r_idx long")
    ids = spark.createDataFrame([(0,), (1,), (2,), (7,)], "l_idx long")
    tuned = decide.tune_threshold(p, truth, ids, [0.05, 0.15, 0.75])
    for t, f in rows(tuned, "threshold", "f05"):
        assert f == pytest.approx(metrics.macro_f05(decide.by_threshold(p, t), truth, ids).first()[0])
    assert decide.best_threshold(tuned)[0] == 0.75 and len(decide.GRID) == 28


def test_calibration(spark):
    p = spark.range(400).select((F.col("id") % 50).alias("l_idx"), F.col("id").alias("r_idx"), (F.col("id") % 10 / 10).alias("p"), (F.col("id") % 10 > 6).cast("int").alias("y"))
    got = decide.crossfit(p)
    assert got.count() == 400 and got.columns == p.columns and got.where("(p > 0.5) <> (y = 1)").count() == 0


def test_metrics(spark):
    truth = spark.createDataFrame([(0, 0), (0, 1), (1, 5)], "l_idx long, r_idx long")
    got = spark.createDataFrame([(0, 0), (0, 0), (0, 9), (3, 1)], "l_idx long, r_idx long")
    ids = spark.createDataFrame([(0,), (1,), (2,), (3,)], "l_idx long")
    want = (metrics.f05({0, 9}, {0, 1}) + 0 + 1 + 0) / 4
    assert metrics.macro_f05(got, truth, ids).first()[0] == pytest.approx(want)
    assert metrics.f05({1, 2, 3}, {1, 2}) == pytest.approx(0.714, abs=1e-3) and metrics.f05(set(), set()) == 1 and metrics.f05({1}, set()) == 0
    assert metrics.blocking_recall(got, truth, ids).first()[0] == pytest.approx(1 / 3)
    assert metrics.blocking_recall(got, truth.where("false"), ids).first()[0] == 1
    assert metrics.candidates_per_left(got, ids).first()[0] == 0.75
    assert rows(metrics.singletons(ids, truth), "l_idx") == [(2,), (3,)]
    assert rows(metrics.label_pairs(got.distinct(), truth), "l_idx", "r_idx", "y") == [(0, 0, 1), (0, 9, 0), (3, 1, 0)]


def test_experiment_log(tmp_path):
    path = str(tmp_path / "log.csv")
    metrics.log_experiment(path, {"a": 1})
    metrics.log_experiment(path, {"b": 2})
    lines = open(path).read().splitlines()
    assert lines[0] == "time,a,b" and lines[1].endswith(",1,") and lines[2].endswith(",,2")


def test_lexicon(spark):
    pairs = spark.createDataFrame([("राम ट्रेडर्स", "Ram Traders", "1 Oak Rd", "1 Oak Road")] * 6 + [("Acme Intl", "Acme International", "", "")] * 6, "l_name string, r_name string, l_addr string, r_addr string")
    got = lexicon.as_maps(lexicon.mine_lexicon(pairs, 5, 5, 0.6))
    assert got["name"]["intl"] == "international" and got["addr"] == {"rd": "road"} and "acme" not in got["name"]


def test_folds_and_slice(spark):
    s1 = spark.range(1000).select(F.col("id").alias("idx"), F.when(F.col("id") % 3 == 0, "US").when(F.col("id") % 3 == 1, "India").otherwise("X").alias("country"))
    a = split.make_folds(s1)
    assert rows(a, "l_idx", "fold") == rows(split.make_folds(s1), "l_idx", "fold") and 120 < a.where("fold = 'valid'").count() < 280
    b = {(r.country, r.fold) for r in split.make_folds(s1, "country_holdout", train=["US"], evaluate=["India"]).join(s1, F.col("l_idx") == F.col("idx")).collect()}
    assert b == {("US", "fit"), ("US", "valid_seen"), ("India", "valid"), ("X", "unused")}
    with pytest.raises(ValueError):
        split.make_folds(s1, "other")
    l = spark.createDataFrame([(0, "Paris"), (1, "Lyon"), (2, "near PARIS")], "idx long, business_address string")
    r = spark.createDataFrame([(0, "Nice"), (1, "Paris"), (2, "Lille")], "idx long, business_address string")
    x, y, z = split.dev_slice(l, r, spark.createDataFrame([(2, 2), (1, 0)], "l_idx long, r_idx long"), ["paris"])
    assert rows(x, "idx", "business_address") == [(0, "Paris"), (1, "near PARIS")] and rows(y, "idx", "business_address") == [(0, "Paris"), (1, "Lille")] and rows(z, "l_idx", "r_idx") == [(1, 1)]


def test_tables(spark, tmp_path):
    raw = tmp_path / "x.tsv"
    raw.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-2\t"Q" \\ Bar\t\tUS\nS1-1\t  pad \t1 Oak\tUS\n')
    s1 = tables.numbered(tables.read_tsv(spark, str(raw)), ["entity_id"])
    assert rows(s1, *s1.columns) == [(0, "S1-1", "  pad ", "1 Oak", "US"), (1, "S1-2", '"Q" \\ Bar', "", "US")]
    assert tables.checked(s1) is s1
    with pytest.raises(ValueError):
        tables.checked(s1.where("idx = 1"))
    right = spark.createDataFrame([(0, "S2-9"), (1, "S3-4")], "idx long, entity_id string")
    pairs = spark.createDataFrame([(0, 1), (0, 0), (0, 1)], "l_idx long, r_idx long")
    lists = tables.id_lists(s1, right, pairs, "matched_entity_ids")
    assert rows(lists, *lists.columns) == [("S1-1", "S2-9,S3-4"), ("S1-2", "")]
    tables.write_single_tsv(lists, str(tmp_path / "m.tsv"))
    assert (tmp_path / "m.tsv").read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9,S3-4\nS1-2\t\n"
    tables.write_tsv(lists, str(tmp_path / "out"))
    again = tables.read_tsv(spark, str(tmp_path / "out"))
    assert rows(tables.parse_truth(again, s1, right), "l_idx", "r_idx") == [(0, 0), (0, 1)] and tables.unresolved(again, s1, right.limit(1)) == 1
    cands = lists.withColumnRenamed("matched_entity_ids", "candidate_entity_ids")
    assert metrics.submission_errors(lists, cands, s1).count() == 0
    broken = metrics.submission_errors(lists.where("matched_entity_ids = ''"), cands, s1).collect()
    assert [(r.rule, r.n) for r in broken] == [("matches: missing id", 1)]


def test_trees(spark):
    df = spark.range(800).select((F.rand(1)).alias("a"), F.rand(2).alias("b"), (F.col("id") % 2 == 0).alias("flag"), F.lit(None).cast("double").alias("gone")).withColumn("y", (F.col("a") > 0.5).cast("int"))
    fitted = model.train(df, ["a", "b", "flag", "gone"], df.limit(100), rounds=3, depth=3)
    got = model.predict(fitted, df.select("y", "gone", "flag", "b", "a"))
    assert got.where("(p > 0.5) <> (y = 1)").count() < 20 and model.importances(fitted)[0][0] == "a"


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("PLACE", "/data")
    (tmp_path / "base.yaml").write_text("a: {b: 1, c: [1, 2]}\nwork_dir: $PLACE/w\n")
    (tmp_path / "own.yaml").write_text("extends: base.yaml\na: {c: [3]}\n")
    cfg = config.load(str(tmp_path / "own.yaml"))
    assert cfg == {"a": {"b": 1, "c": [3]}, "work_dir": "/data/w"}
    assert config.override(config.override(cfg, "a.b=2.5"), "x.y=[1]")["x"] == {"y": [1]} and cfg["a"]["b"] == 2.5
    cfg = {"work_dir": str(tmp_path / "w"), "prev_work_dirs": [str(tmp_path / "old")]}
    with pytest.raises(FileNotFoundError):
        config.read_path(cfg, "train", "x")
    old = tmp_path / "old" / "train"
    old.mkdir(parents=True)
    (old / "x").write_text("1")
    assert config.read_path(cfg, "train", "x") == str(old / "x")


def test_indexed_neighbours(spark):
    """An index of cells finds nine in ten of the exact neighbours at least, and all of them when every cell is looked into."""
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((40, 24))
    v = centre[rng.integers(40, size=1500)] + 0.6 * rng.standard_normal((1500, 24))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, "ab"[i % 7 == 0], x.tolist()) for i, x in enumerate(v)], "idx long, country string, vector array<double>")
    l, r = df.where("idx % 2 = 0"), df.where("idx % 2 = 1")
    key = lambda x: {(q.l_idx, q.r_idx) for q in x.collect()}
    exact = key(blocking.vector_candidates(l, r, 5, 0 + 1))
    some = key(blocking.indexed_vector_candidates(l, r, 5, 1, cells=32, probes=8))
    forward = {(a, b) for a, b in exact}
    assert len(forward & some) >= 0.9 * len(forward)
    assert key(blocking.indexed_vector_candidates(l, r, 5, 1, cells=16, probes=16)) == exact
    assert blocking.indexed_vector_candidates(l, r.where("false"), 5, 1).count() == 0


def test_validate_files(spark, tmp_path, capsys):
    def write(name, head, rows):
        (tmp_path / name).write_text("\t".join(head) + "\n" + "".join("\t".join(r) + "\n" for r in rows))
        return str(tmp_path / name)

    ids = write("left.tsv", ["entity_id", "business_name", "business_address", "country"], [(f"S1-{i}", "n", "a", "c") for i in range(3)])
    good = [("S1-0", "S2-4,S3-1"), ("S1-1", ""), ("S1-2", "S2-9")]
    matches = write("m.tsv", ["source1_entity_id", "matched_entity_ids"], good)
    cands = write("c.tsv", ["source1_entity_id", "candidate_entity_ids"], [("S1-0", "S2-4,S2-5,S3-1"), ("S1-1", "S2-7"), ("S1-2", "S2-9")])
    assert metrics.validate_files(spark, matches, cands, ids) == 0 and capsys.readouterr().out == ""
    broken = [
        write("h.tsv", ["source1_entity_id", "matches"], good), write("x.tsv", ["source1_entity_id", "matched_entity_ids"], good[:2]),
        write("t.tsv", ["source1_entity_id", "matched_entity_ids"], [("S1-0", "S2-4,S2-4"), *good[1:]]), write("o.tsv", ["source1_entity_id", "matched_entity_ids"], [("S1-0", "S2-8"), *good[1:]]),
    ]
    for path in broken:
        assert metrics.validate_files(spark, path, cands, ids) == 1 and capsys.readouterr().out


def test_truth_report(spark):
    truth = spark.createDataFrame([(0, 10), (0, 11), (1, 11), (2, 12)], "l_idx long, r_idx long")
    left = spark.createDataFrame([(i, "x" if i else "y") for i in range(5)], "idx long, country string")
    right = spark.createDataFrame([(10, "y"), (11, "x"), (12, None)], "idx long, country string")
    got = metrics.truth_report(truth, left, right).first()
    assert (got.across, got.many_owners, got.singletons, got.mean_matches, got.p99_matches) == (0.5, 1, 0.4, 0.8, 2)


def test_weights_fitted_on_a_sample(spark):
    """Terms and their rarity come from the sample only; all records get weights, unit vectors of the terms that it knows."""
    docs = spark.createDataFrame([(0, "ab cd"), (1, "ab ef"), (2, "ef gh"), (3, "zz")], "idx long, t string")
    grams = blocking.word_grams(F.col("t"))
    fit = docs.where("idx < 2")
    got = {(r.idx, r.gram): r.w for r in blocking.tfidf_weights(docs, grams, [], ["idx"], fit=fit).collect()}
    assert set(got) == {(0, "ab"), (0, "cd"), (1, "ab"), (1, "ef"), (2, "ef")} and got[2, "ef"] == pytest.approx(1)
    common, rare = 1 + np.log(3 / 3), 1 + np.log(3 / 2)
    assert got[0, "ab"] == pytest.approx(common / np.hypot(common, rare))
    l, r = docs.where("idx < 2").withColumnRenamed("t", "name_core").withColumn("addr_norm", F.lit("")), docs.where("idx >= 2").withColumnRenamed("t", "name_core").withColumn("addr_norm", F.lit(""))
    alone = docs.withColumn("kind", F.lit("k")).where("idx <> 1")
    assert blocking.tfidf_weights(alone, grams, ["kind"], ["idx"], 2, or_all=True).count() == 5 and blocking.tfidf_weights(alone, grams, ["kind"], ["idx"], 2).count() == 0
    whole = [sorted(map(str, x.collect())) for x in features.record_vectors(l, r)]
    assert [sorted(map(str, x.collect())) for x in features.record_vectors(l, r, 100)] == whole


def test_sessions(tmp_path):
    calls = []
    sessions.run("second", "run.yaml", ["a/work", "b/work"], ["decide.one_owner=false"], start=lambda command: calls.append(command))
    assert [c[c.index("--stage") + 1] for c in calls] == ["features", "features", "train", "evaluate", "predict", "submit"]
    assert all("prev_work_dirs=[a/work,b/work]" in c and "decide.one_owner=false" in c for c in calls)
    assert [s for s, _ in sessions.SESSIONS["first"]][:4] == ["ingest", "ingest", "split", "lexicon"]
    with pytest.raises(KeyError):
        sessions.run("third", "run.yaml", start=calls.append)
