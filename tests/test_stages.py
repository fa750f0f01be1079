"""A whole run on made-up records: every stage, then a valid submission; and the streaming link."""

import random

from weftlink.operators import blocking
from weftlink.plans import stages
from weftlink.functions import text
from weftlink.streaming import incremental

STREETS = ["Oak", "Maple", "Cedar", "Elm", "Birch", "Walnut", "Chestnut", "Willow", "Juniper", "Aspen"]
CITIES = {"US": ["Austin", "Denver", "Portland"], "India": ["Pune", "Mysore", "Nagpur"], "France": ["Lyon", "Lille", "Nantes"]}
WORDS = ["Sunrise", "Harbor", "Granite", "Velvet", "Summit", "Copper", "Lantern", "Orchid", "Falcon", "Meadow", "Cobalt", "Thistle", "Anchor", "Beacon", "Marble", "Saffron"]
TRADES = ["Bakery", "Motors", "Textiles", "Pharmacy", "Foods", "Logistics", "Jewellers", "Hardware"]


def write(folder, split, n, countries, seed):
    r = random.Random(seed)
    files = {1: [], 2: [], 3: []}
    truth = []
    for i in range(n):
        c = countries[i % len(countries)]
        name = f"{r.choice(WORDS)} {r.choice(WORDS)} {r.choice(TRADES)}"
        house, street, city = r.randint(1, 999), r.choice(STREETS), r.choice(CITIES[c])
        files[1].append((f"S1-{i}", f"{name} Inc", f"{house} {street} Street, {city}", c))
        matched = []
        for s in (2, 3) if i % 10 else ():
            own = name.upper() + " Incorporated" if s == 2 else "Inc. " + name
            files[s].append((f"S{s}-{i}", own, f"{city}, {house} {street} St" if s == 2 else f"{house} {street} St, {city}", c))
            matched.append(f"S{s}-{i}")
        files[2].append((f"S2-x{i}", f"{r.choice(WORDS)} {r.choice(TRADES)}", f"{r.randint(1, 999)} {r.choice(STREETS)} Road, {city}", c))
        truth.append((f"S1-{i}", ",".join(matched)))
    (folder / split).mkdir(parents=True)
    for s, rows in files.items():
        head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
        (folder / split / f"{split}_source{s}.tsv").write_text(head + "".join("\t".join(x) + "\n" for x in rows))
    if split == "train":
        (folder / split / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join("\t".join(x) + "\n" for x in truth))


def test_run(spark, tmp_path):
    write(tmp_path / "raw", "train", 90, ["US", "India"], 1)
    write(tmp_path / "raw", "test", 30, ["US", "India", "France"], 2)
    cfg = {
        "work_dir": str(tmp_path / "work"), "paths": {"raw_dir": str(tmp_path / "raw")}, "lexicon": {"min_count": 3, "abbrev_min_count": 3},
        "blocking": {"tfidf": {"views": ["name"], "max_df": 0.9, "top_k_fwd": 10}}, "cheap": {"rounds": 3, "depth": 3}, "gbm": {"rounds": 3, "depth": 3},
    }
    for stage in ("ingest", "split", "lexicon", "normalize", "block", "cheap_train", "cheap_apply", "features", "train"):
        stages.run_stage(spark, cfg, stage, "train")
    scores = stages.run_stage(spark, cfg, "evaluate", "train")
    assert scores["recall_cands_all"] > 0.9 and scores["f05"] > 0.6
    for stage in ("ingest", "normalize", "block", "cheap_apply", "features", "predict", "submit"):
        stages.run_stage(spark, cfg, stage, "test")
    lines = (tmp_path / "work" / "test" / "matching_results.tsv").read_text().splitlines()
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and len(lines) == 31


def test_stream(spark, tmp_path):
    rows = [(0, "Sunrise Bakery", "12 Oak St, Austin", "US"), (1, "Blue Harbor", "9 Elm St, Denver", "US")]
    schema = "idx long, business_name string, business_address string, country string"
    left = text.normalized(spark.createDataFrame(rows, schema))
    (spark.createDataFrame([(7, "SUNRISE bakery", "12 Oak Street, Austin", "US")], schema).write.parquet(str(tmp_path / "in")))
    q = incremental.link_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), blocking.record_keys(left), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert [(r.l_idx, r.r_idx) for r in spark.read.parquet(str(tmp_path / "out")).select("l_idx", "r_idx").collect()] == [(0, 7)]
