"""How the work of the linkage queries is dealt: plans small enough for the driver, rows on more than one task."""

import random
import re

import pytest

from weftlink.functions import similarity as S
from weftlink.operators import blocking
from weftlink.plans import business, queries
from weftlink.sources import tables

SF = "/root/testdata/sf0.001"


def joins(df):
    """Joins in the plan of df alone; what was written before is a scan."""
    return len(re.findall(r"\bJoin\b", df._jdf.queryExecution().optimizedPlan().toString()))


@pytest.fixture
def plans(monkeypatch):
    """Numbers of joins of all plans that queries write on their way."""
    seen, write = [], tables.written
    monkeypatch.setattr(tables, "written", lambda df: (seen.append(joins(df)), write(df))[1])
    return seen


def test_no_plan_of_scores_holds_all_joins(spark, plans):
    """the plan that was written before training held every join of the features, and the labels'."""
    out = queries.gbt_score(spark, SF)
    assert max([*plans, joins(out)]) <= 5 and out.columns == ["l_idx", "r_idx", "y", "p"]


def test_partial_ratios_side_by_side():
    """many pairs at once give what one pair gives, beside it for strings of any length."""
    draw = random.Random(3)
    text = lambda most: "".join(draw.choice("abc d") for _ in range(draw.randint(0, most)))
    pairs = [(text(12), text(30)) for _ in range(400)] + [(text(70), text(90)) for _ in range(300)] + [("ab", "ba"), ("", ""), ("", "a"), ("ñandú", "nandú ñ"), ("x" * 64, "y" * 64 + "x")]
    a, b = zip(*pairs)
    assert list(S.SCORERS["partial_ratio"](a, b)) == [S.partial_ratio(x, y) for x, y in pairs] and S.SCORERS["partial_ratio"] is S.partial_ratios


def test_businesses_are_dealt_to_all_cores(spark):
    """the table of parts is one small file, and its records were normalized by one task."""
    assert business.businesses(spark, SF).rdd.getNumPartitions() >= 8


def test_abbreviations_are_made_once(spark):
    """records made from the small table of parts were broadcast by that table's size, and counts and totals each compared all words."""
    out = queries.mine_abbreviations(spark, SF)
    assert joins(out) == 2 and "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_no_plan_of_features_holds_all_joins(spark, plans):
    """records, weights, contexts and the best other record met in one plan, with both sides' weights made apart."""
    out = queries.full_features(spark, SF)
    assert max([*plans, joins(out)]) <= 5 and len(plans) >= 5


def test_products_of_grams_are_not_rows(spark, plans, monkeypatch):
    """every product of two records' weights was a row of a join, and what addresses gave was written too; blocks of any size give the same."""
    out = queries.tfidf_topk(spark, SF)
    assert joins(out) == 1  # of the sizes of countries; before, of gram with gram, and of grams with their weights
    want = sorted(map(tuple, out.collect()))
    monkeypatch.setattr(blocking, "BLOCK", 7)
    monkeypatch.setattr(blocking, "CELLS", 30)
    assert want and sorted(map(tuple, queries.tfidf_topk(spark, SF).collect())) == want


def test_equal_names_leave_a_block_as_their_first(spark):
    """Of very many pairs of one score a block sends on the first by id, as many as the ranks keep."""
    rows = spark.createDataFrame([(i, "alpine tea house", "x") for i in range(900)], "idx long, _text string, country string")
    l, r = rows.where("idx % 2 = 0"), rows.where("idx % 2 = 1")
    got = {(x.l_idx, x.r_idx) for x in blocking.tfidf_candidates(l, r, "s", min_df=1, max_df=1.0, k_forward=3, k_reverse=1).collect()}
    assert got == {(i, j) for i in range(0, 900, 2) for j in (1, 3, 5)} | {(0, j) for j in range(1, 900, 2)}


def test_grams_are_dealt_once(spark):
    """counts of documents left the column of counts out, so grams were made and dealt a second time."""
    docs = spark.createDataFrame([(i, f"alpine tea house {i % 7}", "x") for i in range(50)], "idx long, t string, country string").repartition(3)
    w = blocking.tfidf_weights(docs, blocking.char_grams(docs["t"]), ["country"], ["idx"])
    assert w.collect() and "ReusedExchange" in w._jdf.queryExecution().executedPlan().toString()
