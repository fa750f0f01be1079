"""Queries of the linkage operators over the test tables, and the SQL that states them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import phonetics, scripts, similarity as S, text
from ..operators import blocking, decide, features, lexicon, metrics, model, split
from ..sources import tables
from . import business as B
from . import business_sql as BS
from . import views as V


def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return V.records(spark, d).select("idx", text.clean(F.col("business_name")).alias("name"), text.clean(F.col("business_address"), True).alias("address"))


def profile_by_source(spark, d):
    r = V.simple(spark, d)
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    return r.groupBy("source", "country").agg(
        F.count("*").alias("n"), F.round(F.avg(F.length("business_name")), 6).alias("name_length"), share(F.col("business_address") == "").alias("no_address"),
        share(F.col("business_name").rlike("[0-9]")).alias("digits"), F.count_distinct("name_core").alias("names"), F.max(F.length("business_name")).alias("longest"),
    )


def match_share(spark, d):
    r = V.named(spark, d)
    right = V.sides(r)[1]
    hit = V.truth(r).select(F.col("r_idx").alias("idx")).distinct().withColumn("hit", F.lit(1.0))
    return right.join(hit, "idx", "left").groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg(F.coalesce("hit", F.lit(0.0))), 6).alias("share"))


def record_keys(spark, d):
    return blocking.record_keys(V.simple(spark, d))


def block_join(spark, d):
    return V.candidates(V.simple(spark, d))


def merge_candidates(spark, d):
    r = V.simple(spark, d)
    return blocking.merge_candidates([V.candidates(r), V.probabilities(r).where("p >= 0.1").withColumnRenamed("p", "tfidf_name")])


def topk_per_left(spark, d):
    return blocking.top_k(V.probabilities(V.simple(spark, d)), "p", 3)


def tfidf_topk(spark, d):
    l, r = V.sides(V.named(spark, d).select("idx", "source", "country", "name_core"))  # addresses, most of every text, are not read
    out = blocking.tfidf_candidates(l, r, "tfidf_name", "name_core", max_df=0.05, k_forward=5, k_reverse=2)
    return out.select("l_idx", "r_idx", F.round("tfidf_name", 6).alias("tfidf_name"))


def tri_equal(spark, d):
    r = V.simple(spark, d)
    x = features.attach_sides(V.candidates(r), *V.sides(r), ["postcode", "house_no", "street_tok"])
    return x.select("l_idx", "r_idx", *[S.tri_equal(F.col(f"l_{c}"), F.col(f"r_{c}")).cast("int").alias(f"{c}_eq") for c in ("postcode", "house_no", "street_tok")])


def pair_similarities(spark, d):
    r = V.simple(spark, d)
    x = features.attach_sides(V.candidates(r), *V.sides(r), ["name_core", "num_tokens", "localities"])
    a, b = F.col("l_name_core"), F.col("r_name_core")
    return x.select(
        "l_idx", "r_idx", F.round(S.jaccard(F.col("l_num_tokens"), F.col("r_num_tokens")), 6).alias("num_jaccard"), F.round(S.jaccard(F.col("l_localities"), F.col("r_localities"), "|"), 6).alias("loc_jaccard"),
        F.round(S.levenshtein_similarity(a, b), 6).alias("lev"), F.round(S.length_ratio(a, b), 6).alias("len_ratio"), S.first_word_equal(a, b).cast("int").alias("first_eq"),
        S.tri_equal(S.numbers(a), S.numbers(b)).cast("int").alias("num_eq"),
    )


def context_features(spark, d):
    out = features.context_features(V.probabilities(V.simple(spark, d)), "p")
    return out.select("l_idx", "r_idx", "rank_l", F.round("gap_l", 6).alias("gap_l"), "n_cands_l", "other_r_idx", "n_claims_r", "rank_r", F.col("mutual_best").cast("int").alias("mutual_best"))


def one_owner(spark, d):
    return decide.one_owner(V.probabilities(V.simple(spark, d)))


def threshold_pick(spark, d):
    return decide.by_threshold(V.probabilities(V.simple(spark, d)), 0.3)


def expected_f05(spark, d):
    return decide.by_expected_f05(V.probabilities(V.simple(spark, d)))


def tune_threshold(spark, d):
    r = V.simple(spark, d)
    return decide.tune_threshold(V.probabilities(r), V.truth(r), V.left_ids(r)).select("threshold", F.round("f05", 6).alias("f05"))


def scale_unseen(spark, d):
    r = V.simple(spark, d)
    return decide.scale_unseen(V.probabilities(r), V.sides(r)[0], ["en"], 0.8).select("l_idx", "r_idx", F.round("p", 6).alias("p"))


def macro_f05(spark, d):
    r = V.simple(spark, d)
    return metrics.macro_f05(decide.by_threshold(V.probabilities(r), 0.5), V.truth(r), V.left_ids(r)).select(F.round("f05", 6).alias("f05"))


def blocking_recall(spark, d):
    r = V.simple(spark, d)
    return metrics.blocking_recall(V.candidates(r), V.truth(r), V.left_ids(r)).select(F.round("recall", 6).alias("recall"))


def cands_per_left(spark, d):
    r = V.simple(spark, d)
    return metrics.candidates_per_left(V.candidates(r), V.left_ids(r)).select(F.round("per_left", 6).alias("per_left"))


def singletons(spark, d):
    r = V.named(spark, d)
    return metrics.singletons(V.left_ids(r), V.truth(r))


def label_pairs(spark, d):
    r = V.simple(spark, d)
    return metrics.label_pairs(V.candidates(r), V.truth(r)).select("l_idx", "r_idx", F.col("y").cast("int").alias("y"))


def id_list_output(spark, d):
    r = V.named(spark, d)
    return tables.id_lists(*V.sides(r), V.truth(r), "matched_entity_ids")


def truth_round_trip(spark, d):
    """Lists of ids written as TSV, read again and parsed to pairs."""
    r = V.named(spark, d)
    l, right = V.sides(r)
    path = f"{tables.shared_dir(spark)}/tsv-{uuid.uuid4().hex}"
    tables.write_tsv(tables.id_lists(l, right, V.truth(r), "matched_entity_ids"), path)
    return tables.parse_truth(tables.read_tsv(spark, path), l, right)


def folds(spark, d):
    l = V.sides(V.records(spark, d))[0]
    a = split.make_folds(l).withColumn("scheme", F.lit("s1_random"))
    return a.unionByName(split.make_folds(l, "country_holdout", train=["en"], evaluate=["fr"]).withColumn("scheme", F.lit("country_holdout")))


def dev_slice(spark, d):
    r = V.simple(spark, d)
    l, right = V.sides(r)
    a, b, c = split.dev_slice(l, right, V.truth(r), ["the", "enver", "queé"])
    return a.select(F.lit("left").alias("part"), "idx", "entity_id").unionByName(b.select(F.lit("right").alias("part"), "idx", "entity_id")).unionByName(
        c.select(F.lit("truth").alias("part"), F.col("l_idx").alias("idx"), F.col("r_idx").cast("string").alias("entity_id"))
    )


def _name_pairs(spark, d):
    r = V.simple(spark, d)
    return features.attach_sides(V.candidates(r), *V.sides(r), ["name_core", "addr_norm"]).select(
        "l_idx", "r_idx", F.col("l_name_core").alias("l_name"), F.col("r_name_core").alias("r_name"), F.col("l_addr_norm").alias("l_addr"), F.col("r_addr_norm").alias("r_addr")
    )


def mine_abbreviations(spark, d):
    """Abbreviations of names and addresses, learned from the businesses' own pairs."""
    # written, since the size of rows made from the table of parts is taken for that of the table, and they would be broadcast
    rows = tables.written(B.businesses(spark, d).select("idx", "source", F.col("business_name").alias("name"), F.col("business_address").alias("addr")))
    l, r = (rows.select(F.col("idx").alias(f"{s}_idx"), F.col("name").alias(f"{s}_name"), F.col("addr").alias(f"{s}_addr")) for s in "lr")
    pairs = B.truth(rows).join(l.hint("merge"), "l_idx").join(r.hint("merge"), "r_idx")
    return lexicon.chosen(lexicon.abbreviations(lexicon.directed(pairs)), 2, 0.5)


def _sounded(spark, d):
    """Names of one word, and the same word with its consonants in another script."""
    words = V.records(spark, d).select("idx", F.explode(text.words(text.clean(F.col("business_name")))).alias("w")).where(F.length("w") >= 4).groupBy("w").agg(F.min("idx").alias("idx"))
    return words.select("idx", "w", F.translate("w", BS.LETTERS, BS.SIGNS).alias("foreign"))


def transliterated_words(spark, d):
    return _sounded(spark, d).select("w", "foreign", text.clean(F.col("foreign")).alias("latin"))


def mine_transliterations(spark, d):
    """Words of another script beside the Latin spelling that pairs teach."""
    w = _sounded(spark, d).where("foreign <> w")
    pairs = w.select(F.col("foreign").alias("l_name"), F.col("w").alias("r_name"), F.lit("").alias("l_addr"), F.lit("").alias("r_addr"))
    found = lexicon.transliterations(lexicon.directed(pairs)).where("src <> dst OR dst IS NULL")
    return found.groupBy("src").agg(F.count("dst").alias("n"), F.min("dst").alias("dst")).where("n = 1")


def script_of_words(spark, d):
    """Scripts of words that are partly, evenly or wholly written in other letters."""
    w = _sounded(spark, d)
    mixed = F.when(F.col("idx") % 4 == 0, F.concat("foreign", F.lit(" "), F.translate("w", BS.LETTERS, BS.OTHER_SIGNS))).when(F.col("idx") % 4 == 1, F.translate("w", "aeiou", "αειοω")).when(F.col("idx") % 4 == 2, F.col("w")).otherwise(F.col("foreign"))
    return w.select("w", scripts.script(mixed).alias("script"))


def sound_of_records(spark, d):
    return V.records(spark, d).select("idx", phonetics.metaphone_words(text.clean(F.col("business_name"))).alias("sound"))


def name_jaro_winkler(spark, d):
    r = V.simple(spark, d)
    x = features.attach_sides(V.candidates(r), *V.sides(r), ["name_core"])
    return x.select("l_idx", "r_idx", F.round(S.similarity("jaro_winkler", F.col("l_name_core"), F.col("r_name_core")), 6).alias("jw"))


def _business(spark, d, cols):
    """Normalized records of businesses with the wanted columns, written once: what is not read is not made."""
    return tables.written(text.normalized(B.businesses(spark, d)).select("idx", "source", *cols))


def _business_pairs(r):
    """Every left record with its own copy in S2 and the next business's copy in S3, and the Jaccard similarity of their names as p."""
    l, right = V.sides(r)
    pairs = l.select(F.col("idx").alias("l_idx"), F.col("name_core").alias("ln"), F.explode(F.array(F.col("idx") + 1, F.col("idx") + 5)).alias("r_idx"))
    x = pairs.join(right.select(F.col("idx").alias("r_idx"), F.col("name_core").alias("rn")), "r_idx")
    return x.select("l_idx", "r_idx", F.round(F.coalesce(S.jaccard(F.col("ln"), F.col("rn")), F.lit(0.0)), 6).alias("p"))


def ratio_family(spark, d):
    r = _business(spark, d, ["name_core"])
    x = features.attach_sides(_business_pairs(r), *V.sides(r), ["name_core"])
    a, b = F.col("l_name_core"), F.col("r_name_core")
    return x.select("l_idx", "r_idx", *[F.round(S.similarity(n, a, b), 6).alias(n) for n in ("ratio", "partial_ratio", "token_sort_ratio", "token_set_ratio")])


def normalized_records(spark, d):
    return text.normalized(B.businesses(spark, d)).select("idx", *[c for c in text.NORMAL_COLUMNS if c not in ("name_key", "name_script")])


def knn_embed(spark, d):
    e = V.table(spark, d, "embeddings")
    v = F.transform("embedding", lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    u = e.select(F.col("vec_id").alias("idx"), F.col("label").cast("string").alias("country"), v.alias("v")).withColumn("vector", F.transform("v", lambda x: x / norm)).drop("v")
    out = blocking.vector_candidates(u.where("idx % 2 = 0"), u.where("idx % 2 = 1"), 3, 1)
    return out.select("l_idx", "r_idx", F.round("embed_cos", 6).alias("embed_cos"))


def _featured(spark, d):
    """All features of the business pairs and contexts by p, with the records; every step is written, so that no plan holds them all."""
    r = _business(spark, d, [c for c in text.NORMAL_COLUMNS if c != "name_key"])
    l, right = V.sides(r)
    pairs = tables.written(_business_pairs(r))
    cands = blocking.merge_candidates([pairs.select("l_idx", "r_idx", F.lit(True).alias("from_keys")), pairs.where("p >= 0.1").withColumnRenamed("p", "tfidf_name")])
    scored = cands.join(pairs.withColumnRenamed("p", "cheap_score"), ["l_idx", "r_idx"])
    return features.full_features(tables.written(features.context_features(scored)), l, right), r


def full_features(spark, d):
    rows, _ = _featured(spark, d)
    kinds = dict(rows.dtypes)
    return rows.select("l_idx", "r_idx", *[(F.round(c, 6) if kinds[c] == "double" else F.col(c).cast("int")).alias(c) for c in features.FEATURES])


def _scored(spark, d):
    featured, r = _featured(spark, d)
    rows = tables.written(metrics.label_pairs(tables.written(featured), B.truth(r)))
    fit = decide.bucket("train", F.col("l_idx")) < 0.5
    return model.predict(model.train(rows.where(fit), features.FEATURES, None, 5, 3), rows).select("l_idx", "r_idx", "y", "p")


def gbt_score(spark, d):
    return _scored(spark, d)


def calibrated(spark, d):
    r = V.simple(spark, d)
    return decide.crossfit(metrics.label_pairs(V.probabilities(r), V.truth(r))).select("l_idx", "r_idx", F.round("p", 6).alias("p"))


def truth_report(spark, d):
    """Figures of the true pairs: pairs across countries, right records with several owners, left records without any, mean and 99th percentile per left record."""
    r = V.named(spark, d)
    return metrics.truth_report(V.truth(r), *V.sides(r)).select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in metrics.REPORT])


def truth_by_group(spark, d):
    r = V.named(spark, d)
    right = r.where("source <> 'S1'").select(F.col("idx").alias("r_idx"), "country", "source")
    return V.truth(r).join(right, "r_idx").groupBy("country", "source").agg(F.count("*").alias("n"))


def spend_by_segment(spark, d):
    """Top customers of every segment and nation by order value, with their share of it."""
    from pyspark.sql import Window

    o = V.table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent"))
    c = V.table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"))
    total = F.sum("spent").over(Window.partitionBy("c_mktsegment", "c_nationkey"))
    ranked = blocking.top_k(c.withColumn("grp", F.concat_ws("/", "c_mktsegment", "c_nationkey")).withColumn("share", F.round(F.col("spent").cast("double") / total.cast("double"), 6)), "spent", 2, "grp", "c_custkey")
    return ranked.select("grp", "c_custkey", F.col("spent").cast("double").alias("spent"), "share")


QUERIES = {f.__name__: f for f in (
    clean_text, profile_by_source, match_share, record_keys, block_join, merge_candidates, topk_per_left, tfidf_topk, tri_equal, pair_similarities, context_features, one_owner,
    threshold_pick, expected_f05, tune_threshold, scale_unseen, macro_f05, blocking_recall, cands_per_left, singletons, label_pairs, id_list_output, truth_round_trip, folds, dev_slice,
    mine_abbreviations, mine_transliterations, transliterated_words, script_of_words, sound_of_records, name_jaro_winkler, ratio_family, normalized_records, knn_embed, full_features,
    gbt_score, calibrated, truth_report, truth_by_group, spend_by_segment,
)}

_FOLD = "strip_accents(replace(replace(replace({0}, 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'))"


def _clean(x: str, keep: str = "") -> str:
    folded = f"regexp_replace({_FOLD.format(x)}, '[''’`´]', '', 'g')"
    return f"trim(regexp_replace(regexp_replace(replace(lower({folded}), '&', ' and '), '[^a-z0-9{keep}]+', ' ', 'g'), '\\s+', ' ', 'g'))"


_RECORDS = f"""
rec AS (
  SELECT doc_id AS idx, CASE doc_id % 3 WHEN 0 THEN 'S1' WHEN 1 THEN 'S2' ELSE 'S3' END AS source, lang AS country,
         string_split(coalesce(text, ''), chr(10))[1] AS business_name, array_to_string(string_split(coalesce(text, ''), chr(10))[2:], ', ') AS business_address
  FROM documents
), cleaned AS (
  SELECT *, source || '-' || idx AS entity_id, {_clean("business_name")} AS name_core, {_clean("business_address")} AS addr_norm FROM rec
), v AS (
  SELECT *, regexp_extract(addr_norm, '\\b([0-9]{{5}})\\b', 1) AS postcode, regexp_extract(addr_norm, '([0-9]+)', 1) AS house_no, regexp_extract(addr_norm, '([a-z]{{6,}})', 1) AS street_tok,
         regexp_extract(name_core, '^([a-z]+)', 1) AS name_key, regexp_extract_all(addr_norm, '[a-z]{{7,}}') AS locs, regexp_extract_all(addr_norm, '[0-9]+') AS nums
  FROM cleaned
), truth AS (
  SELECT l.idx AS l_idx, r.idx AS r_idx FROM v l JOIN v r ON l.name_core = r.name_core WHERE l.source = 'S1' AND r.source <> 'S1' AND length(l.name_core) >= 20
), ids AS (
  SELECT idx AS l_idx FROM v WHERE source = 'S1'
)"""
_KEYS = (
    _RECORDS
    + """, ranked AS (
  SELECT idx, w, row_number() OVER (PARTITION BY idx ORDER BY length(w) DESC, i) AS rn
  FROM (SELECT idx, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT idx, list_filter(string_split(name_core, ' '), lambda x: x <> '') AS ws FROM v))
), keys AS (
  SELECT v.idx, source, 'pc|' || country || '|' || postcode || '|' || w AS key FROM v JOIN ranked USING (idx) WHERE rn <= 2 AND postcode <> ''
  UNION ALL SELECT idx, source, 'loc|' || country || '|' || loc || '|' || left(replace(name_core, ' ', ''), 4) FROM (SELECT *, unnest(locs[1:3]) AS loc FROM v) WHERE name_core <> ''
  UNION ALL SELECT idx, source, 'ph|' || country || '|' || name_key || '|' || (locs[1:3])[-1] FROM v WHERE name_key <> '' AND len(locs) > 0
  UNION ALL SELECT idx, source, 'hn|' || country || '|' || house_no || '|' || street_tok FROM v WHERE house_no <> '' AND street_tok <> ''
)"""
)
_PAIRS = (
    _KEYS
    + f""", fine AS (
  SELECT key FROM keys GROUP BY key HAVING count(*) FILTER (WHERE source = 'S1') * count(*) FILTER (WHERE source <> 'S1') BETWEEN 1 AND {V.BLOCK_PAIRS}
), cands AS (
  SELECT DISTINCT l.idx AS l_idx, r.idx AS r_idx FROM keys l JOIN keys r USING (key) JOIN fine USING (key) WHERE l.source = 'S1' AND r.source <> 'S1'
), words AS (
  SELECT idx, list_distinct(list_filter(string_split(name_core, ' '), lambda x: x <> '')) AS ws FROM v
), pred AS (
  SELECT l_idx, r_idx, round(coalesce(len(list_intersect(a.ws, b.ws))::DOUBLE / nullif(len(list_distinct(list_concat(a.ws, b.ws))), 0), 0.0), 6) AS p
  FROM cands JOIN words a ON a.idx = l_idx JOIN words b ON b.idx = r_idx
)"""
)
_SCORED = (
    _PAIRS
    + """, chosen AS (
  SELECT l_idx, r_idx FROM pred WHERE p >= 0.5
), sizes AS (
  SELECT i.l_idx, (SELECT count(*) FROM chosen c WHERE c.l_idx = i.l_idx) AS np, (SELECT count(*) FROM truth t WHERE t.l_idx = i.l_idx) AS nt,
         (SELECT count(*) FROM chosen c JOIN truth t USING (l_idx, r_idx) WHERE c.l_idx = i.l_idx) AS nh FROM ids i
)"""
)


def _f05(h: str, p: str, t: str) -> str:
    return f"CASE WHEN {t} = 0 THEN CASE WHEN {p} = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END WHEN {h} = 0 THEN 0.0::DOUBLE ELSE 1.25 * ({h}::DOUBLE / {p}) * ({h}::DOUBLE / {t}) / (0.25 * ({h}::DOUBLE / {p}) + {h}::DOUBLE / {t}) END"


_LIST = "list_filter({0}, lambda x: x <> '')"
_DRAW = "('0x' || substr(md5('fold42:' || idx), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 < 0.2"


def _tri(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN -1 WHEN {a} = {b} THEN 1 ELSE 0 END"


def _jac(a: str, b: str) -> str:
    return f"round(len(list_intersect(list_distinct({a}), list_distinct({b})))::DOUBLE / nullif(len(list_distinct(list_concat({a}, {b}))), 0), 6)"


_GRID = ", ".join(str(t) for t in decide.GRID)
_VEC = "list_transform({0}, lambda x: x::DOUBLE)"

SQL = {
    "clean_text": f"WITH {_RECORDS} SELECT idx, name_core AS name, {_clean('business_address', ',')} AS address FROM v",
    "profile_by_source": f"""WITH {_RECORDS} SELECT source, country, count(*) AS n, round(avg(length(business_name)), 6) AS name_length, round(avg((business_address = '')::INT), 6) AS no_address,
        round(avg(regexp_matches(business_name, '[0-9]')::INT), 6) AS digits, count(DISTINCT name_core) AS names, max(length(business_name)) AS longest FROM v GROUP BY source, country""",
    "match_share": f"WITH {_RECORDS} SELECT source, count(*) AS n, round(avg((idx IN (SELECT r_idx FROM truth))::INT), 6) AS share FROM v WHERE source <> 'S1' GROUP BY source",
    "record_keys": f"WITH {_KEYS} SELECT idx, key FROM keys",
    "block_join": f"WITH {_PAIRS} SELECT l_idx, r_idx, true AS from_keys FROM cands",
    "merge_candidates": f"WITH {_PAIRS} SELECT l_idx, r_idx, CASE WHEN p >= 0.1 THEN p ELSE 0.0 END AS tfidf_name, 0.0::DOUBLE AS tfidf_name_addr, 0.0::DOUBLE AS embed_cos, true AS from_keys FROM pred",
    "topk_per_left": f"WITH {_PAIRS} SELECT l_idx, r_idx, p FROM pred QUALIFY row_number() OVER (PARTITION BY l_idx ORDER BY p DESC, r_idx) <= 3",
    "tfidf_topk": f"""WITH {_RECORDS}, w AS (
        SELECT idx, source, coalesce(country, '') AS country, unnest(string_split(name_core, ' ')) AS t FROM v
      ), g AS (
        SELECT idx, source, country, gram, count(*) AS tf FROM (SELECT *, unnest(list_transform(range(1, greatest(length(t), 1) + 1), lambda i: substr(' ' || t || ' ', i, 3))) AS gram FROM w WHERE t <> '') GROUP BY ALL
      ), df AS (SELECT country, gram, count(*) AS df FROM g GROUP BY ALL), n AS (SELECT coalesce(country, '') AS country, count(*) AS n FROM v GROUP BY ALL
      ), raw AS (
        SELECT idx, source, g.country, gram, (1 + ln(tf)) * (1 + ln((1 + n) / (1 + df))) AS w FROM g JOIN df USING (country, gram) JOIN n USING (country) WHERE df >= 2 AND df <= 0.05 * n AND 0.05 * n >= 2
      ), normed AS (SELECT idx, source, country, gram, w / sqrt(sum(w * w) OVER (PARTITION BY idx)) AS w FROM raw
      ), s AS (
        SELECT l.idx AS l_idx, r.idx AS r_idx, sum(l.w * r.w) AS c FROM normed l JOIN normed r USING (country, gram) WHERE l.source = 'S1' AND r.source <> 'S1' GROUP BY ALL HAVING sum(l.w * r.w) > 0.3
      ) SELECT l_idx, r_idx, round(c, 6) AS tfidf_name FROM s
        QUALIFY row_number() OVER (PARTITION BY l_idx ORDER BY round(c, 9) DESC, r_idx) <= 5 OR row_number() OVER (PARTITION BY r_idx ORDER BY round(c, 9) DESC, l_idx) <= 2""",
    "tri_equal": f"WITH {_PAIRS} SELECT l_idx, r_idx, " + ", ".join(f"{_tri(f'a.{c}', f'b.{c}')} AS {c}_eq" for c in ("postcode", "house_no", "street_tok")) + " FROM cands JOIN v a ON a.idx = l_idx JOIN v b ON b.idx = r_idx",
    "pair_similarities": f"""WITH {_PAIRS} SELECT l_idx, r_idx, {_jac("a.nums", "b.nums")} AS num_jaccard, {_jac("a.locs", "b.locs")} AS loc_jaccard,
        round(CASE WHEN greatest(length(a.name_core), length(b.name_core)) = 0 THEN 1.0 ELSE 1.0 - levenshtein(a.name_core, b.name_core)::DOUBLE / greatest(length(a.name_core), length(b.name_core)) END, 6) AS lev,
        round(least(length(a.name_core), length(b.name_core))::DOUBLE / greatest(length(a.name_core), length(b.name_core), 1), 6) AS len_ratio,
        (string_split(a.name_core, ' ')[1] = string_split(b.name_core, ' ')[1] AND a.name_core <> '')::INT AS first_eq,
        {_tri("array_to_string(regexp_extract_all(a.name_core, '[0-9]+'), ' ')", "array_to_string(regexp_extract_all(b.name_core, '[0-9]+'), ' ')")} AS num_eq
        FROM cands JOIN v a ON a.idx = l_idx JOIN v b ON b.idx = r_idx""",
    "context_features": f"""WITH {_PAIRS}, x AS (
        SELECT l_idx, r_idx, p, row_number() OVER (PARTITION BY l_idx ORDER BY p DESC, r_idx) AS rank_l, round(max(p) OVER (PARTITION BY l_idx) - p, 6) AS gap_l, count(*) OVER (PARTITION BY l_idx) AS n_cands_l,
               count(*) OVER (PARTITION BY r_idx) AS n_claims_r, row_number() OVER (PARTITION BY r_idx ORDER BY p DESC, l_idx) AS rank_r FROM pred)
        SELECT x.l_idx, x.r_idx, rank_l, gap_l, n_cands_l, o.r_idx AS other_r_idx, n_claims_r, rank_r, (rank_l = 1 AND rank_r = 1)::INT AS mutual_best
        FROM x LEFT JOIN (SELECT l_idx, r_idx, rank_l AS k FROM x) o ON o.l_idx = x.l_idx AND o.k = CASE WHEN x.rank_l = 1 THEN 2 ELSE 1 END""",
    "one_owner": f"WITH {_PAIRS} SELECT l_idx, r_idx, p FROM pred QUALIFY row_number() OVER (PARTITION BY r_idx ORDER BY p DESC, l_idx) = 1",
    "threshold_pick": f"WITH {_PAIRS} SELECT l_idx, r_idx FROM pred WHERE p >= 0.3",
    "expected_f05": f"""WITH {_PAIRS}, x AS (
        SELECT l_idx, r_idx, p, row_number() OVER w AS k, sum(p) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s, sum(p) OVER (PARTITION BY l_idx) AS t,
               exp(sum(ln(greatest(1e-9, least(1.0, 1 - p)))) OVER (PARTITION BY l_idx)) AS none FROM pred WINDOW w AS (PARTITION BY l_idx ORDER BY p DESC, r_idx)
      ), y AS (SELECT *, 1.25 * s / (0.25 * t + k) AS ef FROM x
      ), z AS (SELECT *, max(ef) OVER (PARTITION BY l_idx) AS best FROM y
      ) SELECT l_idx, r_idx FROM (SELECT *, max(CASE WHEN ef = best THEN k END) OVER (PARTITION BY l_idx) AS pick FROM z) WHERE none < best AND k <= pick""",
    "tune_threshold": f"""WITH {_PAIRS}, grid AS (SELECT unnest([{_GRID}])::DOUBLE AS threshold
      ), c AS (SELECT l_idx, threshold, count(*) AS np, count(t.r_idx) AS nh FROM pred LEFT JOIN truth t USING (l_idx, r_idx), grid WHERE p >= threshold GROUP BY ALL
      ), b AS (SELECT ids.l_idx, threshold, (SELECT count(*) FROM truth WHERE truth.l_idx = ids.l_idx) AS nt FROM ids, grid
      ) SELECT threshold, round(avg({_f05("coalesce(nh, 0)", "coalesce(np, 0)", "nt")}), 6) AS f05 FROM b LEFT JOIN c USING (l_idx, threshold) GROUP BY threshold""",
    "scale_unseen": f"WITH {_PAIRS} SELECT l_idx, r_idx, round(CASE WHEN country = 'en' THEN p ELSE least(1.0, greatest(0.0, p * 0.8)) END, 6) AS p FROM pred JOIN v ON v.idx = l_idx",
    "macro_f05": f"WITH {_SCORED} SELECT round(avg({_f05('nh', 'np', 'nt')}), 6) AS f05 FROM sizes",
    "blocking_recall": f"WITH {_PAIRS} SELECT round(coalesce(avg(((l_idx, r_idx) IN (SELECT (l_idx, r_idx) FROM cands))::INT), 1.0), 6) AS recall FROM truth",
    "cands_per_left": f"WITH {_PAIRS} SELECT round((SELECT count(*) FROM cands)::DOUBLE / greatest((SELECT count(*) FROM ids), 1), 6) AS per_left",
    "singletons": f"WITH {_RECORDS} SELECT l_idx FROM ids WHERE l_idx NOT IN (SELECT l_idx FROM truth)",
    "label_pairs": f"WITH {_PAIRS} SELECT l_idx, r_idx, (t.r_idx IS NOT NULL)::INT AS y FROM cands LEFT JOIN truth t USING (l_idx, r_idx)",
    "id_list_output": f"""WITH {_RECORDS} SELECT v.entity_id AS source1_entity_id, coalesce((SELECT string_agg(DISTINCT r.entity_id, ',' ORDER BY r.entity_id) FROM truth JOIN v r ON r.idx = r_idx WHERE l_idx = v.idx), '') AS matched_entity_ids
        FROM v WHERE source = 'S1'""",
    "truth_round_trip": f"WITH {_RECORDS} SELECT DISTINCT l_idx, r_idx FROM truth",
    "folds": f"""WITH {_RECORDS} SELECT idx AS l_idx, CASE WHEN {_DRAW} THEN 'valid' ELSE 'fit' END AS fold, 's1_random' AS scheme FROM v WHERE source = 'S1'
        UNION ALL SELECT idx, CASE WHEN country = 'en' AND {_DRAW} THEN 'valid_seen' WHEN country = 'en' THEN 'fit' WHEN country = 'fr' THEN 'valid' ELSE 'unused' END, 'country_holdout' FROM v WHERE source = 'S1'""",
    "dev_slice": f"""WITH {_RECORDS}, near AS (SELECT *, regexp_matches(lower(business_address), 'the|enver|queé') AS hit FROM v
      ), l AS (SELECT idx, entity_id, row_number() OVER (ORDER BY idx) - 1 AS n FROM near WHERE source = 'S1' AND hit
      ), r AS (SELECT idx, entity_id, row_number() OVER (ORDER BY idx) - 1 AS n FROM near WHERE source <> 'S1' AND (hit OR idx IN (SELECT r_idx FROM truth WHERE l_idx IN (SELECT idx FROM l)))
      ) SELECT 'left' AS part, n AS idx, entity_id FROM l UNION ALL SELECT 'right', n, entity_id FROM r
        UNION ALL SELECT 'truth', l.n, r.n::VARCHAR FROM truth JOIN l ON l.idx = l_idx JOIN r ON r.idx = r_idx""",
    "mine_abbreviations": BS.ABBREVIATIONS,
    "transliterated_words": f"WITH {_RECORDS}, {BS.SOUNDED} SELECT w, f AS foreign, latin FROM sounded",
    "mine_transliterations": f"""WITH {_RECORDS}, {BS.SOUNDED} SELECT latin AS src, count(*) FILTER (WHERE near) AS n, min(CASE WHEN near THEN w END) AS dst
        FROM (SELECT *, length(w) >= 3 AND jaro_winkler_similarity(latin, w) >= 0.7 AS near FROM sounded WHERE f <> w AND length(latin) >= 3 AND latin <> w AND NOT regexp_matches(w, '[0-9]'))
        GROUP BY latin HAVING count(*) FILTER (WHERE near) = 1""",
    "script_of_words": f"""WITH {_RECORDS}, {BS.SOUNDED}, m AS (
        SELECT w, CASE idx % 4 WHEN 0 THEN f || ' ' || translate(w, '{BS.LETTERS}', '{BS.OTHER_SIGNS}') WHEN 1 THEN translate(w, 'aeiou', 'αειοω') WHEN 2 THEN w ELSE f END AS s FROM sounded
      ), n AS (SELECT w, length(regexp_replace(s, '[^\u0900-\u097F]', '', 'g')) AS dev, length(regexp_replace(s, '[^\u0C80-\u0CFF]', '', 'g')) AS kan, length(regexp_replace(s, '[^\u0370-\u03FF]', '', 'g')) AS gre FROM m
      ) SELECT w, CASE WHEN greatest(dev, kan, gre) = 0 THEN 'latin' WHEN dev >= greatest(kan, gre) THEN 'devanagari' WHEN kan >= gre THEN 'kannada' ELSE 'other' END AS script FROM n""",
    "ratio_family": BS.RATIOS,
    "normalized_records": BS.NORMALIZED,
    "full_features": BS.FEATURES,
    "calibrated": f"""WITH {_PAIRS}, lab AS (
        SELECT l_idx, r_idx, p, (t.r_idx IS NOT NULL)::DOUBLE AS y, ('0x' || substr(md5('crossfit:' || l_idx), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 < 0.5 AS half FROM pred LEFT JOIN truth t USING (l_idx, r_idx)
      ), pts AS (SELECT half, p AS x, sum(y) AS s, count(*)::DOUBLE AS w, row_number() OVER (PARTITION BY half ORDER BY p) AS i FROM lab GROUP BY half, p
      ), runs AS (SELECT a.half, a.i AS j, b.i AS k, (SELECT sum(s) / sum(w) FROM pts c WHERE c.half = a.half AND c.i BETWEEN a.i AND b.i) AS m FROM pts a JOIN pts b ON a.half = b.half AND a.i <= b.i
      ), low AS (SELECT q.half, q.i, r.j, min(r.m) AS m FROM pts q JOIN runs r ON r.half = q.half AND r.j <= q.i AND r.k >= q.i GROUP BY ALL
      ), iso AS (SELECT half, i, x, (SELECT max(m) FROM low WHERE low.half = pts.half AND low.i = pts.i) AS v FROM pts
      ), steps AS (SELECT half, x AS x1, v AS v1, lead(x) OVER w AS x2, lead(v) OVER w AS v2, min(x) OVER (PARTITION BY half) AS x0, max(x) OVER (PARTITION BY half) AS x9 FROM iso WINDOW w AS (PARTITION BY half ORDER BY x)
      ) SELECT l_idx, r_idx, round(CASE WHEN x2 IS NULL OR p <= x1 THEN v1 ELSE v1 + (v2 - v1) * (p - x1) / (x2 - x1) END, 6) AS p
        FROM lab JOIN steps ON steps.half <> lab.half AND (p >= x1 AND (x2 IS NULL OR p < x2) OR p < x0 AND x1 = x0)""",
    "truth_report": f"""WITH {_RECORDS}, per AS (SELECT ids.l_idx, count(t.r_idx) AS n FROM ids LEFT JOIN truth t USING (l_idx) GROUP BY ids.l_idx
      ) SELECT (SELECT round(avg((l.country IS DISTINCT FROM r.country)::INT), 6) FROM truth JOIN v l ON l.idx = l_idx JOIN v r ON r.idx = r_idx) AS across,
        (SELECT count(*) FROM (SELECT r_idx FROM truth GROUP BY r_idx HAVING count(DISTINCT l_idx) > 1))::DOUBLE AS many_owners,
        (SELECT round(avg((n = 0)::INT), 6) FROM per) AS singletons, (SELECT round(avg(n), 6) FROM per) AS mean_matches, (SELECT list_sort(list(n))[floor(0.99 * (count(*) - 1) + 0.5)::INT + 1]::DOUBLE FROM per) AS p99_matches""",
    "truth_by_group": f"WITH {_RECORDS} SELECT country, source, count(*) AS n FROM truth JOIN v ON v.idx = r_idx GROUP BY country, source",
    "name_jaro_winkler": f"WITH {_PAIRS} SELECT l_idx, r_idx, round(CASE WHEN a.name_core = '' AND b.name_core = '' THEN 1.0 ELSE jaro_winkler_similarity(a.name_core, b.name_core) END, 6) AS jw FROM cands JOIN v a ON a.idx = l_idx JOIN v b ON b.idx = r_idx",
    "knn_embed": f"""WITH e AS (SELECT vec_id, label, {_VEC.format("embedding")} AS v FROM embeddings
      ), s AS (SELECT l.vec_id AS l_idx, r.vec_id AS r_idx, list_cosine_similarity(l.v, r.v) AS c FROM e l JOIN e r ON l.label = r.label WHERE l.vec_id % 2 = 0 AND r.vec_id % 2 = 1
      ) SELECT l_idx, r_idx, round(c, 6) AS embed_cos FROM s
        QUALIFY row_number() OVER (PARTITION BY l_idx ORDER BY round(c, 9) DESC, r_idx) <= 3 OR row_number() OVER (PARTITION BY r_idx ORDER BY round(c, 9) DESC, l_idx) <= 1""",
    "spend_by_segment": """WITH o AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18, 2)) AS spent FROM orders GROUP BY o_custkey
      ), c AS (SELECT c_mktsegment || '/' || c_nationkey AS grp, c_custkey, spent, round(spent::DOUBLE / (sum(spent) OVER (PARTITION BY c_mktsegment, c_nationkey))::DOUBLE, 6) AS share FROM customer JOIN o ON c_custkey = o_custkey
      ) SELECT grp, c_custkey, spent::DOUBLE AS spent, share FROM c QUALIFY row_number() OVER (PARTITION BY grp ORDER BY spent DESC, c_custkey) <= 2""",
}
