"""Queries opN_<name> over the test tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import forest, linecrf, linededup, mixing, ngramjoin, packing, passages, repetition, storage, warc


def tokenizer_path() -> str:
    """The vocabulary file; the environment may name another place."""
    import os

    import public_tokenizers

    return os.environ.get("WEFTLINK_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repetition.quality_rules(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    chain = linecrf.train(docs, _table(spark, sf_dir, "labels"))
    out = linecrf.score_documents(docs, chain)
    return out.select("doc_id", linecrf.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passages.drop_passages(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngramjoin.jaccard_groups(_table(spark, sf_dir, "documents"), size=3, percent=90)
    return out.select("doc_id", "n_shingles", "component_id")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_round_trip(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_binary_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.fresh_path(spark, "shards")
    manifest = packing.write_shards(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return packing.read_shards(spark, path, manifest)


def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op5_line_dedup": op5_line_dedup,
    "op6_projection_forest": op6_projection_forest,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op7_binary_shards": op7_binary_shards,
    "op1_warc": op1_warc,
    "op10_ngram_join": op10_ngram_join,
    "op8_passage_dedup": op8_passage_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op9_line_crf": op9_line_crf,
    "op4_mix_sources": op4_mix_sources,
}

_COUNTED = "aeionrstld"
_CLOSE = " + ".join(f"abs(a.c{i} - b.c{i})" for i in range(len(_COUNTED)))

SQL = {
    # letter counts of lines within two edits differ by four at most in all; the rest is compared by brute force
    "op5_line_dedup": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, pos, line FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM d)
  WHERE length(line) >= 9 OR regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]')
), u AS (
  SELECT line, length(line) AS n, {", ".join(f"length(line) - length(replace(line, '{c}', '')) AS c{i}" for i, c in enumerate(_COUNTED))}
  FROM (SELECT DISTINCT line FROM l WHERE length(line) >= 9)
), near AS (
  SELECT a.line AS x, b.line AS y FROM u a JOIN u b ON b.n BETWEEN a.n AND a.n + 2 AND a.line <> b.line AND {_CLOSE} <= 4 WHERE levenshtein(a.line, b.line) <= 2
), links AS (
  SELECT x, y FROM near UNION SELECT y, x FROM near
), reach AS (
  SELECT x AS line, x AS r FROM links UNION SELECT reach.line, links.y FROM reach JOIN links ON links.x = reach.r
), class AS (
  SELECT line, min(r) AS class FROM reach GROUP BY line
), placed AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY coalesce(class, l.line) ORDER BY doc_id, pos) AS k FROM l LEFT JOIN class ON class.line = l.line
), gone AS (
  SELECT doc_id, count(*) AS n, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS removed FROM placed WHERE k > 1 GROUP BY doc_id
)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed FROM d LEFT JOIN gone USING (doc_id)
""",
    "op6_projection_forest": """
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id, vec_id AS r FROM e UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.r
), least AS (
  SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id
)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM least
""",
    "op1_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to
FROM m
""",
    "op10_ngram_join": """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 2], ' ')) AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)
  UNION ALL SELECT doc_id, md5(array_to_string(ws, ' ')) FROM d WHERE len(ws) IN (1, 2)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), links AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN n USING (doc_id)
""",
    "op8_passage_dedup": """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), spots AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)
), lowest AS (
  SELECT w, min(doc_id) AS m FROM spots GROUP BY w HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM spots JOIN lowest USING (w) WHERE doc_id > m
), g AS (
  SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN js IS NULL THEN ws ELSE list_filter(ws, lambda x, k: NOT list_contains(js, k)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
""",
    "op3_quality_rules": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), spots AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d
), w5 AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 4]) AS c FROM spots WHERE i + 4 <= len(ws)
), w16 AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 15]) AS c FROM spots WHERE i + 15 <= len(ws)
), w61 AS (
  SELECT doc_id, max(c) > 1 AS too_long
  FROM (SELECT doc_id, count(*) AS c FROM spots WHERE i + 60 <= len(ws) AND doc_id IN (SELECT doc_id FROM w16 WHERE c > 1) GROUP BY doc_id, ws[i:i + 60]) GROUP BY doc_id
), c5 AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM w5 WHERE c > 1) GROUP BY doc_id
), c16 AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 16)) AS j FROM w16 WHERE c > 1) GROUP BY doc_id
), base AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(c5.n, 0)::BIGINT AS n_repeat_words, coalesce(c16.n, 0) AS covered, coalesce(too_long, false) AS too_long
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN c5 USING (doc_id) LEFT JOIN c16 USING (doc_id) LEFT JOIN w61 USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * covered <= 10 * n_words AND NOT too_long AS kept
FROM base
""",
    "op4_mix_sources": """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM per
), levels AS (
  SELECT source, source_size, cap, w,
         (sum(source_size) OVER ())::DOUBLE AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM ranked
), picked AS (
  SELECT arg_min((total - held) / free, cap / w) FILTER (WHERE (total - held) / free <= cap / w) AS level FROM levels
), targets AS (
  SELECT source, source_size, least(cap, w * coalesce(level, 0)) AS target FROM levels, picked
), rates AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates
""",
}
