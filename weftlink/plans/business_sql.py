"""SQL that states the normalizers, similarities and features of business records, for another engine."""

from __future__ import annotations

from ..functions import dictionaries as D
from . import business as B
from .views import BLOCK_PAIRS

_WEB = r"\.(?:com|net|org|in|co|fr|biz|info|io|us)\b"
_DBA = r"\b(?:dba|d b a|doing business as)\b"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(x: str, words: dict[str, str], other: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {_text(a)} THEN {_text(b)}" for a, b in words.items()) + f" ELSE {other} END"


def _in(x: str, words) -> str:
    return f"{x} IN ({', '.join(_text(w) for w in sorted(set(words)))})"


def clean(x: str, keep: str = "") -> str:
    plain = f"strip_accents(replace(replace(replace({x}, 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'))"
    low = f"replace(lower(regexp_replace({plain}, '[''’`´]', '', 'g')), '&', ' and ')"
    return f"trim(regexp_replace(regexp_replace({low}, '[^a-z0-9{keep}]+', ' ', 'g'), '\\s+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def mapped(x: str, table: dict[str, str]) -> str:
    """Words of x, each replaced once, as a list."""
    return words(f"array_to_string(list_transform({words(x)}, lambda t: {_case('t', table, 't')}), ' ')")


_EDGE = "(?:" + "|".join(D.EDGE_WORDS) + ")"
_LEGAL_WORD = _in("t", D.LEGAL_FORMS)


def _plain(x: str) -> str:
    s = f"array_to_string(list_filter({x}, lambda t: NOT {_LEGAL_WORD}), ' ')"
    return f"regexp_replace(regexp_replace({s}, '^(?:{_EDGE}(?: |$))+', ''), '(?:(?:^| ){_EDGE})+$', '')"


def _choose(texts: list[str]) -> str:
    return f"CASE role WHEN 0 THEN {texts[0]} WHEN 1 THEN {texts[1]} ELSE {texts[2]} END"


_HOLES = "|".join(["n  a", *D.PLACEHOLDERS])
_PART = f"trim(regexp_replace(replace(regexp_replace(' ' || replace(trim(p), ' ', '  ') || ' ', ' (?:{_HOLES}) ', ' ', 'g'), '  ', ' '), ' +', ' ', 'g'))"
_NOT_NAME = _in("w", [*D.STREET_TYPES, *D.OTHER_WORDS])


def _longest(p: str) -> str:
    own = f"list_filter({p}, lambda w: regexp_full_match(w, '[a-z]{{2,}}') AND NOT {_NOT_NAME})"
    return f"coalesce(list_filter({own}, lambda w: length(w) = list_max(list_transform({own}, lambda v: length(v))))[1], '')"


_NUMBERED = "regexp_matches(t, '[0-9]') AND NOT list_contains(code_words, t)"

#: Tables biz (records) and nrm (their normalized columns).
RECORDS = f"""
biz AS (
  SELECT k * 3 + role AS idx, 'S' || (role + 1) AS source, {B.COUNTRY} AS country, {_choose(B.NAMES)} AS business_name, {_choose(B.ADDRESSES)} AS business_address
  FROM (SELECT p_partkey AS k, p_name FROM part), (VALUES (0), (1), (2)) roles(role)
), n1 AS (
  SELECT *, regexp_matches(lower(trim(business_name)), '{_WEB}') AS web, lower(trim(business_name)) AS low FROM biz
), n2 AS (
  SELECT *, CASE WHEN web THEN regexp_replace(regexp_replace(low, '\\b(?:https?://)?www\\.', ' ', 'g'), '{_WEB}', ' ', 'g') ELSE low END AS bare FROM n1
), n3 AS (
  SELECT *, array_to_string({mapped(clean("bare"), D.NAME_WORDS)}, ' ') AS name_norm FROM n2
), n4 AS (
  SELECT *, {words(f"CASE WHEN regexp_matches(name_norm, '{_DBA}') THEN regexp_extract(name_norm, '^(.*?){_DBA}', 1) ELSE name_norm END")} AS main,
         {words(f"CASE WHEN regexp_matches(name_norm, '{_DBA}') THEN regexp_replace(name_norm, '^.*?{_DBA}', '') ELSE '' END")} AS alt FROM n3
), names AS (
  SELECT idx, source, country, name_norm, CASE WHEN {_plain("main")} <> '' THEN {_plain("main")} ELSE array_to_string(main, ' ') END AS name_core, {_plain("alt")} AS name_alt,
         array_to_string(list_sort(list_distinct(list_filter(list_transform(list_concat(main, alt), lambda t: {_case("t", D.LEGAL_FORMS, "NULL")}), lambda t: t IS NOT NULL))), ' ') AS legal_form,
         web::TINYINT AS is_web FROM n4
), a1 AS (
  SELECT idx, list_filter(list_transform(string_split({clean("business_address", ",")}, ','), lambda p: {mapped(_case(_PART, D.STATES, _PART), D.ADDRESS_WORDS)}), lambda p: len(p) > 0) AS parts FROM biz
), a2 AS (
  SELECT idx, parts, list_filter(flatten(list_transform(parts, lambda p: list_transform(p, lambda t, i:
         CASE WHEN regexp_full_match(t, '[0-9]{{6}}') THEN t
              WHEN regexp_full_match(t, '[0-9]{{3}}') AND regexp_full_match(coalesce(p[i + 1], ''), '[0-9]{{3}}') THEN t || ' ' || p[i + 1]
              WHEN regexp_full_match(t, '[0-9]{{5}}') AND (i = len(p) OR regexp_full_match(p[i + 1], '[0-9]+')) THEN t END))), lambda t: t IS NOT NULL) AS codes FROM a1
), a3 AS (
  SELECT *, coalesce(codes[len(codes)], '') AS code, {words("coalesce(codes[len(codes)], '')")} AS code_words FROM a2
), a4 AS (
  SELECT *, coalesce(list_position(list_transform(parts, lambda p: len(list_filter(p, lambda t: {_NUMBERED})) > 0), true), 0) AS place FROM a3
), addresses AS (
  SELECT idx, array_to_string(flatten(parts), ' ') AS addr_norm, replace(code, ' ', '') AS postcode,
         CASE WHEN place > 0 THEN list_filter(parts[place], lambda t: {_NUMBERED})[1] ELSE '' END AS house_no,
         CASE WHEN place = 0 THEN '' WHEN {_longest("parts[place]")} <> '' THEN {_longest("parts[place]")} ELSE {_longest("coalesce(parts[place + 1], [])")} END AS street_tok,
         array_to_string(list_sort(list_distinct(list_filter(flatten(parts), lambda t: {_NUMBERED}))), ' ') AS num_tokens,
         array_to_string(list_filter(list_transform(parts, lambda p, i: CASE WHEN i <> place THEN array_to_string(list_filter(p, lambda t: NOT regexp_matches(t, '[0-9]')), ' ') ELSE '' END), lambda x: x <> ''), '|') AS localities
  FROM a4
), nrm AS (
  SELECT * FROM names JOIN addresses USING (idx)
)"""

NORMALIZED = f"WITH {RECORDS} SELECT idx, name_norm, name_core, name_alt, legal_form, is_web, addr_norm, postcode, house_no, street_tok, num_tokens, localities FROM nrm"


def _tri(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN -1 WHEN {a} = {b} THEN 1 ELSE 0 END"


def _jac(a: str, b: str, sep: str) -> str:
    x, y = (f"list_filter(string_split({c}, '{sep}'), lambda t: t <> '')" for c in (a, b))
    return f"len(list_intersect(list_distinct({x}), list_distinct({y})))::DOUBLE / nullif(len(list_distinct(list_concat({x}, {y}))), 0)"


_MASKS = "list_transform(string_split(t, ''), lambda ch: list_sum(list_transform(range(1, length(s) + 1), lambda i: CASE WHEN s[i] = ch THEN 1::HUGEINT << (i - 1) ELSE 0::HUGEINT END)))"


def _common(masks: str) -> str:
    """Length of the longest common subsequence, a row of the table in the bits of one integer; s has up to 120 letters."""
    whole = "((1::HUGEINT << length(s)) - 1)"
    return f"(length(s) - bit_count(list_reduce({masks}, lambda r, m: ((r + (r & m)) | (r - (r & m))) & {whole}, {whole})))"


def ratios(wanted_set: str, wanted_ratio: str, wanted_partial: str) -> str:
    """Tables tset, rat and part (a, b, v) of all string pairs (a, b) that the three queries name."""
    return f"""
tq AS (SELECT DISTINCT a, b FROM ({wanted_set})
), t1 AS (SELECT a, b, list_distinct({words("a")}) AS x, list_distinct({words("b")}) AS y FROM tq
), t2 AS (SELECT a, b, x, y, array_to_string(list_sort(list_intersect(x, y)), ' ') AS c, array_to_string(list_sort(list_filter(x, lambda w: NOT list_contains(y, w))), ' ') AS ox,
                 array_to_string(list_sort(list_filter(y, lambda w: NOT list_contains(x, w))), ' ') AS oy FROM t1
), t3 AS (SELECT *, trim(c || ' ' || ox) AS wx, trim(c || ' ' || oy) AS wy FROM t2
), rq AS (SELECT DISTINCT a, b FROM (SELECT wx AS a, wy AS b FROM t3 UNION ALL SELECT c, wx FROM t3 UNION ALL SELECT c, wy FROM t3 UNION ALL {wanted_ratio})
), r1 AS (SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS t FROM rq
), rat AS (SELECT a, b, CASE WHEN t = '' THEN 100.0::DOUBLE WHEN s = '' THEN 0.0::DOUBLE ELSE 200.0::DOUBLE * {_common(_MASKS)} / (length(a) + length(b)) END AS v FROM r1
), tset AS (SELECT t3.a, t3.b, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0::DOUBLE WHEN c <> '' AND (ox = '' OR oy = '') THEN 100.0::DOUBLE WHEN c = '' THEN p.v ELSE greatest(p.v, q.v, r.v) END AS v
            FROM t3 JOIN rat p ON p.a = wx AND p.b = wy JOIN rat q ON q.a = c AND q.b = wx JOIN rat r ON r.a = c AND r.b = wy
), p0 AS (SELECT DISTINCT a, b FROM ({wanted_partial})
), p1 AS (SELECT a, b, a AS s, b AS t FROM p0 WHERE length(a) <= length(b) UNION ALL SELECT a, b, b, a FROM p0 WHERE length(b) <= length(a)
), p2 AS (SELECT *, {_MASKS} AS masks FROM p1
), part AS (SELECT a, b, max(CASE WHEN s = '' THEN CASE WHEN t = '' THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END ELSE 100.0::DOUBLE * list_max(list_transform(range(1 - length(s), length(t)),
              lambda z: 2.0::DOUBLE * {_common("masks[greatest(z, 0) + 1:least(z + length(s), length(t))]")} / (length(s) + least(z + length(s), length(t)) - greatest(z, 0)))) END) AS v FROM p2 GROUP BY a, b
)"""


def _sorted(x: str) -> str:
    return f"array_to_string(list_sort({words(x)}), ' ')"


#: Every left record with its own copy in S2 and the next business's copy in S3, with the Jaccard similarity of their names' words.
_PAIRS = f"""pr AS (
  SELECT l.idx AS l_idx, r.idx AS r_idx, r.source, round(coalesce({_jac("l.name_core", "r.name_core", " ")}, 0.0), 6) AS p,
         {", ".join(f"{s}.{c} AS {s}_{c}" for s in "lr" for c in ("name_core", "name_norm", "name_alt", "legal_form", "is_web", "addr_norm", "postcode", "house_no", "street_tok", "num_tokens", "localities"))}
  FROM nrm l JOIN nrm r ON r.idx IN (l.idx + 1, l.idx + 5) WHERE l.source = 'S1'
)"""


def _cosine(name: str, col: str, grams: str) -> str:
    return f"""{name}_g AS (SELECT idx, gram, count(*) AS tf FROM (SELECT idx, unnest({grams}) AS gram FROM (SELECT idx, unnest(string_split({col}, ' ')) AS w FROM nrm) WHERE w <> '') GROUP BY ALL
), {name}_w AS (SELECT idx, gram, (1 + ln(tf)) * (1 + ln((1 + (SELECT count(*) FROM nrm)) / (1 + df))) AS w FROM (SELECT *, count(*) OVER (PARTITION BY gram) AS df FROM {name}_g) WHERE df >= 2
), {name}_n AS (SELECT idx, gram, w / sqrt(sum(w * w) OVER (PARTITION BY idx)) AS w FROM {name}_w
), {name} AS (SELECT l_idx, r_idx, sum(a.w * b.w) AS v FROM pr JOIN {name}_n a ON a.idx = l_idx JOIN {name}_n b ON b.idx = r_idx AND a.gram = b.gram GROUP BY ALL
)"""


_ALT = {s: f"CASE WHEN {s}_name_alt <> '' THEN {s}_name_alt ELSE {s}_name_core END" for s in "lr"}
_BARE = {s: f"replace({s}_name_core, ' ', '')" for s in "lr"}
_NUMS = {s: f"array_to_string(regexp_extract_all({s}_name_core, '[0-9]+'), ' ')" for s in "lr"}
_SETS = [("l_name_core", "r_name_core"), ("l_addr_norm", "r_addr_norm"), ("l_name_norm", "r_name_norm"), (_ALT["l"], "r_name_core"), ("l_name_core", _ALT["r"]), ("r_name_core", "o_name"), ("r_addr_norm", "o_addr")]
_RATIOS = [("l_name_core", "r_name_core"), (_sorted("l_name_core"), _sorted("r_name_core")), (_BARE["l"], _BARE["r"]), ("l_addr_norm", "r_addr_norm")]
_PARTIALS = [("l_name_core", "r_name_core"), ("l_addr_norm", "r_addr_norm")]


def _union(pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT {a} AS a, {b} AS b FROM cx WHERE {b} IS NOT NULL" for a, b in pairs)


def _value(table: str, a: str, b: str) -> str:
    return f"round((SELECT v FROM {table} WHERE {table}.a = {a} AND {table}.b = {b}), 6)"


_DIFF = "greatest(length(l_name_core), length(r_name_core))"

FEATURES = f"""WITH {RECORDS}, {_PAIRS}, c1 AS (
  SELECT *, row_number() OVER (PARTITION BY l_idx ORDER BY p DESC, r_idx) AS rank_l, max(p) OVER (PARTITION BY l_idx) - p AS gap_l, count(*) OVER (PARTITION BY l_idx) AS n_cands_l,
         count(*) OVER (PARTITION BY r_idx) AS n_claims_r, row_number() OVER (PARTITION BY r_idx ORDER BY p DESC, l_idx) AS rank_r FROM pr
), cx AS (
  SELECT c1.*, o.r_name_core AS o_name, o.r_addr_norm AS o_addr
  FROM c1 LEFT JOIN (SELECT l_idx, r_name_core, r_addr_norm, rank_l AS k FROM c1) o ON o.l_idx = c1.l_idx AND o.k = CASE WHEN c1.rank_l = 1 THEN 2 ELSE 1 END
), {ratios(_union(_SETS), _union(_RATIOS), _union(_PARTIALS))}, {_cosine("cc", "name_core", "list_transform(range(1, greatest(length(w), 1) + 1), lambda i: substr(' ' || w || ' ', i, 3))")},
{_cosine("cw", "name_core", "[w]")}, {_cosine("ca", "addr_norm", "[w]")}
SELECT cx.l_idx, cx.r_idx, CASE WHEN p >= 0.1 THEN p ELSE 0.0 END AS tfidf_name, 0.0::DOUBLE AS tfidf_name_addr, 0.0::DOUBLE AS embed_cos, 1 AS from_keys,
  round(CASE WHEN l_name_core = '' AND r_name_core = '' THEN 1.0 ELSE jaro_winkler_similarity(l_name_core, r_name_core) END, 6) AS name_jw,
  {_value("tset", *_SETS[0])} AS name_tset, {_value("tset", *_SETS[1])} AS addr_tset, {_tri("l_postcode", "r_postcode")} AS postcode_eq, {_tri("l_house_no", "r_house_no")} AS house_eq, (source = 'S3')::INT AS source_s3,
  p AS cheap_score, rank_l, round(gap_l, 6) AS gap_l, n_cands_l, n_claims_r, rank_r, (rank_l = 1 AND rank_r = 1)::INT AS mutual_best,
  {_value("tset", *_SETS[5])} AS sim_other_name, {_value("tset", *_SETS[6])} AS sim_other_addr,
  {_value("rat", *_RATIOS[0])} AS name_ratio, {_value("rat", *_RATIOS[1])} AS name_tsort, {_value("part", *_PARTIALS[0])} AS name_partial,
  round(CASE WHEN {_DIFF} = 0 THEN 1.0 ELSE 1.0 - levenshtein(l_name_core, r_name_core)::DOUBLE / {_DIFF} END, 6) AS name_lev,
  {_value("tset", *_SETS[2])} AS name_norm_tset, {_value("rat", *_RATIOS[2])} AS name_nospace_ratio, greatest({_value("tset", *_SETS[3])}, {_value("tset", *_SETS[4])}) AS name_alt_tset,
  {_tri("l_legal_form", "r_legal_form")} AS legal_eq, (string_split(l_name_core, ' ')[1] = string_split(r_name_core, ' ')[1] AND l_name_core <> '')::INT AS first_tok_eq,
  round(least(length(l_name_core), length(r_name_core))::DOUBLE / greatest({_DIFF}, 1), 6) AS len_ratio, {_tri(_NUMS["l"], _NUMS["r"])} AS name_num_eq,
  round(coalesce(cc.v, 0.0), 6) AS name_char_cos, round(coalesce(cw.v, 0.0), 6) AS name_word_cos, 0 AS l_nonlatin, 0 AS r_nonlatin, l_is_web AS l_web, r_is_web AS r_web,
  {_value("rat", *_RATIOS[3])} AS addr_ratio, {_value("part", *_PARTIALS[1])} AS addr_partial, round(coalesce(ca.v, 0.0), 6) AS addr_word_cos,
  round({_jac("l_localities", "r_localities", "|")}, 6) AS loc_jaccard, round({_jac("l_num_tokens", "r_num_tokens", " ")}, 6) AS num_jaccard, {_tri("l_street_tok", "r_street_tok")} AS street_eq,
  (l_addr_norm = '')::INT AS l_addr_empty, (r_addr_norm = '')::INT AS r_addr_empty
FROM cx LEFT JOIN cc USING (l_idx, r_idx) LEFT JOIN cw USING (l_idx, r_idx) LEFT JOIN ca USING (l_idx, r_idx)"""

RATIOS = f"""WITH {RECORDS}, {_PAIRS}, cx AS (SELECT * FROM pr), {ratios(_union(_SETS[:1]), _union(_RATIOS[:2]), _union(_PARTIALS[:1]))}
SELECT l_idx, r_idx, {_value("rat", *_RATIOS[0])} AS ratio, {_value("part", *_PARTIALS[0])} AS partial_ratio, {_value("rat", *_RATIOS[1])} AS token_sort_ratio, {_value("tset", *_SETS[0])} AS token_set_ratio FROM cx"""


# Letters and consonant signs of two scripts that stand for them.
LETTERS = "bcdghjklmnprstv"
SIGNS = "बचदगहजकलमनपरसतव"
OTHER_SIGNS = "ಬಚದಗಹಜಕಲಮನಪರಸತವ"
_SPELLED = dict(zip(SIGNS, LETTERS))


def _sound(x: str) -> str:
    """Signs spelled out: one with another right after it keeps its vowel, the last of a run has none."""
    for sign, letter in _SPELLED.items():
        x = f"replace({x}, '{sign}', '<{letter}>')"
    return f"replace(replace(replace({x}, '><', 'a'), '<', ''), '>', '')"


#: Words of the records' names, each once with its least record, in other signs and spelled out again.
SOUNDED = f"""sw AS (
  SELECT w, min(idx) AS idx FROM (SELECT idx, unnest(string_split(name_core, ' ')) AS w FROM v) WHERE length(w) >= 4 GROUP BY w
), sounded AS (
  SELECT w, idx, translate(w, '{LETTERS}', '{SIGNS}') AS f, {_sound(f"translate(w, '{LETTERS}', '{SIGNS}')")} AS latin FROM sw
)"""

_FITS = "NOT regexp_matches(t, '[0-9]') AND length(src) >= 2 AND length(src) < length(t) AND regexp_matches(t, '^' || array_to_string(string_split(src, ''), '.*'))"

ABBREVIATIONS = f"""WITH {RECORDS}, c AS (
  SELECT idx, {words(clean("business_name"))} AS name, {words(clean("business_address"))} AS addr FROM biz
), pr AS (
  SELECT l.name AS ln, r.name AS rn, l.addr AS la, r.addr AS ra FROM c l JOIN c r ON r.idx IN (l.idx + 1, l.idx + 2) WHERE l.idx % 3 = 0
), sided AS (
  SELECT 'name' AS field, ln AS x, rn AS y FROM pr UNION ALL SELECT 'name', rn, ln FROM pr UNION ALL SELECT 'addr', la, ra FROM pr UNION ALL SELECT 'addr', ra, la FROM pr
), lone AS (
  SELECT field, list_distinct(list_filter(x, lambda t: NOT list_contains(y, t))) AS a, list_distinct(list_filter(y, lambda t: NOT list_contains(x, t))) AS b FROM sided
), src AS (
  SELECT field, b, unnest(list_filter(a, lambda t: NOT regexp_matches(t, '[0-9]'))) AS src FROM lone
), fit AS (
  SELECT field, src, list_filter(b, lambda t: {_FITS}) AS dsts FROM src
), tot AS (
  SELECT field, src, sum(greatest(len(dsts), 1)) AS total FROM fit GROUP BY ALL
), n AS (
  SELECT field, src, dst, count(*) AS n FROM (SELECT field, src, unnest(dsts) AS dst FROM fit) GROUP BY ALL
) SELECT field, src, dst, n FROM n JOIN tot USING (field, src) WHERE n >= 2 AND n::DOUBLE / total >= 0.5 QUALIFY row_number() OVER (PARTITION BY field, src ORDER BY n DESC, dst) = 1"""
