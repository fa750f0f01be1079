"""Text normalizers, scripts, sound codes and similarities on literals."""

import random

import pytest
from pyspark.sql import functions as F

from weftlink.functions import phonetics, scripts, similarity as S, text


def normal(spark, rows, learned=None):
    df = spark.createDataFrame(rows, "business_name string, business_address string")
    return text.normalized(df, learned).collect()


def test_scripts():
    assert scripts.script_of("ಮೈಸೂರು ಅಂಗಡಿ") == "kannada" and scripts.script_of("Shop नमक") == "devanagari" and scripts.script_of("Crème brûlée") == scripts.script_of("12-3") == "latin"
    assert scripts.to_latin("नमक दाल") == "namak dal" and scripts.to_latin("कमल बाज़ार") == "kamal bajar"
    # most consonants lose their vowel at a word's end, some keep it; a nasal goes by what follows; a danda ends a word
    assert scripts.to_latin("बाळ") == "bala" and scripts.to_latin("कंबल") == "kambal" and scripts.to_latin("रंग।जल") == "rang|jal"


def test_latin_letters_fold_alike_in_both_paths(spark):
    letters = [chr(o) for o in range(0xC0, 0x250)]
    rows = spark.createDataFrame([(c, f"a{c}b {c}") for c in letters], "c string, s string").select("c", "s", scripts.fold_latin(F.col("s")).alias("jvm")).collect()
    assert [(r.c, r.jvm) for r in rows if r.jvm != scripts.to_latin(r.s)] == [] and len(rows) == len(letters)
    got = spark.createDataFrame([("Þrándur Ŋuŋi Ĳssel Ltd",)], "s string").select(text.clean(F.col("s")).alias("a"), text.clean(F.col("s"), any_script=False).alias("b")).first()
    assert got.a == got.b == "thrandur ngungi ijssel ltd"


def test_names(spark):
    cases = {
        "Ltd. Brook & Fern Pvt": ("brook and fern", "ltd pvt", "", 0),
        "Ñandú Travel Inc": ("nandu travel", "inc", "", 0),
        "++ Old Mill LLC Bakery": ("old mill bakery", "llc", "", 0),
        "The Larch and Company of": ("larch", "co", "", 0),
        "Orbit Intl Mfg": ("orbit international manufacturing", "", "", 0),
        "www.quillandvane.org": ("quillandvane", "", "", 1),
        "Tern Partners LLC dba Tern Coffee": ("tern partners", "llc", "tern coffee", 0),
        "कमल लिमिटेड": ("kamal", "ltd", "", 0),
        "LLC": ("llc", "llc", "", 0),
        None: ("", "", "", 0),
    }
    got = normal(spark, [(n, "") for n in cases], {"name": {"limited": "ltd"}})
    assert [(r.name_core, r.legal_form, r.name_alt, r.is_web) for r in got] == list(cases.values())
    assert got[7].name_script == "devanagari" and got[1].name_script == "latin" and got[1].name_key == "NNT TRFL"


ADDRESSES = {
    "FAIRMONT, NC, 8 3/4 JUNIPER WALK": ("fairmont north carolina 8 3 4 juniper walk", "", "8", "juniper", "3 4 8", "fairmont|north carolina"),
    "77 OAK ST, DELMAR, TX": ("77 oak street delmar texas", "", "77", "oak", "77", "delmar|texas"),
    "90210 Cedar Road, Milford, OK": ("90210 cedar road milford oklahoma", "", "90210", "cedar", "90210", "milford|oklahoma"),
    "Nantes, 44000": ("nantes 44000", "44000", "", "", "", "nantes"),
    "5 Hill St, Salem OR 97301": ("5 hill street salem or 97301", "97301", "5", "salem", "5", "salem or"),
    "N/A, null, 5 Hill St, Salem": ("5 hill street salem", "", "5", "salem", "5", "salem"),
    "None": ("", "", "", "", "", ""),
    "": ("", "", "", "", "", ""),
    "Canal View Block C": ("canal view block c", "", "", "", "", "canal view block c"),
}


def test_addresses(spark):
    got = normal(spark, [("x", a) for a in ADDRESSES])
    assert [(r.addr_norm, r.postcode, r.house_no, r.street_tok, r.num_tokens, r.localities) for r in got] == list(ADDRESSES.values())
    r = normal(spark, [("x", "Flat No 27, 9Th Cross, 3Rd Main Indira Layout, Mysuru South, Mysuru, 570 023")])[0]
    assert (r.postcode, r.house_no) == ("570023", "27") and "mysuru" in r.localities.split("|") and "570" not in r.num_tokens.split()


def test_clean(spark):
    row = spark.range(1).select(text.clean(F.lit("Finn’s  Tool+Die & Son,")).alias("a"), text.clean(F.lit("Q_12/7, Rosewood,End"), True).alias("b"), text.clean(F.lit("Châlet d'Été"), any_script=False).alias("c")).first()
    assert tuple(row) == ("finns tool die and son", "q 12 7, rosewood,end", "chalet dete")


def test_metaphone():
    assert {w: phonetics.metaphone(w) for w in ("thumb", "knight", "phone", "which", "school", "xavier", "science")} == {
        "thumb": "0M", "knight": "NT", "phone": "FN", "which": "WX", "school": "SKL", "xavier": "SFR", "science": "SNS",
    }


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def test_ratios():
    r = random.Random(1)
    for _ in range(800):
        a, b = ("".join(r.choice("abc d") for _ in range(r.randint(0, n))) for n in (12, 18))
        assert S.lcs_length(a, b) == lcs(a, b)
        best = 100.0 * (a == b) if not a or not b else 0.0
        for s, t in ((a, b), (b, a)) if len(a) == len(b) else ((a, b) if len(a) < len(b) else (b, a),):
            for at in range(1 - len(s), len(t)) if a and b else ():
                best = max(best, S.ratio(s, t[max(at, 0) : at + len(s)]))
        assert S.partial_ratio(a, b) == pytest.approx(best)
    words = ["", "a", "ab ba", "x y z", "long " * 30, "gnol " * 40, "é ü", "ab"]
    left = [r.choice(words) + "".join(r.choice("ab c") for _ in range(r.randint(0, 70))) for _ in range(400)]
    right = [r.choice(words) + "".join(r.choice("ab c") for _ in range(r.randint(0, 90))) for _ in range(400)]
    for batch, one in ((S.ratios, S.ratio), (S.token_sort_ratios, S.token_sort_ratio), (S.token_set_ratios, S.token_set_ratio)):
        assert batch(left, right).tolist() == pytest.approx([one(x, y) for x, y in zip(left, right)]) and len(batch([], [])) == 0
    assert S.ratio("", "") == 100 and S.token_sort_ratio("b a", "a b") == 100 and S.token_set_ratio("a b", "a b c") == 100 and S.token_set_ratio("", "a") == 0
    assert S.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6) and S.jaro_winkler("", "") == 1 and S.jaro_winkler("a", "") == 0


def test_native_similarities(spark):
    df = spark.createDataFrame([("a b 1", "a c 2"), ("", "x"), ("", ""), ("abc", "abc")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = df.select(S.tri_equal(a, b), S.jaccard(a, b), S.levenshtein_similarity(a, b), S.length_ratio(a, b), S.first_word_equal(a, b), S.numbers(a)).collect()
    assert [tuple(r) for r in got] == [(0, 0.2, 0.6, 1.0, 1, "1"), (-1, 0.0, 0.0, 0.0, 0, ""), (-1, None, 1.0, 0.0, 0, ""), (1, 1.0, 1.0, 1.0, 1, "")]
    pairs = spark.createDataFrame([("intl", "international"), ("st", "street"), ("ts", "street"), ("street", "st"), ("s", "street"), ("sx", "street")], "a string, b string")
    assert [r[0] for r in pairs.select(S.subsequence_abbreviation(a, b)).collect()] == [True, True, False, False, False, False]
