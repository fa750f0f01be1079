"""Normalizers of names and addresses as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dictionaries as D
from .phonetics import metaphone_words
from .scripts import fold_latin, latin, script

#: Columns that normalized() adds to a record.
NORMAL_COLUMNS = [
    "name_norm", "name_core", "name_alt", "legal_form", "is_web", "name_key", "name_script",
    "addr_norm", "postcode", "house_no", "street_tok", "num_tokens", "localities",
]
# Endings of web names, and what stands before a trade name.
_WEB = r"\.(?:com|net|org|in|co|fr|biz|info|io|us)\b"
_TRADING_AS = r"\b(?:dba|d b a|doing business as)\b"


def word_map(words: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(words.items())]) if words else F.lit(None).cast("map<string,string>")


def clean(c: Column, commas: bool = False, any_script: bool = True) -> Column:
    """Lower-case ASCII words, one space apart; commas are kept on demand.

    any_script=False stays in the JVM and is meant for text in Latin letters.
    """
    c = latin(c) if any_script else fold_latin(c)
    c = F.replace(F.lower(F.translate(c, "'’`´", "")), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(c, "[^a-z0-9,]+" if commas else "[^a-z0-9]+", " "))


def words(c: Column) -> Column:
    """Words of a cleaned string; none for an empty one."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def mapped(tokens: Column, fixed: dict[str, str], learned: dict[str, str] | None = None) -> Column:
    """Each word replaced once, by the fixed list first, then by the learned one; values of several words come apart."""
    first, second = word_map(fixed), word_map(learned or {})

    def one(t):
        return F.coalesce(F.try_element_at(first, t), F.try_element_at(second, t), t) if learned else F.coalesce(F.try_element_at(first, t), t)

    return words(F.array_join(F.transform(tokens, one), " "))


def without_edges(tokens: Column) -> Column:
    edge = "(?:" + "|".join(D.EDGE_WORDS) + ")"
    s = F.array_join(tokens, " ")
    s = F.regexp_replace(s, f"^(?:{edge}(?: |$))+", "")
    return words(F.regexp_replace(s, f"(?:(?:^| ){edge})+$", ""))


def name_words(raw: Column, learned: dict[str, str] | None = None, any_script: bool = True) -> tuple[Column, Column]:
    """Whether a raw name is a web name, and its cleaned words in one string, abbreviations spelled out."""
    low = F.lower(F.trim(raw))
    web = low.rlike(_WEB)
    bare = F.regexp_replace(F.regexp_replace(low, r"\b(?:https?://)?www\.", " "), _WEB, " ")
    return web.cast("byte"), F.array_join(mapped(words(clean(F.when(web, bare).otherwise(low), any_script=any_script)), D.NAME_WORDS, learned), " ")


def trade_sides(norm: Column) -> tuple[Column, Column]:
    """Words before and after what stands before a trade name."""
    sides = F.split(norm, _TRADING_AS, 2)
    return words(F.trim(F.element_at(sides, 1))), words(F.trim(F.coalesce(F.try_element_at(sides, F.lit(2)), F.lit(""))))


def without_forms(tokens: Column) -> Column:
    """Words without legal forms and without words that go at the ends."""
    forms = word_map(D.LEGAL_FORMS)
    return without_edges(F.filter(tokens, lambda t: F.try_element_at(forms, t).isNull()))


def legal_forms(tokens: Column) -> Column:
    forms = word_map(D.LEGAL_FORMS)
    return F.array_sort(F.array_distinct(F.filter(F.transform(tokens, lambda t: F.try_element_at(forms, t)), lambda t: t.isNotNull())))


def postcode_text(address: Column) -> Column:
    """Words of the last postcode in an address of parts split by commas, '' if there is none.

    Six digits, three and three, or five that end a part or stand before another number.
    The pattern looks ahead only, so that candidates may overlap.
    """
    end = "(?![^ ,])"
    found = F.regexp_extract_all(address, F.lit(rf"(?<![^ ,])(?=(\d{{6}}{end}|\d{{3}} \d{{3}}{end}|\d{{5}}(?= \d+{end}|,|$)))"), F.lit(1))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))


def address_parts(raw: Column, learned: dict[str, str] | None = None, any_script: bool = True) -> Column:
    """The comma parts of an address as arrays of words, placeholders gone, states and abbreviations spelled out."""
    holes = "(?<![^ ])(?:n a|" + "|".join(D.PLACEHOLDERS) + ")(?![^ ])"
    states = word_map(D.STATES)

    def part(p):
        p = F.trim(F.regexp_replace(F.regexp_replace(F.trim(p), holes, ""), " +", " "))
        return mapped(words(F.coalesce(F.try_element_at(states, p), p)), D.ADDRESS_WORDS, learned)

    return F.filter(F.transform(F.split(clean(raw, True, any_script), ","), part), lambda p: F.size(p) > 0)


def _numbers(p: Column, code_words: Column) -> Column:
    return F.filter(p, lambda t: t.rlike("[0-9]") & ~F.array_contains(code_words, t))


def address_columns(parts: Column, code: Column, code_words: Column, at: Column) -> dict[str, Column]:
    """addr_norm, postcode, house_no, street_tok, num_tokens and localities.

    parts come from address_parts, code and its words from postcode_text; at is the place,
    from 1, of the first part with a number beyond the postcode, 0 if there is none. They
    are columns and no expressions, since a lambda evaluates what it holds for every word.
    """
    house = F.coalesce(F.try_element_at(_numbers(F.try_element_at(parts, F.when(at > 0, at).cast("int")), code_words), F.lit(1)), F.lit(""))
    not_names = "^(?:" + "|".join(sorted({*D.STREET_TYPES, *D.OTHER_WORDS})) + ")$"

    def longest(p):
        own = F.filter(p, lambda t: t.rlike("^[a-z]{2,}$") & ~t.rlike(not_names))
        return F.aggregate(own, F.lit(""), lambda best, t: F.when(F.length(t) > F.length(best), t).otherwise(best))

    near = F.filter(F.transform(F.slice(parts, F.greatest(at, F.lit(1)).cast("int"), 2), longest), lambda t: t != "")
    street = F.when(at > 0, F.coalesce(F.try_element_at(near, F.lit(1)), F.lit(""))).otherwise(F.lit(""))
    numbers_all = F.array_except(F.array_sort(F.array_distinct(F.filter(F.flatten(parts), lambda t: t.rlike("[0-9]")))), code_words)
    places = F.transform(parts, lambda p, i: F.when(i + 1 != at, F.array_join(F.filter(p, lambda t: ~t.rlike("[0-9]")), " ")))
    return {
        "addr_norm": F.array_join(F.flatten(parts), " "), "postcode": F.replace(code, F.lit(" "), F.lit("")), "house_no": house, "street_tok": street,
        "num_tokens": F.array_join(numbers_all, " "), "localities": F.array_join(F.filter(places, lambda x: x.isNotNull() & (x != "")), "|"),
    }


def normalized(df, learned: dict[str, dict[str, str]] | None = None, name_col: str = "business_name", address_col: str = "business_address", any_script: bool = True):
    """df with NORMAL_COLUMNS; nulls count as empty.

    Each step is projected once and read by all that follow: an expression that several
    others hold would be planned and evaluated once for each of them.
    """
    learned = learned or {}
    name, address = F.coalesce(F.col(name_col), F.lit("")), F.coalesce(F.col(address_col), F.lit(""))
    web, norm = name_words(name, learned.get("name"), any_script)
    out = df.withColumns({"__web": web, "__norm": norm, "__script": script(name), "__parts": address_parts(address, learned.get("addr"), any_script)})
    main, alt = trade_sides(F.col("__norm"))
    parts = F.col("__parts")
    out = out.withColumns({"__main": main, "__alt": alt, "__code": postcode_text(F.array_join(F.transform(parts, lambda p: F.array_join(p, " ")), ","))})
    out = out.withColumns({"__plain": without_forms(F.col("__main")), "__code_words": words(F.col("__code"))})
    out = out.withColumns({
        "__core": F.when(F.size("__plain") > 0, F.col("__plain")).otherwise(F.col("__main")),
        "__at": F.array_position(F.transform(parts, lambda p: F.size(_numbers(p, F.col("__code_words"))) > 0), True),
    })
    made = {
        "name_norm": F.col("__norm"), "name_core": F.array_join("__core", " "), "name_alt": F.array_join(without_forms(F.col("__alt")), " "),
        "legal_form": F.array_join(legal_forms(F.concat("__main", "__alt")), " "), "is_web": F.col("__web"), "name_key": metaphone_words(F.array_join(F.slice("__core", 1, 2), " ")), "name_script": F.col("__script"),
    }
    return out.withColumns(made | address_columns(parts, F.col("__code"), F.col("__code_words"), F.col("__at"))).select(*df.columns, *NORMAL_COLUMNS)
