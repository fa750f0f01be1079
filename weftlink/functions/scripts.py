"""Script detection and transliteration to plain Latin letters."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dictionaries import SCRIPTS

#: Letters that canonical decomposition does not reduce to ASCII (fixed values).
_SPELLED = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D",
    "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "ı": "i", "ħ": "h", "Ħ": "H", "ŋ": "ng", "Ŋ": "NG", "–": "-", "—": "-",
    "‘": "'", "’": "'", "“": '"', "”": '"', "…": "...", "€": "EUR", "£": "GBP",
}
# Sounds of an Indic block by its offset from the block's start (fixed values; the blocks are laid out alike).
_VOWELS = {5: "a", 6: "a", 7: "i", 8: "i", 9: "u", 10: "u", 11: "r", 12: "l", 14: "e", 15: "e", 16: "ai", 18: "o", 19: "o", 20: "au"}
_CONSONANTS = {
    0x15: "k", 0x16: "kh", 0x17: "g", 0x18: "gh", 0x19: "n", 0x1A: "c", 0x1B: "ch", 0x1C: "j", 0x1D: "jh", 0x1E: "n",
    0x1F: "t", 0x20: "th", 0x21: "d", 0x22: "dh", 0x23: "n", 0x24: "t", 0x25: "th", 0x26: "d", 0x27: "dh", 0x28: "n",
    0x2A: "p", 0x2B: "ph", 0x2C: "b", 0x2D: "bh", 0x2E: "m", 0x2F: "y", 0x30: "r", 0x31: "r", 0x32: "l", 0x33: "l",
    0x34: "l", 0x35: "v", 0x36: "s", 0x37: "s", 0x38: "s", 0x39: "h",
}
_SIGNS = {0x3E: "a", 0x3F: "i", 0x40: "i", 0x41: "u", 0x42: "u", 0x43: "r", 0x46: "e", 0x47: "e", 0x48: "ai", 0x4A: "o", 0x4B: "o", 0x4C: "au"}
#: Consonants, by offset, that keep their vowel at a word's end (fixed values).
_KEEP_VOWEL = {0x29, 0x31, 0x33, 0x34}
#: Marks by offset (fixed values).
_MARKS = {0x3D: "'", 0x64: "|", 0x65: "||"}
_VIRAMA, _NUKTA, _NASALS, _VISARGA = 0x4D, 0x3C, (0x01, 0x02), 0x03


def _block_start(ch: str) -> int | None:
    return next((lo for _, lo, hi in SCRIPTS if lo <= ord(ch) <= hi), None)


def _indic(word: str) -> str:
    """Sound out one run of Indic characters: consonants carry 'a' unless a sign or virama follows, and most lose it at a word's end."""
    out: list[str] = []
    bare = keeps = False  # the last consonant still carries its own vowel, and does so at a word's end
    for i, ch in enumerate(word):
        start = _block_start(ch)
        if start is None:
            if bare:
                bare = False
            out.append(ch)
            continue
        at = ord(ch) - start
        if at in _CONSONANTS:
            if bare:
                out.append("a")
            out.append(_CONSONANTS[at])
            bare, keeps = True, at in _KEEP_VOWEL
        elif at in _SIGNS:
            out.append(_SIGNS[at])
            bare = False
        elif at == _VIRAMA:
            bare = False
        elif at in _VOWELS:
            if bare:
                out.append("a")
            out.append(_VOWELS[at])
            bare = False
        elif at in _NASALS:
            if bare:
                out.append("a")
                bare = False
            ahead = word[i + 1] if i + 1 < len(word) else ""
            labial = bool(ahead) and _block_start(ahead) is not None and _CONSONANTS.get(ord(ahead) - _block_start(ahead), "")[:1] in tuple("pbm")
            out.append("m" if labial else "n")
        elif at == _VISARGA:
            out.append("ah" if bare else "h")
            bare = False
        elif 0x66 <= at <= 0x6F:
            if bare:
                out.append("a")
                bare = False
            out.append(str(at - 0x66))
        elif at in _MARKS:
            out.append("a" * (bare and keeps) + _MARKS[at])
            bare = False
        elif at != _NUKTA:
            continue
    return "".join(out) + "a" * (bare and keeps)


@lru_cache(maxsize=100_000)
def to_latin(text: str) -> str:
    """Plain Latin spelling: Indic scripts by sound, accents dropped, what has no spelling dropped."""
    text = unicodedata.normalize("NFKC", text)
    text = re.sub("[ऀ-ൿ‌‍]+", lambda m: _indic(m.group().replace("‌", "").replace("‍", "")), text)
    text = "".join(_SPELLED.get(c, c) for c in text)
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def script_of(text: str) -> str:
    """The script with the most characters beyond extended Latin; the first one seen wins ties, 'latin' if there are none."""
    seen: dict[str, int] = {}
    for ch in text:
        if ord(ch) > 0x024F:
            name = next((n for n, lo, hi in SCRIPTS if lo <= ord(ch) <= hi), "other" if ch.isalpha() else "")
            if name:
                seen[name] = seen.get(name, 0) + 1
    return max(seen, key=lambda n: seen[n], default="latin")


@F.pandas_udf(T.StringType())
def _to_latin_udf(s: pd.Series) -> pd.Series:
    return s.map(to_latin, na_action="ignore")


@F.pandas_udf(T.StringType())
def _script_udf(s: pd.Series) -> pd.Series:
    return s.map(script_of, na_action="ignore")


def _fold_table() -> tuple[str, str, dict[str, str]]:
    """Letters from U+00C0 to U+024F by to_latin: those spelled by one letter and the spellings, those that are dropped at the end of the first; and those spelled by several."""
    spelled = {chr(o): to_latin(chr(o)) for o in range(0xC0, 0x250)}
    one = {a: b for a, b in spelled.items() if len(b) == 1}
    gone = "".join(a for a, b in spelled.items() if not b)
    return "".join(one) + gone, "".join(one.values()), {a: b for a, b in spelled.items() if len(b) > 1}


FOLD_FROM, FOLD_TO, FOLD_LONG = _fold_table()


def fold_latin(c: Column) -> Column:
    """to_latin inside the JVM, for text of ASCII and letters from U+00C0 to U+024F.

    Letters of several spellings are replaced only in rows that hold one of them.
    """
    long = c
    for a, b in FOLD_LONG.items():
        long = F.replace(long, F.lit(a), F.lit(b))
    long = F.when(c.rlike("[" + "".join(FOLD_LONG) + "]"), long).otherwise(c)
    return F.translate(long, FOLD_FROM, FOLD_TO)


def latin(c: Column) -> Column:
    """Plain Latin spelling of any text: rows of Latin letters stay in the JVM, the others go through Python."""
    other = c.rlike("[^\\x00-\\x7FÀ-ɏ]")
    return F.when(other, _to_latin_udf(F.when(other, c))).otherwise(fold_latin(c))


def script(c: Column) -> Column:
    """script_of for a column; rows without characters beyond U+024F stay in the JVM."""
    other = c.rlike("[^\\x00-ɏ]")
    return F.when(other, _script_udf(F.when(other, c))).otherwise(F.lit("latin"))
