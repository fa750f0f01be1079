"""Similarities of two string columns: native expressions, and Arrow functions where the engine has none."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pairs of a batch whose tables are computed together.
SIDE_BY_SIDE = 8192
#: Letters of the longer strings whose windows are compared together.
WINDOW_LETTERS = 1 << 20


def tri_equal(a: Column, b: Column) -> Column:
    """-1 if either is empty, 1 if equal, 0 if they conflict."""
    return F.when((a == "") | (b == ""), -1).when(a == b, 1).otherwise(0).cast("byte")


def jaccard(a: Column, b: Column, sep: str = " ") -> Column:
    """Jaccard similarity of the non-empty parts; null if neither has any."""
    pattern = sep.replace("|", "[|]")
    x, y = (F.filter(F.split(c, pattern), lambda t: t != "") for c in (a, b))
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union)


def levenshtein_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longest)


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def first_word_equal(a: Column, b: Column) -> Column:
    x, y = (F.element_at(F.split(c, " "), 1) for c in (a, b))
    return ((x == y) & (a != "")).cast("byte")


def numbers(c: Column) -> Column:
    return F.array_join(F.regexp_extract_all(c, F.lit(r"[0-9]+"), F.lit(0)), " ")


def subsequence_abbreviation(short: Column, long: Column) -> Column:
    """short has two letters at least, is shorter, begins alike and occurs in long letter by letter in order."""
    spot = F.aggregate(
        F.filter(F.split(short, ""), lambda ch: ch != ""),
        F.lit(0),
        lambda at, ch: F.when(at < 0, F.lit(-1)).otherwise(_next_place(ch, long, at)),
    )
    return (F.length(short) >= 2) & (F.length(short) < F.length(long)) & (F.left(short, F.lit(1)) == F.left(long, F.lit(1))) & (spot >= 0)


def _next_place(ch: Column, text: Column, after: Column) -> Column:
    """Place of ch in text beyond `after` places, -1 if there is none."""
    found = F.position(ch, text, after + 1)
    return F.when(found > 0, found).otherwise(F.lit(-1))


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table in the bits of one integer."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        match = row & where.get(ch, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """100 * 2 LCS / (|a| + |b|); two empty strings are alike."""
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of its length in the longer; windows at the ends may be shorter.

    One step moves the common subsequence by one letter at most, so after each window as
    many are passed over as cannot be better than the best so far. Whole windows come
    first: their best rules most of the short ones out.
    """
    if not a or not b:
        return 100.0 if a == b else 0.0
    best = 0.0
    for s, t in ((a, b), (b, a)) if len(a) == len(b) else ((a, b) if len(a) < len(b) else (b, a),):
        if s in t:
            return 100.0
        n = len(s)
        for at, stop in ((0, len(t) - n + 1), (1 - n, 0), (len(t) - n + 1, len(t))):
            while at < stop:
                lo, hi = max(at, 0), min(at + n, len(t))
                common, size = lcs_length(s, t[lo:hi]), n + hi - lo
                best = max(best, 2 * common / size)
                at += max(1, int((best * size - 2 * common) / (2 + best)))
    return 100.0 * best


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the common words, and these with either side's others; 0 if a side is empty."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_x or not only_y):
        return 100.0
    with_x, with_y = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    best = ratio(with_x, with_y)
    return max(best, ratio(both, with_x), ratio(both, with_y)) if both else best


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised by 0.1 for each of up to four common first letters where it is over 0.7."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    mine: list[str] = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                mine.append(ch)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [ch for ch, t in zip(b, taken) if t]
    swaps = sum(p != q for p, q in zip(mine, theirs)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """lcs_length of many pairs, side by side: a row of each pair's table is one 64-bit number.

    Pairs whose shorter string has more than 64 letters are done one by one.
    """
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    out = np.zeros(len(pairs), np.int64)
    fits = [i for i, (x, _) in enumerate(pairs) if 0 < len(x) <= 64]
    for i, (x, y) in enumerate(pairs):
        if len(x) > 64:
            out[i] = lcs_length(x, y)
    fits.sort(key=lambda i: len(pairs[i][1]))
    for at in range(0, len(fits), SIDE_BY_SIDE):
        some = np.array(fits[at : at + SIDE_BY_SIDE])
        width = max(len(pairs[i][1]) for i in some)
        s = np.array([pairs[i][0] for i in some], "U64").view(np.uint32).reshape(len(some), 64)
        t = np.array([pairs[i][1] for i in some], f"U{width}").view(np.uint32).reshape(len(some), width)
        row = np.full(len(some), ~np.uint64(0))
        for j in range(width):
            match = np.packbits(s == t[:, j : j + 1], axis=1, bitorder="little").view(np.uint64)[:, 0] & row
            row = (row + match) | (row - match)
        size = np.array([len(pairs[i][0]) for i in some], np.uint64)
        out[some] = np.bitwise_count(~row & (~np.uint64(0) >> (np.uint64(64) - size)))
    return out


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    size = np.array([len(x) + len(y) for x, y in zip(a, b)], np.float64)
    return np.where(size > 0, 200.0 * lcs_lengths(a, b) / np.maximum(size, 1), 100.0)


def token_sort_ratios(a: list[str], b: list[str]) -> np.ndarray:
    return ratios([" ".join(sorted(x.split())) for x in a], [" ".join(sorted(x.split())) for x in b])


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """token_set_ratio of many pairs: the strings that it compares are made first and compared together."""
    out, at, left, right = np.zeros(len(a)), [], [], []
    for i, (p, q) in enumerate(zip(a, b)):
        x, y = set(p.split()), set(q.split())
        if not x or not y:
            continue
        both, only_x, only_y = (" ".join(sorted(w)) for w in (x & y, x - y, y - x))
        if both and (not only_x or not only_y):
            out[i] = 100.0
            continue
        with_x, with_y = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
        for s, t in ((with_x, with_y), (both, with_x), (both, with_y)) if both else ((with_x, with_y),):
            at.append(i)
            left.append(s)
            right.append(t)
    np.maximum.at(out, np.array(at, np.int64), ratios(left, right))
    return out


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """partial_ratio of many pairs: every round takes the next window of each pair that is not through, with the same leaps.

    Pairs whose shorter string has more than 64 letters are done one by one.
    """
    out, jobs = np.zeros(len(a)), []
    for i, (x, y) in enumerate(zip(a, b)):
        s, t = (x, y) if len(x) <= len(y) else (y, x)
        if not s:
            out[i] = 0.0 if t else 100.0
        elif s in t:
            out[i] = 100.0
        elif len(s) > 64:
            out[i] = partial_ratio(x, y)
        else:
            jobs += [(i, s, t), (i, t, s)] if len(s) == len(t) else [(i, s, t)]
    jobs.sort(key=lambda job: len(job[2]))
    at = 0
    while at < len(jobs):
        # strings of about one length together, and a table of some million letters at most
        some = jobs[at : at + max(1, min(SIDE_BY_SIDE, WINDOW_LETTERS // len(jobs[min(at + SIDE_BY_SIDE, len(jobs)) - 1][2])))]
        at += len(some)
        np.maximum.at(out, np.array([i for i, _, _ in some]), 100.0 * _best_windows([s for _, s, _ in some], [t for _, _, t in some]))
    return out


def _best_windows(short: list[str], long: list[str]) -> np.ndarray:
    """For each pair the best 2 LCS / (letters of both) of short, 64 letters at most, and a window of long."""
    n, m = (np.array([len(x) for x in w], np.int64) for w in (short, long))
    width = int(m.max())
    s = np.array(short, "U64").view(np.uint32).reshape(len(short), 64)
    t = np.array(long, f"U{width}").view(np.uint32).reshape(len(long), width)
    # where[i, j]: the places of short that hold long's letter j, as bits
    where = np.stack([np.packbits(s == t[:, j : j + 1], axis=1, bitorder="little").view(np.uint64)[:, 0] for j in range(width)], axis=1).ravel()
    whole, best = ~np.uint64(0) >> (np.uint64(64) - n.astype(np.uint64)), np.zeros(len(short))
    for first, stop in ((np.zeros_like(n), m - n + 1), (1 - n, np.zeros_like(n)), (m - n + 1, m)):
        place = first.copy()
        live = np.flatnonzero(place < stop)
        while len(live):
            lo, hi = np.maximum(place[live], 0), np.minimum(place[live] + n[live], m[live])
            row, start, letters = np.full(len(live), ~np.uint64(0)), live * width + lo, hi - lo
            for j in range(int(letters.max())):
                match = np.where(j < letters, where.take(start + j, mode="clip"), np.uint64(0)) & row
                row = (row + match) | (row - match)
            common, size = np.bitwise_count(~row & whole[live]).astype(np.int64), n[live] + letters
            best[live] = np.maximum(best[live], 2 * common / size)
            place[live] += np.maximum(1, ((best[live] * size - 2 * common) / (2 + best[live])).astype(np.int64))
            live = live[place[live] < stop[live]]
    return best


def _one_by_one(scorer):
    return lambda a, b: np.array([scorer(x, y) for x, y in zip(a, b)], np.float64)


def _arrow(scorer):
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs = list(zip(a.fillna(""), b.fillna("")))
        distinct = list(dict.fromkeys(pairs))
        found = scorer([x for x, _ in distinct], [y for _, y in distinct])
        value = dict(zip(distinct, found))
        return pd.Series([value[p] for p in pairs], dtype="float64")

    return F.pandas_udf(score, T.DoubleType())


#: Scorers of two lists; null counts as empty. A batch computes equal pairs once.
SCORERS = {"ratio": ratios, "partial_ratio": partial_ratios,"token_sort_ratio": token_sort_ratios, "token_set_ratio": token_set_ratios, "jaro_winkler": _one_by_one(jaro_winkler)}


def similarity(name: str, a: Column, b: Column) -> Column:
    return _arrow(SCORERS[name])(a, b)
