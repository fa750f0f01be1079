"""Quality rules on words, and repeated passages from a suffix array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytewords as bw

#: Rules: fewer words, or a larger share of words in repeated windows, fail a document.
MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
#: Suffix-array rule: repeats of at least so many words count; a document is kept while they cover at
#: most this percentage of its words and the longest has at most so many words.
MIN_PASSAGE = 16
MAX_COVERED_PERCENT = 10
MAX_PASSAGE = 60
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, covered_words long, longest_repeat long, n_repeat_spans long, kept boolean"
)


def suffix_repeats(words: np.ndarray, doc_of: np.ndarray) -> np.ndarray:
    """For each word of many documents, the longest repeat that starts there, within its document.

    Prefix doubling sorts all suffixes at once: after round k equal ranks mean equal runs of
    2**k words that end inside the same document (past its end a suffix has rank 0, and
    documents never share a rank). The ranks of all rounds are kept, and the longest common
    prefix of two neighbours in the suffix array is read off them from the highest power
    down. A suffix's longest repeat is the larger of its two neighbours' common prefixes,
    that is the depth of the innermost longest-common-prefix interval that holds it.
    Time is O(n log n log L) for a longest repeat of L words; memory O(n log L).
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    _, word = np.unique(words, return_inverse=True)
    key = doc_of.astype(np.int64) * (int(word.max()) + 1) + word
    end = np.searchsorted(doc_of, doc_of, "right")  # where the document of each word ends
    rank, tied = np.zeros(n, np.int64), np.arange(n)
    levels, step = [], 1
    while True:
        # among equals only: their ranks start at that of their group
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        old = rank[tied]
        place = np.arange(len(tied))
        opens = np.append(True, key[1:] != key[:-1])
        group = np.maximum.accumulate(np.where(opens, place, 0))
        if levels:
            outer = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), place, 0))
            new = old + group - outer
        else:
            new = group + 1
        rank = rank.copy()
        rank[tied] = new
        levels.append(rank)
        alone = opens & np.append(opens[1:], True)
        tied = tied[~alone]
        if not len(tied) or step > n:
            break
        ahead = tied + step
        inside = ahead < end[tied]
        second = np.zeros(len(tied), np.int64)
        second[inside] = rank[ahead[inside]]
        key = rank[tied] * (n + 2) + second
        step *= 2
    order = np.argsort(levels[-1], kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, size = levels[k], 1 << k
        ok = (a + size <= end[order[:-1]]) & (b + size <= end[order[1:]])
        ok[ok] = level[a[ok]] == level[b[ok]]
        common[ok] += size
        a[ok] += size
        b[ok] += size
    common[doc_of[order[:-1]] != doc_of[order[1:]]] = 0
    out = np.zeros(n, np.int64)
    out[order[:-1]] = common
    out[order[1:]] = np.maximum(out[order[1:]], common)
    return out


def _covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of n words the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def _sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of flags over each document's range."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _dup_lines(data: np.ndarray, borders: np.ndarray, word_first: np.ndarray, doc_n: int) -> np.ndarray:
    """Per document: lines that hold a word and equal an earlier line."""
    n = len(data)
    newline = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([borders[:-1], newline + 1]))
    starts = starts[starts < n]
    doc = np.searchsorted(borders, starts, "right") - 1
    starts_all = np.append(starts, n)
    ends = np.minimum(starts_all[1:], borders[doc + 1])
    ends = ends - ((ends > starts) & (ends < n + 1) & (data[np.maximum(ends - 1, 0)] == 10))
    has_word = np.searchsorted(word_first, ends) > np.searchsorted(word_first, starts)
    starts, ends, doc = starts[has_word], ends[has_word], doc[has_word]
    h = bw.span_hashes(data, starts, ends)
    order = np.lexsort((starts, h, doc))
    same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.bincount(doc[order][1:][same], minlength=doc_n)


def _rules(data: np.ndarray, borders: np.ndarray, limits: dict) -> dict[str, np.ndarray]:
    n_docs = len(borders) - 1
    starts, ends, first = bw.word_spans(data, borders)
    n_words = np.diff(first)
    # code points of words: bytes that do not continue one
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    chars = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lead[ends] - lead[starts], out=chars[1:])
    words = bw.span_hashes(data, starts, ends)
    doc_of = np.repeat(np.arange(n_docs), n_words)
    runs, at = bw.window_hashes(words, first, REPEAT_WINDOW)
    order = np.lexsort((runs, doc_of[at]))
    r, d = runs[order], doc_of[at][order]
    twin = np.zeros(len(order), bool)
    if len(order) > 1:
        same = (r[1:] == r[:-1]) & (d[1:] == d[:-1])
        twin[1:] |= same
        twin[:-1] |= same
    repeated = at[order[twin]]
    in_window = _covered(len(words), repeated, np.full(len(repeated), REPEAT_WINDOW))
    longest = suffix_repeats(words, doc_of)
    passage = np.flatnonzero(longest >= limits["min_passage"])
    covered = _covered(len(words), passage, longest[passage])
    opens = covered.copy()
    opens[1:] &= ~(covered[:-1] & (doc_of[1:] == doc_of[:-1]))
    top = np.zeros(n_docs, np.int64)
    np.maximum.at(top, doc_of, longest)
    n_repeat, n_covered = _sums(in_window, first), _sums(covered, first)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    kept = ~failed & (100 * n_covered <= limits["max_covered_percent"] * n_words) & (top <= limits["max_passage"])
    return {
        "n_words": n_words, "word_chars": chars[first[1:]] - chars[first[:-1]], "n_symbols": _sums(_SYMBOL[data], borders),
        "n_dup_lines": _dup_lines(data, borders, starts, n_docs), "n_repeat_words": n_repeat, "base_failed": failed,
        "covered_words": n_covered, "longest_repeat": top, "n_repeat_spans": _sums(opens, first), "kept": kept,
    }


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_passage: int = MIN_PASSAGE,
    max_covered_percent: int = MAX_COVERED_PERCENT,
    max_passage: int = MAX_PASSAGE,
) -> DataFrame:
    """Word and line statistics of each document and whether it is kept.

    A scan with one Arrow map: no shuffle, memory of a few slices of text per task.
    Repeated passages are the maximal repeats of the document's word sequence of at least
    min_passage words (longest-common-prefix intervals of its suffix array); the union of
    their spans may cover max_covered_percent of the words, and none may be longer than
    max_passage words.

    Defined cases: null and empty texts have no words, all counts 0, base_failed true and
    kept false; repeated rows are judged alike, each for itself; a null id stays null; an
    empty table gives an empty result; other columns of docs are not read.
    """
    limits = {"min_passage": min_passage, "max_covered_percent": max_covered_percent, "max_passage": max_passage}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = bw.buffers(batch.column(1))
            for lo, hi in bw.slices(borders, 1 << 19):
                part = data[borders[lo] : borders[hi]]
                found = _rules(part, borders[lo : hi + 1] - borders[lo], limits)
                columns = [batch.column(0).slice(lo, hi - lo)]
                for field in SCHEMA.split(", ")[1:]:
                    name, kind = field.split()
                    columns.append(pa.array(found[name], pa.int64() if kind == "long" else pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

    from pyspark.sql import functions as F

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(bw.tidied(judge), SCHEMA)
