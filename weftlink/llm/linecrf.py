"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from . import storage

#: Documents whose lines fit the model: so many labelled ones, those with the smallest hashes of their ids.
TRAIN_DOCS = 3000
#: Documents of more lines are not among them, so that what the driver gathers is bounded; all are scored.
TRAIN_LINES = 2000
#: Steps of gradient ascent and strength of the quadratic penalty.
STEPS = 150
PENALTY = 1e-3
#: Features of one line; a line's input holds its own, its two neighbours' and a constant.
FEATURES = 14


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _LOWER = _mask(bytes(range(65, 91))), _mask(bytes(range(97, 123)))
_DIGIT, _MARK, _BANG, _PIPE = _mask(b"0123456789"), _mask(b"#*$%&<>"), _mask(b"!"), _mask(b"|")
_STOP = _mask(b".?;:")


def line_features(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""Features of all \n-split lines, their weights (bytes in words) and each document's first line.

    Every document has a line at least. Features are ratios in [0, 1] or slow logarithms,
    so that neither length nor language dominates.
    """
    n_docs, n = len(borders) - 1, len(data)
    newline = np.flatnonzero(data == 10)
    doc_of_newline = np.searchsorted(borders, newline, "right") - 1
    starts = np.concatenate([borders[:-1], newline + 1])
    doc = np.concatenate([np.arange(n_docs), doc_of_newline])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = np.where(doc[1:] == doc[:-1], starts[1:] - 1, borders[doc[:-1] + 1])
    ends[-1:] = n
    first = np.searchsorted(doc, np.arange(n_docs + 1))

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(n + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return (total[ends] - total[starts]).astype(float)

    ws, we, _ = bw.word_spans(data, borders)
    hashes = bw.span_hashes(data, ws, we)
    lo, hi = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    words = (hi - lo).astype(float)
    line_of = np.searchsorted(starts, ws, "right") - 1
    again = np.zeros(len(ws), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    by = np.lexsort((hashes, line_of))
    twin = np.zeros(len(ws), bool)
    twin[by[1:]] = (hashes[by][1:] == hashes[by][:-1]) & (line_of[by][1:] == line_of[by][:-1])

    def over_words(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(ws) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[hi] - total[lo]).astype(float)

    text_hash = bw.span_hashes(data, starts, ends)
    by = np.lexsort((starts, text_hash, doc))
    earlier = np.zeros(len(starts), bool)
    earlier[by[1:]] = (text_hash[by][1:] == text_hash[by][:-1]) & (doc[by][1:] == doc[by][:-1])
    size = np.maximum(ends - starts, 1).astype(float)
    some = np.maximum(words, 1.0)
    upper, lower = count(_UPPER[data]), count(_LOWER[data])
    clipped = over_words(np.minimum(we - ws, 255))
    return (
        np.column_stack([
            upper / np.maximum(upper + lower, 1), np.minimum(count(_MARK[data]) / some, 3) / 3, np.minimum(count(_BANG[data]) / some, 2) / 2,
            np.minimum(count(_PIPE[data]) / some, 1), count(_DIGIT[data]) / size, over_words(again) / some, over_words(twin) / some,
            earlier & (words > 0), np.log1p(words) / 8, np.minimum(clipped / some, 20) / 20, np.minimum(count(_STOP[data]) / some, 1),
            count(data >= 128) / size, words == 0, words < 4,
        ]).astype(np.float32),
        over_words(we - ws),
        first,
    )


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after in its document (0 at the ends), and 1."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.hstack([x, before, after, np.ones((len(x), 1), x.dtype)])


@dataclass
class Chain:
    """Weights of a line for 'good', and of the moves between bad (0) and good (1)."""

    weights: np.ndarray
    moves: np.ndarray

    def _step(self, m: np.ndarray, back: bool) -> np.ndarray:
        a = self.moves if not back else self.moves.T
        return np.logaddexp(a[1, 1] + m, a[0, 1]) - np.logaddexp(a[1, 0] + m, a[0, 0])

    def messages(self, emit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward log odds (with the line's own) and backward log odds of every line.

        Documents run side by side, line by line: step t handles line t of all documents
        that have one.
        """
        n_lines = np.diff(first)
        by = np.argsort(-n_lines, kind="stable")
        live = np.searchsorted(-n_lines[by], -np.arange(1, (n_lines.max() if len(n_lines) else 0) + 1), "right")
        ahead, back = emit.copy(), np.zeros_like(emit)
        for t in range(1, len(live)):
            at = first[by[: live[t]]] + t
            ahead[at] += self._step(ahead[at - 1], False)
        last = first[1:] - 1
        for t in range(1, len(live)):
            at = last[by[: live[t]]] - t
            back[at] = self._step(emit[at + 1] + back[at + 1], True)
        return ahead, back

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of 'good' for every line, from forward and backward messages."""
        ahead, back = self.messages(x @ self.weights, first)
        return 1 / (1 + np.exp(-np.clip(ahead + back, -500, 500)))


def fit_chain(x: np.ndarray, first: np.ndarray, good: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> Chain:
    """Maximum likelihood of line labels (each line has its document's) by Adam; the same data give the same model."""
    k = x.shape[1]
    theta, m, v = np.zeros(k + 4), np.zeros(k + 4), np.zeros(k + 4)
    n_lines = np.diff(first)
    y = np.repeat(good.astype(float), n_lines)
    # every document counts alike, however many lines it has
    share = np.repeat(1 / np.maximum(n_lines, 1), n_lines) / max(len(good), 1)
    inner = np.ones(len(x), bool)
    inner[first[1:] - 1] = False
    left = np.flatnonzero(inner)
    for i in range(1, steps + 1 if len(good) else 1):
        chain = Chain(theta[:k], theta[k:].reshape(2, 2))
        emit = x @ chain.weights
        ahead, back = chain.messages(emit, first)
        p = 1 / (1 + np.exp(-np.clip(ahead + back, -500, 500)))
        grad = np.empty(k + 4)
        grad[:k] = x.T @ ((y - p) * share)
        right = emit[left + 1] + back[left + 1]
        table = np.stack([np.stack([chain.moves[a, b] + a * ahead[left] + b * right for b in (0, 1)]) for a in (0, 1)])
        table = np.exp(table - table.max((0, 1)))
        table /= table.sum((0, 1))
        for a in (0, 1):
            for b in (0, 1):
                seen = (y[left] == a) & (y[left + 1] == b)
                grad[k + 2 * a + b] = ((seen - table[a, b]) * share[left]).sum()
        grad -= penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return Chain(theta[:k], theta[k:].reshape(2, 2))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """At most `most` labelled documents outside the held-out third, chosen by a hash of their ids, ties by id; without those of over TRAIN_LINES lines."""
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id").limit(most)
    )
    # at most `most` ids and labels: bounded by the parameter
    return docs.join(F.broadcast(picked), "doc_id").where(F.coalesce(F.regexp_count("text", F.lit("\n")), F.lit(0)) < TRAIN_LINES)


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Chain:
    """Fit the chain on the line features of the training rows; the driver holds these features only.

    Defined cases: labels without an id or a quality do not count; of several labels of one
    id the largest does; a null text is one blank line; rows that share an id are all
    learned from; without a training row all weights are 0 and every score is 0.5; other
    columns are not read.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = bw.buffers(batch.column(1))
            packed = []
            for lo, hi in bw.slices(borders):
                x, _, first = line_features(data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo])
                for a, b in zip(first[:-1], first[1:]):
                    out = io.BytesIO()
                    np.save(out, x[a:b].astype(np.float16))
                    packed.append(out.getvalue())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], names=["doc_id", "quality", "x"])

    rows = training_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")), most)
    found = rows.select("doc_id", "text", "quality").mapInArrow(bw.tidied(lines), "doc_id long, quality int, x binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["x"]))
    xs = [np.load(io.BytesIO(r["x"])).astype(np.float64) for r in found]
    first = np.concatenate([[0], np.cumsum([len(x) for x in xs])]).astype(np.int64)
    if not xs:
        return Chain(np.zeros(3 * FEATURES + 1), np.zeros((2, 2)))
    x = with_neighbours(np.vstack(xs), first)
    return fit_chain(x, first, np.array([r["quality"] == 1 for r in found]))


def score_documents(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score: the mean of its lines' probabilities of 'good', weighted by their bytes in words.

    One scan with an Arrow map. Null and empty texts are one blank line and get that
    line's probability; a text without words weighs its lines alike; a very long text is
    scored whole, in a batch of its own; repeated rows and null ids are scored each for
    itself, equal texts alike; an empty table gives an empty result.
    """
    weights, moves = chain.weights, chain.moves

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Chain(weights, moves)
        for batch in batches:
            data, borders = bw.buffers(batch.column(1))
            for lo, hi in bw.slices(borders):
                x, weight, first = line_features(data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo])
                p = model.marginals(with_neighbours(x.astype(np.float16).astype(np.float64), first), first)
                w = weight + 1e-6
                total = np.add.reduceat(p * w, first[:-1]) / np.add.reduceat(w, first[:-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.clip(total, 0, 1))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(bw.tidied(judge), "doc_id long, score double")


def keep_good(docs: DataFrame, chain: Chain, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that score_documents gives `least` or more, with all their columns, in one scan.

    A score equal to `least` is kept; other cases as in score_documents. Columns are found
    by place, so their names do not matter.
    """
    weights, moves = chain.weights, chain.moves
    at = docs.columns.index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Chain(weights, moves)
        for batch in batches:
            data, borders = bw.buffers(batch.column(at))
            for lo, hi in bw.slices(borders):
                x, weight, first = line_features(data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo])
                p = model.marginals(with_neighbours(x.astype(np.float16).astype(np.float64), first), first)
                w = weight + 1e-6
                total = np.add.reduceat(p * w, first[:-1]) / np.add.reduceat(w, first[:-1])
                yield batch.slice(lo, hi - lo).filter(pa.array(total >= least))

    return docs.mapInArrow(bw.tidied(judge), docs.schema)
