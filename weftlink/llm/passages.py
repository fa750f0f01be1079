"""Removal of passages that an earlier document has, behind a count-min prefilter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as bl
from . import bytewords as bw
from . import sketch, storage

#: Words of a window.
WINDOW = 50
#: Windows of one bucket of the exact grouping, about, were all repeated.
GROUP = 1 << 20
#: Blocks whose windows meet in one step of it.
MEET = 1 << 16


def _windows(size: int, both: bool):
    """Source for the sketch: windows of a slice of documents, and what the second pass needs of them.

    Documents without an id have no windows: nothing is smaller than null.
    """

    def source(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, object]]:
        data, borders = bw.buffers(batch.column(1))
        ids = batch.column(0)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        for lo, hi in bw.slices(borders):
            part, own = data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo]
            starts, ends, first = bw.word_spans(part, own)
            hashes, at = bw.window_hashes(bw.span_hashes(part, starts, ends), first, size)
            doc = np.searchsorted(first, at, "right") - 1
            ok = known[lo:hi][doc]
            if not ok.all():
                hashes, at, doc = hashes[ok], at[ok], doc[ok]
            item: object = hi - lo
            if both:
                second, _ = bw.window_hashes(bw.span_hashes(part, starts, ends, 1), first, size)
                item = (hi - lo, ids[lo:hi], doc, at - first[doc], second if ok.all() else second[ok])
            yield hashes, item

    return source


def _by_block(refs: np.ndarray, at: np.ndarray) -> list[tuple[int, int, bytes, bytes]]:
    """Flagged window starts as one (block, n, documents, starts) row for each block."""
    order = np.lexsort((at, refs))
    refs, at = refs[order], at[order]
    cuts = np.flatnonzero(np.diff(refs >> bl.ROW_BITS, prepend=-1))
    low = (1 << bl.ROW_BITS) - 1
    return [
        (int(refs[a] >> bl.ROW_BITS), int(b - a), sketch._pack((refs[a:b] & low).astype("<u4")), sketch._pack(at[a:b].astype("<i4")))
        for a, b in zip(cuts, np.append(cuts[1:], len(refs)))
    ]


_FIELDS = ["bucket", "n", "one", "two", "id", "ref", "pos"]
_KINDS = ", ".join(f"{k} {'long' if k in ('bucket', 'n') else 'binary'}" for k in _FIELDS)


def _settle(one: np.ndarray, two: np.ndarray, ids: np.ndarray, refs: np.ndarray, at: np.ndarray, buckets: int) -> pa.Table:
    """Rows of windows at hand: starts that a smaller document here rules out (bucket -1 - block), and of each window the first for its bucket."""
    order = np.lexsort((refs, ids, two, one))
    fresh = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]))[: len(one)]
    lowest = ids[order][fresh][np.cumsum(fresh) - 1]
    later = np.empty(len(one), bool)
    later[order] = ids[order] > lowest
    rows = {k: [] for k in _FIELDS}
    for block, n, docs, starts in _by_block(refs[later], at[later]):
        for k, v in zip(_FIELDS, (-1 - block, n, b"", b"", b"", docs, starts)):
            rows[k].append(v)
    left = np.flatnonzero(~later)
    bucket = (one[left] % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by], prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(by))):
        pick = left[by[a:b]]
        packed = [sketch._pack(x[pick]) for x in (one, two, ids, refs, at.astype(np.int32))]
        for k, v in zip(_FIELDS, (int(bucket[by[a]]), len(pick), *packed)):
            rows[k].append(v)
    return pa.table({k: pa.array(rows[k], pa.int64() if k in ("bucket", "n") else pa.binary()) for k in _FIELDS})


def _unpacked(table: pa.Table) -> list[np.ndarray]:
    at = {k: table.column(k).to_pylist() for k in _FIELDS}
    kinds = (("one", np.uint64), ("two", np.uint64), ("id", np.int64), ("ref", np.int64), ("pos", np.int32))
    return [np.concatenate([sketch._unpack(b, kind, n) for b, n in zip(at[k], at["n"])]) for k, kind in kinds]


def repeated_windows(blocks: bl.Blocks, size: int = WINDOW) -> DataFrame:
    """(block, n, docs, starts): the window starts whose words also start in a document with a smaller id.

    Pass 1 sketches all windows; pass 2 keeps those whose estimate is two or more, none of
    the repeated ones being lost. Windows are grouped exactly, by a 128-bit hash, in steps,
    each of which decides what has a smaller document at hand and sends on one document for
    each window: inside a block, among at most MEET blocks, and, where there are more, among
    all. A passage that a third of all documents hold thus arrives nowhere more often than
    MEET times or once for every MEET blocks.
    """
    plan = sketch.Plan(blocks.bytes // sketch.HASH_BYTES)
    answers = sketch.counted(blocks, _windows(size, False), plan)
    buckets = max(8, blocks.bytes // sketch.HASH_BYTES // GROUP)
    salts = -(-max(blocks.count, 1) // MEET)

    def survivors(block: int, batch: pa.RecordBatch, found: pa.Table) -> pa.Table:
        held, before = [], block << bl.ROW_BITS
        for hashes, estimate, (n_docs, ids, doc, at, second) in sketch.estimated(batch, _windows(size, True), plan, found):
            keep = estimate >= 2
            held.append((hashes[keep], second[keep], ids[doc[keep]], before + doc[keep], at[keep]))
            before += n_docs
        out = _settle(*(np.concatenate(x) for x in zip(*held)), buckets)
        return out.append_column("salt", pa.array(np.full(out.num_rows, block % salts), pa.int64()))

    def again(table: pa.Table) -> pa.Table:
        return _settle(*_unpacked(table), buckets)

    rows = storage.cut(bl.together(blocks, answers, survivors, f"{_KINDS}, salt long"), "windows")
    remote = rows.where("bucket >= 0").groupBy("bucket", "salt").applyInArrow(again, _KINDS)
    if salts > 1:
        some = storage.cut(remote, "windows")
        remote = some.where("bucket < 0").unionByName(some.where("bucket >= 0").groupBy("bucket").applyInArrow(again, _KINDS))
    found = rows.drop("salt").unionByName(remote).where("bucket < 0")
    out = storage.cut(found.select((-1 - F.col("bucket")).alias("block"), "n", F.col("ref").alias("docs"), F.col("pos").alias("starts")), "spans")
    storage.drop_cut(rows)
    if salts > 1:
        storage.drop_cut(some)
    return out


def drop_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Every document without the words of passages that a document with a smaller id has.

    Returns doc_id, n_words, n_removed and text (the kept words, joined by one space). A
    word goes if it lies in a window of `size` words that also starts in a document with a
    smaller id; windows are judged on the input. docs is read once, into blocks; all passes
    work on these, so any DataFrame will do and its partitions may change meanwhile.

    Defined cases: null text has no words and gives an empty text; a document without an
    id neither loses words nor takes any from others; rows with the same id do not take
    words from each other; shorter texts than a window keep all; a very long text is a
    block of its own and is held whole by one task at a time; an empty table gives an
    empty result; other columns of docs are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = bl.write(own)
    spans = repeated_windows(blocks, size)

    def clean(block: int, batch: pa.RecordBatch, found: pa.Table) -> pa.Table:
        n, docs_, starts_ = (found.column(c).to_pylist() for c in ("n", "docs", "starts"))
        refs = np.concatenate([np.zeros(0, np.uint32), *[sketch._unpack(b, "<u4", k) for b, k in zip(docs_, n)]])
        at = np.concatenate([np.zeros(0, np.int32), *[sketch._unpack(b, "<i4", k) for b, k in zip(starts_, n)]])
        order = np.argsort(refs, kind="stable")
        refs, at = refs[order].astype(np.int64), at[order].astype(np.int64)
        data, borders = bw.buffers(batch.column(1))
        out = []
        for lo, hi in bw.slices(borders):
            words = bw.word_spans(data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo])
            a, b = np.searchsorted(refs, (lo, hi))
            out.append(_without(data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo], words, refs[a:b] - lo, at[a:b], size))
        total, left, text = (np.concatenate([x[i] for x in out]) if i < 2 else pa.concat_arrays([x[2] for x in out]) for i in range(3))
        return pa.table({"doc_id": batch.column(0), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(total - left, pa.int64()), "text": text})

    return bl.together(blocks, spans, clean, "doc_id long, n_words long, n_removed long, text string")


def _without(text: np.ndarray, own: np.ndarray, words: tuple[np.ndarray, np.ndarray, np.ndarray], refs: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text, words left, and what is left joined by spaces, when the windows that start at word `at` of text refs go."""
    starts, ends, first = words
    edge = np.zeros(len(starts) + 1, np.int64)
    begin = first[refs] + at
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + size, -1)
    kept = np.cumsum(edge[:-1]) == 0
    doc = np.searchsorted(first, np.arange(len(starts)), "right") - 1
    s, e, d = starts[kept], ends[kept], doc[kept]
    out = np.append(text, np.uint8(32))
    take = np.zeros(len(out) + 1, np.int8)
    np.add.at(take, s, 1)
    np.add.at(take, e, -1)
    take = np.cumsum(take[:-1], dtype=np.int8) > 0
    more = e[:-1][d[1:] == d[:-1]]  # a word that another one of its document follows
    take[more] = True
    out[more] = 32
    length = np.zeros(len(out) + 1, np.int64)
    np.cumsum(take, out=length[1:])
    n = len(own) - 1
    kept_text = pa.LargeStringArray.from_buffers(n, pa.py_buffer(length[own].astype(np.int64).tobytes()), pa.py_buffer(out[take].tobytes()))
    return np.diff(first), np.bincount(d, minlength=n), kept_text.cast(pa.string())
