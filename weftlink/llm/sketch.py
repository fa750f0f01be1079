"""Count-min sketches of 64-bit hashes, merged by key range and answered by block.

Every block of a corpus is sketched into sparse rows of counters (cell, count) for `depth`
hash functions. The counters are dealt by cell range, summed, and each block gets back, for
its own cells only, the summed counts. Neither the merged sketch nor any list of hashes is
ever in one place: what goes out is about two bytes a counter, what comes back is a
compressed count, and width and ranges grow with the counted size of the input.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as bl
from . import bytewords as bw

#: Hash functions, that is rows of the sketch.
DEPTH = 2
#: Hashes whose counters make one range, about: what a merging task holds at once.
RANGE = 1 << 18
#: Bytes of text for one hash, about: it sets the width, never a result.
HASH_BYTES = 6
_U = np.uint64
_SALTS = [_U(0x9FB21C651E98DF25), _U(0xD1B54A32D192ED03), _U(0x8CB92BA72F3D8DD7), _U(0xABC98388FB8FAC03)]

Source = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, object]]]


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return bw.mix(hashes ^ _SALTS[row]) >> _U(64 - bits)


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), codec="zstd", asbytes=True)


def _unpack(b: bytes, dtype, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(b, n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)


def _pack_sorted(a: np.ndarray) -> tuple[bytes, int]:
    """Sorted numbers as compressed differences, and the bytes of one difference."""
    gaps = np.diff(a, prepend=_U(0))
    top = int(gaps.max()) if len(gaps) else 0
    width = 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return _pack(gaps.astype(f"<u{width}")), width


class Plan:
    """Width and ranges of a sketch for about n hashes, and the largest count that is told apart."""

    def __init__(self, n: int, depth: int = DEPTH, top: int = 255):
        self.bits = min(60, max(18, math.ceil(math.log2(max(n, 1))) + 4))
        self.range_bits = min(self.bits - 2, max(3, math.ceil(math.log2(max(n / RANGE, 1)))))
        self.depth, self.top = depth, top
        self.kind = np.uint8 if top < 256 else np.uint32


def counted(blocks: bl.Blocks, source: Source, plan: Plan) -> DataFrame:
    """First pass: sketch and merge; returns the answers (block, row, rng, n, counts).

    source turns a block's rows into (hashes, item) pairs, the same whenever it is called.
    """
    depth, bits, low, top, kind = plan.depth, plan.bits, plan.bits - plan.range_bits, plan.top, plan.kind
    names = ["row", "rng", "block", "n", "width", "cells", "counts"]

    def sketch(block: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate([np.zeros(0, _U), *[h for h, _ in source(batch)]])
        rows = {k: [] for k in names}
        for row in range(depth if len(hashes) else 0):
            own, counts = np.unique(cells(hashes, row, bits), return_counts=True)
            counts = np.minimum(counts, top).astype(kind)
            rng = (own >> _U(low)).astype(np.int64)
            edges = np.flatnonzero(np.diff(rng, prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(own))):
                packed, width = _pack_sorted(own[a:b] - (_U(rng[a]) << _U(low)))
                for k, v in zip(names, (row, int(rng[a]), block, int(b - a), width, packed, _pack(counts[a:b]))):
                    rows[k].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(rows[k], pa.binary() if k in ("cells", "counts") else pa.int64()) for k in names], names=names)

    def merge(table: pa.Table) -> pa.Table:
        at = {k: table.column(k).to_pylist() for k in names}
        sizes = at["n"]
        own = np.concatenate([np.cumsum(_unpack(b, f"<u{w}", n).astype(_U)) for b, w, n in zip(at["cells"], at["width"], sizes)])
        counts = np.concatenate([_unpack(b, kind, n) for b, n in zip(at["counts"], sizes)])
        order = np.argsort(own, kind="stable")
        opens = np.flatnonzero(np.append(True, own[order][1:] != own[order][:-1]))
        total = np.minimum(np.add.reduceat(counts[order].astype(np.int64), opens), top).astype(kind)
        answer = np.empty(len(own), kind)
        answer[order] = np.repeat(total, np.diff(np.append(opens, len(own))))
        cuts = np.split(answer, np.cumsum(sizes)[:-1])
        return pa.table({
            "block": pa.array(at["block"], pa.int64()), "row": pa.array(at["row"], pa.int64()), "rng": pa.array(at["rng"], pa.int64()), "n": pa.array(sizes, pa.int64()),
            "counts": pa.array([_pack(c) for c in cuts], pa.binary()),
        })

    rows = bl.each(blocks, sketch, "row long, rng long, block long, n long, width long, cells binary, counts binary")
    return rows.groupBy("row", "rng").applyInArrow(merge, "block long, row long, rng long, n long, counts binary")


def estimated(batch: pa.RecordBatch, source: Source, plan: Plan, answers: pa.Table) -> list[tuple[np.ndarray, np.ndarray, object]]:
    """Second pass: (hashes, estimates up to the plan's top, item) of a block. No estimate is too low."""
    items = list(source(batch))
    hashes = np.concatenate([np.zeros(0, _U), *[h for h, _ in items]])
    found = np.full(len(hashes), plan.top, plan.kind)
    rows = sorted(answers.to_pylist(), key=lambda r: (r["row"], r["rng"]))
    for row in range(plan.depth if len(hashes) else 0):
        totals = np.concatenate([_unpack(r["counts"], plan.kind, r["n"]) for r in rows if r["row"] == row])
        _, back = np.unique(cells(hashes, row, plan.bits), return_inverse=True)
        found = np.minimum(found, totals[back])
    cuts = np.cumsum([len(h) for h, _ in items])[:-1]
    return [(h, e, item) for (h, item), e in zip(items, np.split(found, cuts))]
