"""Token ids of whole texts, with a cache of encoded words.

A byte-level BPE splits a text into pieces before it merges, and no piece reaches over the
start of a white space run. So a text's ids are those of its parts (a white space run and
the word after it), one after another. Parts are found and hashed by numpy; each distinct
part is encoded once by the tokenizer and kept in the worker's cache with its bytes, which
are compared on every hit.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import bytewords as bw

#: Distinct parts that a worker keeps before it begins again.
CACHE_PARTS = 1_000_000
#: Bytes of text that are encoded at a time.
SLICE_BYTES = 1 << 20
#: How byte-level BPE vocabularies of this family split a text (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space beyond ASCII, and separators that some engines take for it: a text with any is encoded whole.
_RARE_SPACE = "[\x1c-\x1f\x85\xa0  -     　]"


def byte_table() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        table = byte_table()
        vocab = self.tokenizer.get_vocab()
        self.widths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.widths[i] = sum(1 if c in table else len(c.encode()) for c in token)
        self.ranked = self._ranked()
        self._clear()

    def _clear(self) -> None:
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin, self.flat, self.n = np.zeros(1, np.int64), np.zeros(0, np.int32), 0
        self.bytes, self.bytes_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def _ranked(self):
        """The same vocabulary behind tiktoken's faster merger, where that is the same function; else None.

        It is when every merge makes the token that comes next by number after the 256
        bytes, the text is split by the usual byte-level pattern and nothing is normalized.
        """
        import json

        import tiktoken

        said = json.loads(self.tokenizer.to_str())
        model, split = said["model"], said.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or said.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            return None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        table = byte_table()
        ranks = {bytes(table[c] for c in token): i for token, i in model["vocab"].items() if i < 256 + len(merges)}
        return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.ranked.encode_ordinary(text), np.int32) if self.ranked else self.whole(text)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode new parts, many in one text; tokens are dealt back to parts by their bytes.

        Only parts that begin with white space and end without may stand side by side.
        """
        joins = bw._SPACE[data[starts]] & ~bw._SPACE[data[ends - 1]]
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        hashes, starts, ends = hashes[order], starts[order], ends[order]
        lengths = ends - starts
        n_joined = int(joins.sum())
        counts, flat = [], []
        for g in np.array_split(np.arange(n_joined), int(lengths[:n_joined].sum()) // 50_000 + 1):
            borders = np.cumsum(lengths[g])
            size = int(borders[-1]) if len(g) else 0
            text = data[np.repeat(starts[g] - np.append(0, borders[:-1])[: len(g)], lengths[g]) + np.arange(size)].tobytes()
            ids = self._ids(text.decode("utf-8", "replace"))
            at = np.cumsum(self.widths[ids])
            cut = np.searchsorted(at, borders)
            if len(g) and (len(at) == 0 or not np.array_equal(at[np.minimum(cut, len(at) - 1)], borders)):
                # a token reaches over a border of parts: encode these alone
                alone = [self._ids(data[a:b].tobytes().decode("utf-8", "replace")) for a, b in zip(starts[g], ends[g])]
                counts.append(np.array([len(x) for x in alone], np.int64))
                flat += alone
            else:
                counts.append(np.diff(np.append(-1, cut)))
                flat.append(ids)
        alone = [self._ids(data[a:b].tobytes().decode("utf-8", "replace")) for a, b in zip(starts[n_joined:], ends[n_joined:])]
        n = np.concatenate([*counts, np.array([len(x) for x in alone], np.int64)])
        slots = np.arange(self.n, self.n + len(n))
        begin = np.cumsum(lengths) - lengths
        self.bytes = np.append(self.bytes, data[np.repeat(starts - begin, lengths) + np.arange(lengths.sum())])
        self.bytes_at = np.append(self.bytes_at, self.bytes_at[-1] + np.cumsum(lengths))
        self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(n))
        self.flat = np.concatenate([self.flat, *flat, *alone])
        self.n += len(n)
        order = np.argsort(hashes)
        place = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, place, hashes[order])
        self.slot = np.insert(self.slot, place, slots[order])

    def _is_known(self, slots: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """True where the part in the cache has the bytes of the one at hand, not its hash alone."""
        same = self.bytes_at[slots + 1] - self.bytes_at[slots] == sizes
        return same & bw.spans_equal(self.bytes, self.bytes_at[slots], data, starts, np.where(same, sizes, 0))

    def encode(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, the borders of each text's ids, and the texts to encode whole, one of whose parts shares its hash with another."""
        n, n_docs = len(data), len(borders) - 1
        if not n:
            return np.zeros(0, np.int32), np.zeros(n_docs + 1, np.int64), np.zeros(0, np.int64)
        space = bw._SPACE[data]
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[borders[:-1][borders[:-1] < n]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], n)
        sizes = ends - starts
        hashes = bw.span_hashes(data, starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if self.n > CACHE_PARTS:
            self._clear()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            self._learn(distinct[new], data, starts[first[new]], ends[first[new]])
            at = np.searchsorted(self.known, distinct)
        slots = self.slot[at]
        like = first[back]
        same = self._is_known(slots, data, starts[first], sizes[first])[back] & (sizes == sizes[like])
        same &= bw.spans_equal(data, starts, data, starts[like], np.where(same, sizes, 0))
        slot = slots[back]
        count = self.begin[slot + 1] - self.begin[slot]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.repeat(self.begin[slot] - total[:-1], count) + np.arange(total[-1])]
        odd = np.unique(np.searchsorted(borders, starts[~same], "right") - 1)
        return ids, total[np.searchsorted(starts, borders)], odd


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary file and worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(column: pa.Array, path: str, end_id: int | None = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past last row, ids, borders) of slices of a string column; every text's ids end with end_id."""
    own = encoder(path)
    data, borders = bw.buffers(column)
    rare = pc.fill_null(pc.match_substring_regex(column, _RARE_SPACE), False).to_numpy(zero_copy_only=False)
    for lo, hi in bw.slices(borders, SLICE_BYTES):
        part, cuts = data[borders[lo] : borders[hi]], borders[lo : hi + 1] - borders[lo]
        ids, at, twins = own.encode(part, cuts)
        odd = np.union1d(np.flatnonzero(rare[lo:hi]), twins)
        if len(odd) or end_id is not None:
            tail = np.array([] if end_id is None else [end_id], np.int32)
            if len(odd):
                texts = [ids[a:b] for a, b in zip(at[:-1], at[1:])]
                for i in odd:
                    texts[i] = own.whole(part[cuts[i] : cuts[i + 1]].tobytes().decode("utf-8", "replace"))
                lengths = np.array([len(x) for x in texts], np.int64)
                ids, at = np.concatenate([*texts, np.zeros(0, np.int32)]).astype(np.int32), np.concatenate([[0], np.cumsum(lengths)])
            if len(tail):
                ids = np.insert(ids, at[1:], end_id)
                at = at + np.arange(len(at))
        yield lo, hi, ids, at


def crc(ids: np.ndarray) -> int:
    """CRC-32 of ids as unsigned little-endian 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
