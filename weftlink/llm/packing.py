"""Packing of token sequences: bulk-synchronous best fit, and best-fit-decreasing shards on disk."""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs as pfs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytewords as bw
from . import storage, tokens

#: Tokens of a sequence.
SEQ_LEN = 2048
#: Tokens that a shard of the binary output holds, about; a task holds one shard at a time.
SHARD_TOKENS = 4 << 20
#: Tokens of a unit of short pieces at first; rows of a task in a round, about.
BUNDLE, ROUND_ROWS = 64, 200_000
#: A round that places less than one unit in so many is the last before units are halved.
FEW = 50


def cut_lengths(total: np.ndarray, seq_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of documents of `total` ids: full pieces, the rest in the first one."""
    n = np.maximum(-(-total // seq_len), 1)
    doc = np.repeat(np.arange(len(total)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = (total - (n - 1) * seq_len)[doc]
    length = np.where(piece == 0, first, seq_len)
    start = np.where(piece == 0, 0, first + (piece - 1) * seq_len)
    return doc, piece, start, length


def pieces(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = 0) -> DataFrame:
    """(node, doc_id, piece, start, length, ids_crc32) of every document; node is the input row, whatever its id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, hi, ids, at in tokens.encoded(batch.column(1), tokenizer_path, end_id):
                doc, piece, start, length = cut_lengths(np.diff(at), seq_len)
                begin = at[doc] + start
                crcs = [tokens.crc(ids[a : a + n]) for a, n in zip(begin, length)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node + doc), batch.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())],
                    names=["node", "doc_id", "piece", "start", "length", "ids_crc32"],
                )
                node += hi - lo

    return docs.mapInArrow(bw.tidied(cut), "node long, doc_id long, piece int, start long, length long, ids_crc32 long")


def _running(rows: DataFrame, order: list, value: Column, name: str, tasks: int) -> DataFrame:
    """rows, range-sorted by order, with the running total of value (own row included); no task has more than a range.

    Every range sums its own rows; what came before a range is the sum of one row for each
    range before it. A single range is one task's window, without a scan for borders or sums to collect.
    """
    if tasks == 1:
        return rows.withColumn(name, F.sum(value).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    dealt = storage.cut(rows.repartitionByRange(tasks, *order).withColumn("__p", F.spark_partition_id()).withColumn("__v", value), "ranges")
    sums = {r["__p"]: r["n"] for r in dealt.groupBy("__p").agg(F.sum("__v").alias("n")).collect()}  # a row for each range
    before, total = [], 0
    for p in sorted(sums):
        before.append((p, total))
        total += sums[p]
    starts = F.broadcast(rows.sparkSession.createDataFrame(before, "__p int, __before long"))
    own = Window.partitionBy("__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = dealt.join(starts, "__p").withColumn(name, F.col("__before") + F.sum("__v").over(own))
    out = out.drop("__p", "__v", "__before")
    out._weftlink_path = dealt._weftlink_path
    return out


#: The state of a packing: gaps (a: sequence, b: 0, m: 0) and units (m pieces of length a, of ranks b and on), by size.
_STATE = "size long, unit boolean, a long, b long, m long"


def sweep(state: DataFrame, tasks: int) -> DataFrame:
    """One round: state with `by` and `by_size`, the unit that each gap takes, or the gap that each unit goes to; null where there is none.

    Gaps and units are range-sorted by size from the largest down, gaps first among equals.
    A unit's successor is the least gap that holds it and that no unit before it has taken,
    that is the nearest gap before it that is still open. Gaps opened less units met is the
    depth of a row; a unit goes to the gap before it at its own depth, so all units find
    theirs at once. Where units of one size want the same gap, the lowest ranks have the
    nearest ones and the others go on to larger gaps. A depth has at most two rows for each
    distinct size, however many rows there are.
    """
    order = [F.desc("size"), "unit", "a", "b"]
    deep = _running(state, order, F.when(F.col("unit"), -1).otherwise(1).cast("long"), "depth", tasks)
    level = Window.partitionBy("level").orderBy(*order)
    deep = deep.withColumn("level", F.when(F.col("unit"), F.col("depth") + 1).otherwise(F.col("depth")))
    near = lambda c: F.when(F.col("unit"), F.when(~F.lag("unit").over(level), F.lag(c).over(level))).otherwise(F.when(F.lead("unit").over(level), F.lead(c).over(level)))
    out = storage.cut(deep.select("size", "unit", "a", "b", "m", near("a").alias("by"), near("size").alias("by_size")), "round")
    storage.drop_cut(deep)
    return out


def _units(spark: SparkSession, totals: dict[int, int], bundle: int) -> DataFrame:
    """The pieces of each length as units of up to `bundle` tokens: rows of _STATE, made in tasks from the counts of each length."""
    lengths = np.array(sorted(totals, reverse=True), np.int64)
    each = np.maximum(1, bundle // lengths)
    counts = np.array([totals[int(n)] for n in lengths], np.int64)
    ends = np.cumsum(-(-counts // each))
    n = int(ends[-1]) if len(ends) else 0

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy()
            k = np.searchsorted(ends, at, "right")
            rank = (at - (ends[k] - -(-counts[k] // each[k]))) * each[k]
            m = np.minimum(each[k], counts[k] - rank)
            yield pa.RecordBatch.from_arrays([pa.array(lengths[k] * m), pa.array(np.ones(len(at), bool)), pa.array(lengths[k]), pa.array(rank), pa.array(m)], names=["size", "unit", "a", "b", "m"])

    return spark.range(n).mapInArrow(make, _STATE)


def best_fit_places(spark: SparkSession, totals: dict[int, int], seq_len: int, bundle: int = BUNDLE) -> DataFrame:
    """(length, rank, m, sequence_id, offset): where the pieces of ranks rank .. rank + m - 1 of a length go, one after another.

    totals has the number of pieces of each length, seq_len entries at most. Lengths over
    half a sequence never share one: each such piece opens a sequence, and if the tokens
    need more, these are opened too. Then rounds of sweep() follow: every gap takes one
    unit at most, gaps are updated, and the next round has what is left. Short pieces of one
    length go in units of `bundle` tokens first, so that rounds are about seq_len / bundle at
    most; a round that places nothing has the units halved, and, where they are single
    pieces, opens sequences for what is left, by rank. State and places are tables
    throughout; the driver sees counts.
    """
    width = "length long, rank long, m long, sequence_id long, offset long"
    alone = {n: c for n, c in totals.items() if 2 * n > seq_len}
    n_alone, total = sum(alone.values()), sum(n * c for n, c in totals.items())
    opened = max(n_alone, -(-total // seq_len))
    base, at = {}, 0
    for n in sorted(alone, reverse=True):
        base[n], at = at, at + alone[n]
    ends, sizes = np.cumsum([alone[n] for n in base]), np.array([*base, 0], np.int64)

    def opens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq = batch.column(0).to_numpy()
            k = np.searchsorted(ends, seq, "right")
            zero = np.zeros(len(seq), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(seq_len - sizes[k]), pa.array(zero > 0), pa.array(seq), pa.array(zero), pa.array(zero)], names=["size", "unit", "a", "b", "m"])

    gaps = spark.range(opened).mapInArrow(opens, _STATE).where("size > 0")
    units = _units(spark, {n: c for n, c in totals.items() if n not in alone}, min(bundle, seq_len // 2))
    done = [spark.createDataFrame([(n, 0, c, base[n], -1) for n, c in alone.items()], width)]  # offset -1: each opens a sequence
    fields = ["size", "unit", "a", "b", "m"]

    def counted(state: DataFrame) -> list[int]:
        unit = lambda c: F.when(F.col("unit"), F.col(c))
        return list(state.agg(F.count("*"), F.count_if("unit"), F.min(unit("size")), F.max(unit("a")), F.max(unit("m"))).first())

    state = gaps.unionByName(units)
    n, n_units, least, longest, bundled = counted(state)
    while n_units:
        here = sweep(state.where(F.col("unit") | (F.col("size") >= least)), max(1, min(n // ROUND_ROWS + 1, 10_000)))
        done.append(here.where("unit AND by IS NOT NULL").select(F.col("a").alias("length"), F.col("b").alias("rank"), "m", F.col("by").alias("sequence_id"), (F.lit(seq_len) - F.col("by_size")).alias("offset")))
        waiting = here.where("unit AND by IS NULL").select(*fields)
        open_ = here.where("NOT unit").withColumn("size", F.col("size") - F.coalesce("by_size", F.lit(0))).where("size > 0").select(*fields)
        n_before, state = n_units, open_.unionByName(waiting)
        n, n_units, least, longest, bundled = counted(state)
        if not n_units or (n_before - n_units) * FEW > n_before:
            continue
        if bundled > 1:
            half = F.ceil(F.col("m") / 2).cast("long")
            halves = F.array(F.struct(F.lit(0).cast("long").alias("skip"), half.alias("n")), F.struct(half.alias("skip"), (F.col("m") - half).alias("n")))
            split = waiting.withColumn("h", F.explode(halves)).where("h.n > 0")
            split = split.select((F.col("a") * F.col("h.n")).alias("size"), "unit", "a", (F.col("b") + F.col("h.skip")).alias("b"), F.col("h.n").alias("m"))
            state = open_.unionByName(split)
            n, n_units, least, longest, bundled = counted(state)
        elif n_before == n_units:
            each = seq_len // longest  # single pieces, none longer than the longest
            ranked = _running(waiting, [F.desc("size"), "a", "b"], F.lit(1).cast("long"), "place", max(1, n_units // ROUND_ROWS))
            ranked = ranked.withColumn("by", F.lit(opened) + F.floor((F.col("place") - 1) / each))
            own = Window.partitionBy("by").orderBy("place")
            done.append(ranked.select(F.col("a").alias("length"), F.col("b").alias("rank"), "m", F.col("by").alias("sequence_id"), (F.sum("size").over(own) - F.col("size")).alias("offset")))
            break
    return reduce(lambda x, y: x.unionByName(y), done)


def pack(rows: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """rows (a table with node, piece, length, ...) with sequence_id and offset.

    Lengths are counted by a partial aggregate, and pieces ranked within (partition of the
    first scan, length) and from the counts of the partitions before, so that one length that
    a third of all pieces have is in no single task. best_fit_places works on ranks; a
    piece meets its place by length and rank, which no two share.
    """
    spark, names = rows.sparkSession, list(rows.columns)
    keyed = rows.withColumn("__part", F.shiftright("node", 33))
    counts = storage.cut(keyed.groupBy("length", "__part").agg(F.count("*").alias("__c")), "counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__c").alias("n")).collect()}  # seq_len rows at most
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "__part", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__start"))
    own = Window.partitionBy("__part", "length").orderBy("node", "piece")
    ranked = keyed.withColumn("__rn", F.row_number().over(own) - 1).join(starts, ["__part", "length"])
    ranked = ranked.withColumn("__rank", F.col("__start") + F.col("__rn"))
    found = best_fit_places(spark, totals, seq_len)
    first = F.broadcast(found.where("offset < 0").select("length", F.col("sequence_id").alias("__first")))  # seq_len rows at most
    spots = found.where("offset >= 0").withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    spots = spots.select(F.col("length").alias("__length"), (F.col("rank") + F.col("__k")).alias("__at"), "sequence_id", (F.col("offset") + F.col("__k") * F.col("length")).alias("offset"))
    big = ranked.join(first, "length").select(*names, (F.col("__first") + F.col("__rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    small = ranked.where(F.lit(2) * F.col("length") <= seq_len).join(spots, (F.col("length") == F.col("__length")) & (F.col("__rank") == F.col("__at")))
    return big.unionByName(small.select(*names, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids end with end_id. One of at most seq_len ids stays whole; a longer one
    is cut into pieces of seq_len, the rest being the first.

    Defined cases: null and empty texts are end_id alone; a very long text is encoded whole
    by one task and has many pieces; pieces of one length are alike and go by the order of
    the input; repeated rows and rows that share
    an id are packed each for itself; a null id stays null; an empty table gives an empty
    result; other columns are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = storage.cut(pieces(own, tokenizer_path, seq_len, end_id), "pieces")
    return pack(rows, seq_len).drop("node")


class CapacityTree:
    """A segment tree over gap sizes: which sizes have an open sequence, least size of at least n in log steps."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, gap: int, sequence: int) -> None:
        self.open[gap].append(sequence)
        at = self.leaves + gap
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(gap, sequence) of the least gap that holds need, taken out; None if none does."""
        at = self.leaves + need
        if not self.count[at]:
            # up to the first ancestor with something to the right, then down its left side
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at == 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        gap = at - self.leaves
        while at:
            self.count[at] -= 1
            at >>= 1
        return gap, self.open[gap].pop()


def best_fit_decreasing(lengths: np.ndarray, seq_len: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each piece and the number of sequences; ties go by place in lengths."""
    seq, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, n = CapacityTree(seq_len), 0
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        found = tree.take(length)
        if found is None:
            gap, s = seq_len, n
            n += 1
        else:
            gap, s = found
        seq[i], offset[i] = s, seq_len - gap
        if gap > length:
            tree.add(gap - length, s)
    return seq, offset, n


def _npy(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, a)
    return out.getvalue()


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = 0, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every task's documents by best-fit-decreasing into shards below path; returns the manifest.

    A shard has NAME.ids.npy, a (sequences, seq_len) matrix of 16-bit ids (32-bit where the
    vocabulary needs them) padded with end_id; NAME.cu_seqlens.npy, for each sequence the
    cumulative lengths of its segments from 0 on, one sequence after another, and
    NAME.cu_first.npy, where each sequence's begin; NAME.resets.npy, the flat places in the
    matrix where position ids begin again at 0, padding included; NAME.segments.npy, for
    each segment its document, piece, start, sequence, offset and length; and NAME.json.
    Names differ between task attempts and only those in the manifest count.

    Defined cases as in pack_documents; a null id is written as the least 64-bit number.
    """
    most = np.iinfo(np.int64).min

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pfs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        kind = np.uint16 if len(tokens.encoder(tokenizer_path).widths) <= 1 << 16 else np.uint32
        done: list[tuple[str, int, int, int]] = []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> None:
            nonlocal held, size
            if not held:
                return
            ids = np.concatenate([x for _, x, _ in held])
            total = np.concatenate([n for _, _, n in held])
            names = np.concatenate([d for d, _, _ in held])
            doc, piece, start, length = cut_lengths(total, seq_len)
            seq, offset, n_seq = best_fit_decreasing(length, seq_len)
            matrix = np.full(n_seq * seq_len, end_id, kind)
            from_ = (np.cumsum(total) - total)[doc] + start
            inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            matrix[np.repeat(seq * seq_len + offset, length) + inside] = ids[np.repeat(from_, length) + inside]
            by = np.lexsort((offset, seq))
            doc, piece, start, length, seq, offset = (x[by] for x in (doc, piece, start, length, seq, offset))
            used = np.bincount(seq, weights=length, minlength=n_seq).astype(np.int64)
            n_segments = np.bincount(seq, minlength=n_seq)
            ends = offset + length
            cu_first = np.concatenate([[0], np.cumsum(n_segments + 1)])
            cu = np.zeros(cu_first[-1], np.int32)
            cu[np.arange(len(seq)) + seq + 1] = ends
            resets = np.sort(np.concatenate([seq * seq_len + offset, np.flatnonzero(used < seq_len) * seq_len + used[used < seq_len]]))
            segments = np.column_stack([names[doc], piece, start, seq, offset, length]).astype(np.int64)
            name = f"shard-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}"
            files = {"ids": matrix.reshape(n_seq, seq_len), "cu_seqlens": cu, "cu_first": cu_first.astype(np.int64), "resets": resets.astype(np.int64), "segments": segments}
            for what, a in files.items():
                with fs.open_output_stream(f"{root}/{name}.{what}.npy") as out:
                    out.write(_npy(a))
            with fs.open_output_stream(f"{root}/{name}.json") as out:
                out.write(json.dumps({"seq_len": seq_len, "sequences": n_seq, "segments": len(seq), "tokens": int(length.sum()), "end_id": end_id, "dtype": np.dtype(kind).name}).encode())
            done.append((name, n_seq, len(seq), int(length.sum())))
            held, size = [], 0

        for batch in batches:
            for lo, hi, ids, at in tokens.encoded(batch.column(1), tokenizer_path, end_id):
                own = batch.column(0).slice(lo, hi - lo).fill_null(most).to_numpy(zero_copy_only=False)
                held.append((own, ids.astype(kind), np.diff(at)))
                size += len(ids)
                if size >= shard_tokens:
                    flush()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["shard", "sequences", "segments", "tokens"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return storage.cut(own.mapInArrow(bw.tidied(write), "shard string, sequences long, segments long, tokens long"), "manifest")


def read_shards(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Every segment as the shards have it, one task for each: its ids are cut from the matrix by cu_seqlens.

    Position resets and the segment table are held against cu_seqlens; a difference fails.
    A null id comes back null; a manifest without shards gives an empty result; files that
    the manifest does not name are not read.
    """
    lost = np.iinfo(np.int64).min

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pfs.FileSystem.from_uri(path)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                a = {}
                for what in ("ids", "cu_seqlens", "cu_first", "resets", "segments"):
                    with fs.open_input_file(f"{root}/{shard}.{what}.npy") as f:
                        a[what] = np.load(io.BytesIO(f.read()))
                ids, cu, first, seg = a["ids"].ravel(), a["cu_seqlens"].astype(np.int64), a["cu_first"], a["segments"]
                seq = np.repeat(np.arange(len(first) - 1), np.diff(first) - 1)
                at = np.arange(len(seq)) + seq
                offset, length = cu[at], cu[at + 1] - cu[at]
                width = a["ids"].shape[1]
                if not (np.array_equal(seg[:, 3], seq) and np.array_equal(seg[:, 4], offset) and np.array_equal(seg[:, 5], length) and np.isin(seq * width + offset, a["resets"]).all()):
                    raise ValueError(f"{shard}: its segments, cumulative lengths and resets do not agree")
                begin = seq * width + offset
                crcs = [tokens.crc(ids[x : x + n]) for x, n in zip(begin, length)]
                doc = pa.array(seg[:, 0], mask=seg[:, 0] == lost)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(seq)), doc, pa.array(seg[:, 1], pa.int32()), pa.array(seg[:, 2]), pa.array(length), pa.array(crcs, pa.int64()), pa.array(seq), pa.array(offset)],
                    names=["shard", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
                )

    shards = manifest.select("shard")
    tasks = max(1, min(shards.count(), 100_000))
    return shards.repartition(tasks).mapInArrow(read, "shard string, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
