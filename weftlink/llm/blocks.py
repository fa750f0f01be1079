"""Rows written once in immutable blocks, so that every pass reads the same rows under the same numbers.

A pass over a DataFrame sees its rows in whatever partitions the scan makes at that moment.
Operators that look at a corpus more than once therefore write it as blocks first: Arrow
streams, one after another in a file for each task, listed in a manifest. A block holds
some megabytes and is never split; a row's number is its block's, shifted by ROW_BITS, plus
its place there. Files have names that no other task attempt has and only those of the
manifest count, so lost executors and repeated tasks neither double nor lose rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pfs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bytewords as bw
from . import storage

#: Bytes of a block, about (one row may be larger and is a block of its own), and bits for the place of a row in it.
BLOCK_BYTES, ROW_BITS = 6 << 20, 16
#: Bits for the number of a block among those of its task.
_TURN_BITS = 22
#: Blocks of a task, about, where there are many, and tasks at most.
TASK_BLOCKS, MOST_TASKS = 16, 100_000


@dataclass
class Blocks:
    """A table in blocks: its folder, manifest and schema, and counted blocks, rows and bytes."""

    path: str
    manifest: DataFrame
    schema: T.StructType
    count: int
    rows: int
    bytes: int

    @property
    def tasks(self) -> int:
        return max(1, min(self.count, 64), min(self.count // TASK_BLOCKS, MOST_TASKS))

    def drop(self) -> None:
        storage.drop_path(self.manifest.sparkSession, self.path)
        storage.drop_cut(self.manifest)


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of every row, about."""
    n = batch.num_rows
    total = np.full(n, 8 * batch.num_columns, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
            total += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        else:
            total += column.nbytes // max(n, 1)
    return total


def write(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> Blocks:
    """Write rows, each as it is, in blocks of about block_bytes; an empty table gives no block."""
    path = storage.fresh_path(rows.sparkSession, "blocks")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pfs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        out, at, held, size, n = None, 0, [], 0, 0
        done: list[tuple[int, str, int, int, int, int]] = []

        def flush() -> None:
            nonlocal out, at, held, size, n
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            sink = pa.BufferOutputStream()
            whole = pa.Table.from_batches(held).combine_chunks()
            with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as stream:
                stream.write_table(whole)
            packed = sink.getvalue()
            out.write(packed)
            done.append(((part << _TURN_BITS) | len(done), name, at, packed.size, n, size))
            at, held, size, n = at + packed.size, [], 0, 0

        for batch in batches:
            total = np.concatenate([[0], np.cumsum(_weights(batch))])
            lo = 0
            while lo < batch.num_rows:
                hi = int(np.searchsorted(total, total[lo] + block_bytes - size, "right")) - 1
                hi = min(max(hi, lo + (not held)), batch.num_rows, lo + (1 << ROW_BITS) - n)
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
                    size, n = size + int(total[hi] - total[lo]), n + hi - lo
                if hi < batch.num_rows:
                    flush()
                lo = hi
        if held:
            flush()
        if out is not None:
            out.close()
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in enumerate(kinds)], names=["block", "file", "start", "size", "n", "bytes"])

    manifest = storage.cut(rows.mapInArrow(bw.tidied(put), "block long, file string, start long, size long, n long, bytes long"), "manifest")
    count, n, size = manifest.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return Blocks(path, manifest, rows.schema, count, n, size)


def _load(fs: pfs.FileSystem, root: str, file: str, start: int, size: int) -> pa.RecordBatch:
    with fs.open_input_file(f"{root}/{file}") as f:
        packed = f.read_at(size, start)
    table = pa.ipc.open_stream(pa.py_buffer(packed), options=pa.ipc.IpcReadOptions(use_threads=False)).read_all()
    return table.combine_chunks().to_batches()[0]


def each(blocks: Blocks, f: Callable[[int, pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """f(number, rows) of every block, in tasks that take some blocks each."""
    path = blocks.path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pfs.FileSystem.from_uri(path)
        for batch in batches:
            for block, file, start, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
                yield from f(block, _load(fs, root, file, start, size))
                bw.tidy()

    return blocks.manifest.select("block", "file", "start", "size").repartition(blocks.tasks).mapInArrow(run, schema)


def together(blocks: Blocks, side: DataFrame, f: Callable[[int, pa.RecordBatch, pa.Table], pa.Table], schema: str | T.StructType) -> DataFrame:
    """f(number, rows, side's rows of that block) of every block, with or without rows in side (block, ...)."""
    path = blocks.path
    names = [c for c in side.columns if c != "block"]
    listed = blocks.manifest.select("block", F.col("file").alias("__file"), F.col("start").alias("__start"), F.col("size").alias("__size"))
    both = side.unionByName(listed, allowMissingColumns=True)

    def run(table: pa.Table) -> pa.Table:
        own = table.filter(pc.is_valid(table.column("__file")))
        rest = table.filter(pc.is_null(table.column("__file"))).select(names)
        fs, root = pfs.FileSystem.from_uri(path)
        file, start, size = (own.column(c)[0].as_py() for c in ("__file", "__start", "__size"))
        out = f(own.column("block")[0].as_py(), _load(fs, root, file, start, size), rest)
        bw.tidy()
        return out

    return both.repartition(blocks.tasks, "block").groupBy("block").applyInArrow(run, schema)
