"""Linking of right records that arrive over time against a table of left records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions import text
from ..operators import blocking


def link_stream(records: DataFrame, left_keys: DataFrame, out: str, checkpoint: str, max_block_pairs: int = 5000) -> StreamingQuery:
    """Write candidate pairs (batch, l_idx, r_idx) of every micro-batch of raw right records as Parquet.

    left_keys is record_keys of the left side. A batch that runs again overwrites its own
    folder, so each record's pairs are written once.
    """

    def link(batch: DataFrame, number: int) -> None:
        right = blocking.record_keys(text.normalized(batch))
        blocking.join_keys(left_keys, right, max_block_pairs).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return records.writeStream.foreachBatch(link).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
