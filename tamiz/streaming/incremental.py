"""Incremental loads as streams: new raw files are merged into the clean table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tamiz.sinks.tables import merge_partitions

Split = Callable[[DataFrame, int], tuple[DataFrame, DataFrame]]


def stream_merge(
    stream: DataFrame,
    split: Split,
    path: str,
    quarantine: str,
    keys: Sequence[str],
    newest_by: Sequence[Column],
    partitions: Sequence[str],
    checkpoint: str,
) -> StreamingQuery:
    """Process all new input, merging valid rows (latest wins) and filing rejected ones.

    The checkpoint remembers the input files already taken. A micro-batch that is
    replayed after a failure gives the same tables: the merge is idempotent per key
    and rejected rows go to a folder named after the batch.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid, rejected = split(batch, batch_id)
            merge_partitions(path, valid, keys, newest_by, partitions)
            rejected.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
