"""Type-1 change application: a stream of row versions kept as the latest row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.operators.ordering import latest_per_key
from tidegate.session import stage
from tidegate.sources.partitioned import HOME, PartitionedTarget


def apply_batch(table: PartitionedTarget, changes: DataFrame, sequence: list[str]) -> list[str]:
    """Merge one micro-batch and return the ranges it rewrote.

    Older versions that arrive late lose against the stored sequence, and so does a batch that is
    applied a second time. `sequence` must order the versions of a key completely, so it ends in a tie-breaker.
    """
    keys = list(table.keys)
    newest = stage(latest_per_key(changes.select(*table.columns), keys, sequence), "changes")
    stored = table.stored(newest, *sequence).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*sequence).alias("_stored"), HOME)
    on = reduce(lambda a, b: a & b, [newest[k].eqNullSafe(stored[f"_k{i}"]) for i, k in enumerate(keys)])
    known = newest.join(stored, on, "left")
    return table.put(stage(known.filter(F.col("_stored").isNull() | (F.struct(*sequence) > F.col("_stored"))), "winners"))


def apply_changes(stream: DataFrame, table: PartitionedTarget, sequence: list[str], checkpoint: str) -> StreamingQuery:
    """Apply everything that has arrived to `table`, then stop."""

    def handle(batch: DataFrame, _batch_id: int) -> None:
        apply_batch(table, batch, sequence)

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
