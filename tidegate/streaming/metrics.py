"""Rule counters of a stream as rows: what each micro-batch observed, written with its batch id."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidegate.operators.expectations import Rules
from tidegate.sources.partitioned import AppendLog

METRICS_DDL = "metrics string, batch_id bigint, rule string, passed bigint, failed bigint"


class _Collector(StreamingQueryListener):
    """Keeps the observed counters of one name, a few numbers per micro-batch."""

    def __init__(self, name: str):
        self.name, self.batches, self.ended = name, {}, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counted = event.progress.observedMetrics.get(self.name)
        if counted is not None:
            self.batches[event.progress.batchId] = counted.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        # Events arrive in order, so all progress of the query is here.
        self.ended.set()


@contextmanager
def recorded(spark: SparkSession, name: str, rules: Rules, log: AppendLog, patience: float = 60) -> Iterator[None]:
    """Record the counters `name` of the stream that runs inside the block; one run of the log per batch.

    A batch that is done again after a crash reports its counters again and replaces its rows. One stream at a time may
    run inside the block.
    """
    collector = _Collector(name)
    spark.streams.addListener(collector)
    try:
        yield
        if not collector.ended.wait(patience):
            raise TimeoutError(f"the stream observed as {name} has not ended")
    finally:
        spark.streams.removeListener(collector)
    for batch, counted in sorted(collector.batches.items()):
        rows = [(name, batch, rule, counted["rows"] - counted[rule], counted[rule]) for rule in rules]
        log.append(spark.createDataFrame(rows, METRICS_DDL), f"{name}-{batch}")
