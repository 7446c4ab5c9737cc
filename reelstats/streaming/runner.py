"""Starting, draining and monitoring streaming queries."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("batchId", T.LongType()),
        T.StructField("numInputRows", T.LongType()),
        T.StructField("inputRowsPerSecond", T.DoubleType()),
        T.StructField("processedRowsPerSecond", T.DoubleType()),
    ]
)


def start_foreach_batch(stream: DataFrame, handler: Callable, checkpoint: str,
                        trigger: dict | None = None, output_mode: str = "update") -> StreamingQuery:
    """`trigger` is e.g. {"processingTime": "10 seconds"} or {"availableNow": True}."""
    return (
        stream.writeStream.foreachBatch(handler)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def start_sink(stream: DataFrame, fmt: str, checkpoint: str | None = None, path: str | None = None,
               trigger: dict | None = None, output_mode: str = "append",
               options: dict[str, str] | None = None) -> StreamingQuery:
    """Stream to any sink: `console`, `parquet`/`json` files (with a path), `kafka`, ..."""
    writer = stream.writeStream.format(fmt).outputMode(output_mode).options(**(options or {}))
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start(path) if path is not None else writer.start()


def drain(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an `availableNow` query to finish (or stop it after `timeout_s`)."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return query


def catch_up(query: StreamingQuery) -> StreamingQuery:
    """Wait until a running query has processed all that its sources hold, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        stop(query)
    if query.exception() is not None:
        raise query.exception()
    return query


def stop(query: StreamingQuery, patience_s: float = 10.0) -> None:
    """Stops a query, after the batch it is at where that ends within `patience_s`: a batch stopped
    between its handler and its commit would be handled again on a restart."""
    before, until = (query.lastProgress or {}).get("batchId"), time.monotonic() + patience_s
    while query.isActive and query.status["isDataAvailable"] and time.monotonic() < until:
        if (query.lastProgress or {}).get("batchId") != before:
            break
        time.sleep(0.02)
    if query.isActive:
        query.stop()


class ProgressTotals(StreamingQueryListener):
    """Batches and input rows of every query run while it listens, complete for any
    number of triggers (a query itself keeps about its last 100 reports)."""

    def __init__(self) -> None:
        self._runs: dict[str, dict] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802 (the listener's API names)
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self._changed:
            run = self._runs.setdefault(str(p.runId), {"batches": 0, "input_rows": 0, "last": None, "observed": {}})
            if p.batchId != run["last"]:  # an idle trigger reports the next batch without rows
                run["batches"] += p.numInputRows > 0
                for name, counts in p.observedMetrics.items() if p.numInputRows > 0 else ():
                    total = run["observed"].setdefault(name, {})
                    for metric, value in counts.asDict().items():
                        total[metric] = total.get(metric, 0) + (value or 0)
                run["last"] = p.batchId if p.numInputRows > 0 else run["last"]
            run["input_rows"] += p.numInputRows

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def totals(self, query: StreamingQuery, timeout_s: float = 60.0) -> dict:
        """{"batches", "input_rows"} of an ended query; its reports arrive before its end does."""
        run = str(query.runId)
        with self._changed:
            if not self._changed.wait_for(lambda: run in self._ended, timeout_s):
                raise TimeoutError(f"the end of query run {run} was not reported")
            found = self._runs.get(run, {"batches": 0, "input_rows": 0})
            return {"batches": found["batches"], "input_rows": found["input_rows"]}

    def observed(self, query: StreamingQuery, name: str, timeout_s: float = 60.0) -> dict:
        """Sums over all batches of an ended query of the counts watched under this name (`DataFrame.observe`)."""
        self.totals(query, timeout_s)
        with self._changed:
            return dict(self._runs.get(str(query.runId), {"observed": {}})["observed"].get(name, {}))


@contextmanager
def progress_totals(spark: SparkSession) -> Iterator[ProgressTotals]:
    """Listens to the queries started inside the block."""
    log = ProgressTotals()
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The progress reports that the query still holds, about the last 100, as rows;
    `progress_totals` counts all of them."""
    rows = [
        (
            p.get("batchId"),
            p.get("numInputRows"),
            _num(p.get("inputRowsPerSecond")),
            _num(p.get("processedRowsPerSecond")),
        )
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def poll_progress(query: StreamingQuery, interval_s: float = 5.0,
                  on_progress: Callable[[dict], None] = print, max_polls: int | None = None) -> int:
    """Driver-side monitor: while the query runs, report its latest progress
    (batch id, input rows, processed rows per second) every `interval_s`.
    Returns the number of reports made; a failed stream's exception is raised."""
    polls = reports = 0
    while query.isActive and (max_polls is None or polls < max_polls):
        p = query.lastProgress
        if p:
            on_progress({"batchId": p.get("batchId"), "numInputRows": p.get("numInputRows"),
                         "processedRowsPerSecond": p.get("processedRowsPerSecond")})
            reports += 1
        polls += 1
        time.sleep(interval_s)
    if query.exception() is not None:
        raise query.exception()
    return reports


def _num(v):
    return None if v is None else float(v)
