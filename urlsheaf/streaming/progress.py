"""What the queries of a session report while they run, added up over their whole life."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "id string, run_id string, name string, batches long, input_rows long, late_rows long, output_rows long"


@dataclass
class _Totals:
    run_id: str = ""
    name: str | None = None
    batches: int = 0
    input_rows: int = 0
    late_rows: int = 0
    output_rows: int = 0
    written: int = 0


class ProgressTotals(StreamingQueryListener):
    """Adds up every progress event of every query; a query keeps the last 100 of them only.

    A query's totals are a handful of numbers on the driver.  With ``path`` they are also written as a table, a row per
    ``every`` batches and one at the end, of which the latest of a run holds.  Spark counts late rows where state is
    kept, after rows of equal keys were added up in a task.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, every: int = 100) -> None:
        self.spark, self.path, self.every = spark, path, every
        self.totals: dict[tuple[str, str], _Totals] = {}
        self.lock = threading.Lock()

    def __enter__(self) -> ProgressTotals:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.drain()
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.totals[str(event.id), str(event.runId)] = _Totals(str(event.runId), event.name)

    def onQueryProgress(self, event) -> None:
        told = event.progress
        with self.lock:
            own = self.totals.setdefault((str(told.id), str(told.runId)), _Totals(str(told.runId), told.name))
            own.batches += 1
            own.input_rows += told.numInputRows
            own.late_rows += sum(o.numRowsDroppedByWatermark for o in told.stateOperators)
            own.output_rows += max(0, told.sink.numOutputRows)
            due = own.batches - own.written >= self.every
        if due:
            self._write(str(told.id), str(told.runId))

    def onQueryIdle(self, event) -> None:
        """Nothing was processed."""

    def onQueryTerminated(self, event) -> None:
        self._write(str(event.id), str(event.runId))

    def _row(self, id: str, own: _Totals) -> tuple:
        return (id, own.run_id, own.name, own.batches, own.input_rows, own.late_rows, own.output_rows)

    def _write(self, id: str, run: str) -> None:
        with self.lock:
            own = self.totals[id, run]
            if self.path is None or own.written == own.batches:
                return
            row, own.written = self._row(id, own), own.batches
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def drain(self) -> None:
        """Wait until all events so far were handed over."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)

    def table(self) -> DataFrame:
        """One row per run of a query."""
        self.drain()
        with self.lock:
            rows = [self._row(id, own) for (id, _), own in self.totals.items()]
        return self.spark.createDataFrame(rows, SCHEMA)

    def late_rows(self, query: StreamingQuery) -> int:
        """Rows that the query's watermark has dropped so far, in this run."""
        self.drain()
        with self.lock:
            return self.totals[str(query.id), str(query.runId)].late_rows
