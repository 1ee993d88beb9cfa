"""What streaming queries report while they run."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class InputRows(StreamingQueryListener):
    """Rows that each run of a query took from its sources.

    A query's own list of progress forgets all but the last batches; this adds them up as they come.
    """

    def __init__(self) -> None:
        self._rows: dict[str, int] = defaultdict(int)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._rows[str(event.progress.runId)] += event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, wait: float = 60.0) -> int | None:
        """The rows of an ended run, None if its end is not reported within ``wait`` seconds."""
        run = str(query.runId)
        return self._rows[run] if self._ended[run].wait(wait) else None


@contextmanager
def input_rows(spark: SparkSession) -> Iterator[InputRows]:
    """Count the input of the queries that run within a block."""
    listener = InputRows()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
