"""Running several queries as one group: progress is recorded, and a failing one ends the others."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = "query string, batch bigint, input_rows bigint, state_rows bigint, millis bigint"
#: Progress rows kept; older ones are dropped first.
KEPT_ROWS = 100_000


class Watch(StreamingQueryListener):
    """Progress of the queries of one group, and the first failure among them."""

    def __init__(self, ids: Sequence[str]) -> None:
        self.ids = set(ids)
        self.rows: list[tuple] = []
        self.ended: dict[str, str | None] = {}
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.id) not in self.ids:
            return
        state = sum(s.numRowsTotal for s in p.stateOperators)
        with self.changed:
            self.rows.append((p.name, p.batchId, p.numInputRows, state, p.batchDuration))
            del self.rows[:-KEPT_ROWS]

    def onQueryTerminated(self, event) -> None:
        if str(event.id) in self.ids:
            with self.changed:
                self.ended[str(event.id)] = event.exception
                self.changed.notify_all()


class GroupFailed(RuntimeError):
    """A query of the group failed; the others were stopped."""


def run_watched(
    spark: SparkSession, queries: Sequence[StreamingQuery], check_every: float = 0.2, settle: float = 3.0
) -> DataFrame:
    """Wait until all queries have ended; if one fails, stop the others and raise :class:`GroupFailed`.

    Returns the recorded progress. Queries are looked at directly too, as one may have ended before the
    listener was there.
    """
    by_id = {str(q.id): q for q in queries}
    watch = Watch(list(by_id))
    spark.streams.addListener(watch)
    try:
        while True:
            failed = {q.name: q.exception() for q in queries if not q.isActive and q.exception() is not None}
            if failed:
                break
            if not any(q.isActive for q in queries):
                with watch.changed:  # reports of the last batches may still be on their way
                    watch.changed.wait_for(lambda: set(watch.ended) >= set(by_id), timeout=settle)
                break
            with watch.changed:
                watch.changed.wait_for(lambda: any(watch.ended.values()), timeout=check_every)
        if failed:
            for q in queries:
                if q.isActive:
                    q.stop()
            name, error = next(iter(failed.items()))
            raise GroupFailed(f"{name}: {error}")
        with watch.changed:
            return spark.createDataFrame(list(watch.rows), PROGRESS)
    finally:
        spark.streams.removeListener(watch)
