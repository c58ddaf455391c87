"""Running counters of a stream: fetches, failed fetches, published rows."""

from __future__ import annotations

import logging
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

FETCHED = "fetched"
PUBLISHED = "published"


def count_fetches(df: DataFrame, error: str = "error") -> DataFrame:
    """Count rows and failures while they pass; adds no shuffle and no second read."""
    failed = F.col(error).isNotNull() if error in df.columns else F.lit(False)
    return df.observe(FETCHED, F.count(F.lit(1)).alias("fetches"),
                      F.count_if(failed).alias("fetch_errors"))


def count_published(df: DataFrame) -> DataFrame:
    return df.observe(PUBLISHED, F.count(F.lit(1)).alias("publishes"))


class LateRows(StreamingQueryListener):
    """Rows dropped behind the watermark, per query id, over all batches; register before starting.

    A query itself remembers the progress of its last batches only.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        with self._lock:
            query = str(event.progress.id)
            self.totals[query] = self.totals.get(query, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class RunningCounters(StreamingQueryListener):
    """Adds up the observed counts over batches; register with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.totals = {"fetches": 0, "fetch_errors": 0, "publishes": 0}

    def onQueryStarted(self, event) -> None:
        log.info("stream %s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        with self._lock:
            for row in event.progress.observedMetrics.values():
                for name, count in row.asDict().items():
                    if name in self.totals:
                        self.totals[name] += count or 0
            log.info("counters %s", self.totals)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("stream %s ended, counters %s", event.id, self.totals)
