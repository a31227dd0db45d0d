"""Progress of runs: counters of batch writes, reports of streams, time left."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def clock(seconds: float) -> str:
    whole = max(0, round(seconds))
    return f"{whole // 3600:02d}:{whole // 60 % 60:02d}:{whole % 60:02d}"


def progress_line(done: int, total: int, elapsed: float) -> str:
    """Share done, rate and time left; an unknown rate leaves the time open."""
    rate = done / elapsed if elapsed > 0 else 0.0
    left = clock((total - done) / rate) if rate > 0 else "--:--:--"
    return f"{done}/{total} ({100 * done / total if total else 100:.1f} %) {rate:.1f} rows/s, {clock(elapsed)} gone, {left} left"


def observed(df: DataFrame, error: str) -> tuple[DataFrame, Observation]:
    """``df`` and the counters (rows, ok, failed) that are known once it has been written: no pass of their own."""
    seen = Observation()
    failed = F.coalesce(F.col(error) != "", F.lit(False))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed")), seen


class StreamMonitor(StreamingQueryListener):
    """Keeps one report a batch: rows taken, rows per second in and through, and what waits in the sources, where they tell."""

    def __init__(self, last: int = 1000):
        self.last, self.reports, self.ended = last, [], []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        waits = [s.metrics.get(k) for s in p.sources for k in ("numFilesOutstanding", "maxOffsetsBehindLatest") if s.metrics and s.metrics.get(k)]
        self.reports = [*self.reports, {"batch": p.batchId, "rows": p.numInputRows, "in": p.inputRowsPerSecond, "through": p.processedRowsPerSecond, "waits": waits}][-self.last :]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.append(str(event.id))
