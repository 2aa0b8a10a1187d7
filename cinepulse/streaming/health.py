"""Health counters of streaming queries, kept beyond the retained progress reports.

A query keeps only its last progress reports (``spark.sql.streaming.numRecentProgressUpdates``),
so counters must be added up as the reports come. ``ProgressTotals`` is a listener that
does so for every query of the session, and with a ``path`` also keeps one small file per
run, so that the totals of a query (its id lives as long as its checkpoint) outlive the job.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class ProgressTotals(StreamingQueryListener):
    """Input rows and rows dropped as too late, per query over all its runs.

    Start it before the queries: ``totals = ProgressTotals(spark, path).attach()``.
    Without a ``path`` the totals last as long as the session.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self._spark, self._path = spark, path
        self._lock = threading.Lock()
        self._ended: set[str] = set()
        #: (query id, run id) -> [input rows, rows dropped by the watermark]
        self._totals: dict[tuple[str, str], list[int]] = self._load() if path else {}

    def attach(self) -> ProgressTotals:
        self._spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self._spark.streams.removeListener(self)

    # --- listener ---------------------------------------------------------------

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        key = (str(p.id), str(p.runId))
        with self._lock:
            total = self._totals.setdefault(key, [0, 0])
            total[0] += p.numInputRows
            total[1] += dropped
            if self._path and (p.numInputRows or dropped):
                self._save(key, total)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    # --- totals -----------------------------------------------------------------

    def _sum(self, query: StreamingQuery | str, which: int) -> int:
        qid = query if isinstance(query, str) else str(query.id)
        with self._lock:
            return sum(t[which] for (q, _), t in self._totals.items() if q == qid)

    def events_processed(self, query: StreamingQuery | str) -> int:
        """Input rows of the query (or query id) over all its runs."""
        return self._sum(query, 0)

    def late_rows_dropped(self, query: StreamingQuery | str) -> int:
        """Rows that the watermark dropped as too late, over all runs of the query."""
        return self._sum(query, 1)

    def wait(self, query: StreamingQuery, timeout_s: float = 60) -> ProgressTotals:
        """Wait until the reports of a run that ended have all arrived."""
        end = time.monotonic() + timeout_s
        while time.monotonic() < end:
            with self._lock:
                if str(query.runId) in self._ended:
                    return self
            time.sleep(0.05)
        raise TimeoutError(f"no end of run {query.runId} reported in {timeout_s}s")

    # --- one small file per run ---------------------------------------------------

    def _fs(self, name: str = ""):
        jvm = self._spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self._path}/{name}" if name else self._path)
        return path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()), path

    def _save(self, key: tuple[str, str], total: list[int]) -> None:
        fs, path = self._fs(f"{key[0]}_{key[1]}.json")
        out = fs.create(path, True)
        try:
            out.write(bytearray(json.dumps(total).encode()))
        finally:
            out.close()

    def _load(self) -> dict[tuple[str, str], list[int]]:
        fs, root = self._fs()
        if not fs.exists(root):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        texts = {r.path.rsplit("/", 1)[-1]: bytes(r.content) for r in self._spark.read.format("binaryFile").load(self._path).collect()} if names else {}
        return {tuple(n.removesuffix(".json").split("_", 1)): json.loads(t) for n, t in texts.items() if n.endswith(".json") and t}
