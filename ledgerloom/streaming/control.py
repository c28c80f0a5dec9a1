"""Running queries: offsets, delay alerts, throttled side jobs and stopping."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


def offsets(query: StreamingQuery) -> list[dict]:
    """Start, end and latest offsets per source of the last finished batch."""
    progress = query.lastProgress
    if not progress:
        return []
    return [
        {"source": s["description"], "start": s["startOffset"], "end": s["endOffset"],
         "latest": s.get("latestOffset")}
        for s in json.loads(progress.json if hasattr(progress, "json") else json.dumps(progress))["sources"]
    ]


class DelayListener(StreamingQueryListener):
    """Reports batches that take longer than ``max_delay_ms``, at most once per interval."""

    def __init__(self, max_delay_ms: int, report: Callable[[str], None], interval_ms: int = 60000) -> None:
        self.max_delay_ms = max_delay_ms
        self.interval_ms = interval_ms
        self.report = report
        self._reported_at = float("-inf")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        delay = progress.batchDuration
        now = time.monotonic() * 1000
        if delay >= self.max_delay_ms and now - self._reported_at >= self.interval_ms:
            self._reported_at = now
            self.report(
                f"query {progress.name or progress.id}: batch {progress.batchId} took {delay} ms "
                f"for {progress.numInputRows} rows (limit {self.max_delay_ms} ms)")


class Throttle:
    """Side jobs of a stream, each run at most once per its number of seconds."""

    def __init__(self, jobs: Mapping[str, tuple[float, Callable[[SparkSession], None]]],
                 clock: Callable[[], float] = time.monotonic) -> None:
        self.jobs = dict(jobs)
        self.clock = clock
        self._ran: dict[str, float] = {}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        for name, (seconds, job) in self.jobs.items():
            now = self.clock()
            if now - self._ran.get(name, float("-inf")) >= seconds:
                self._ran[name] = now
                job(batch.sparkSession)


NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: What one task of a micro-batch reads of its files, where the session leaves that to Spark: log lines and events are
#: some twenty times as large in memory as in Parquet, and a batch is held there.
SPLIT, SPARKS_SPLIT, LOG_SPLIT = "spark.sql.files.maxPartitionBytes", "134217728b", "16m"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for as long as a query is started: it keeps a copy of what held then."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def with_state_store(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a query whose state is in RocksDB, which state with timers and maps needs."""
    with settings(spark, {STATE_STORE: ROCKSDB}):
        return writer.start()


def run_to_end(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Run a stream over what is there now and return when it is done; its state is in RocksDB.

    State with processing-time timers asks for batches without data for as long as the
    query runs, so those are off here; the timers of lines that never become complete
    fire in a later run.
    """
    split = {SPLIT: LOG_SPLIT} if spark.conf.get(SPLIT) == SPARKS_SPLIT else {}
    with settings(spark, {NO_DATA_BATCHES: "false", **split}):
        query = with_state_store(writer.trigger(availableNow=True), spark)
    query.awaitTermination()
    return query


def place_marker(spark: SparkSession, path: str) -> None:
    """Write the marker file; removing it asks the queries to stop."""
    fs, folder = _file(spark, path)
    stream = fs.create(folder, True)
    stream.writeBytes(spark.sparkContext.applicationId)
    stream.close()


def run_until_marker_gone(query: StreamingQuery, spark: SparkSession, marker: str,
                          poll_seconds: float = 5.0) -> str:
    """Wait for the query; stop it once its marker file is gone. Returns the reason."""
    while True:
        if query.awaitTermination(poll_seconds):
            return "ended"
        fs, folder = _file(spark, marker)
        if not fs.exists(folder):
            query.stop()
            return "stopped"


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder
