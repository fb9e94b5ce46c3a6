"""Metrics of a running pipeline: a listener on Spark's progress events and where to report to."""

from __future__ import annotations

import datetime as dt
import json
import socket
import threading
import time
import urllib.request
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from changeloom.config import CdcConfig
from changeloom.model import UNIFIED_CHANGE
from changeloom.operators import metrics


class MetricsReporter(Protocol):
    def report(self, values: dict) -> None: ...


class StdoutReporter:
    def report(self, values: dict) -> None:
        print(json.dumps(values, default=str), flush=True)


class FileReporter:
    """Keeps the last report in a file of the driver's machine."""

    def __init__(self, path: str):
        self.path = path

    def report(self, values: dict) -> None:
        with open(self.path, "w") as f:
            json.dump(values, f, default=str)


class HttpReporter:
    """Posts each report as JSON from a thread of its own; a failure is dropped, as metrics must not stop the pipeline."""

    def __init__(self, url: str, headers: dict[str, str] | None = None, timeout: float = 10):
        self.url, self.headers, self.timeout = url, {"Content-Type": "application/json"} | (headers or {}), timeout

    def report(self, values: dict) -> None:
        threading.Thread(target=self._post, args=(json.dumps(values, default=str).encode(),), daemon=True).start()

    def _post(self, body: bytes) -> None:
        try:
            urllib.request.urlopen(urllib.request.Request(self.url, body, self.headers), timeout=self.timeout).close()
        except OSError:
            return


class TableReporter:
    """Appends reports to a Parquet table."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def report(self, values: dict) -> None:
        self.spark.createDataFrame([(json.dumps(values, default=str),)], "report string").write.mode("append").parquet(self.path)


def batch_reporter(reporters: list[MetricsReporter], namespace: str = "", config: CdcConfig | None = None, clock: Callable[[], float] = time.time):
    """For a pipeline: reports the interval metrics of each committed batch, from the end of the batch before."""
    header = (config or CdcConfig()).message_type_header
    last = [clock()]

    def report(batch_id: int, messages: DataFrame) -> None:
        unified = F.col("headers")[header] == UNIFIED_CHANGE if "headers" in messages.columns else F.lit(False)
        rows = messages.select("operation", "lsn", "event_time", F.current_timestamp().cast("timestamp_ntz").alias("produced_at"), F.coalesce(unified, F.lit(False)).alias("unified"))
        found, now = metrics.interval(rows).first().asDict(), clock()
        spent, n = now - last[0], found["produces_count"]
        late = found["latest_change_db_tran_end_time_produced"]
        values = {
            "metrics_namespace": namespace, "process_hostname": socket.gethostname(), "interval_start_epoch_sec": last[0], "interval_end_epoch_sec": now, "interval_delta_sec": spent, "batch_id": batch_id, **found,
            "delivery_acks_count": n, "produces_total_time_sec": spent, "produces_avg_time_per_record_ms": 1000 * spent / n if n else None,
            "cdc_process_lag_sec": None if late is None else round(now - late.replace(tzinfo=dt.timezone.utc).timestamp(), 3),
        }
        last[0] = now
        for r in reporters:
            r.report(values)

    return report


class ProgressListener(StreamingQueryListener):
    """Rates and durations of each micro-batch, from Spark's own progress events."""

    def __init__(self, reporters: list[MetricsReporter]):
        self.reporters = reporters

    def onQueryStarted(self, event) -> None:
        return

    def onQueryProgress(self, event) -> None:
        p = event.progress
        values = {"batch_id": p.batchId, "input_rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond, "duration_ms": dict(p.durationMs)}
        for r in self.reporters:
            r.report(values)

    def onQueryIdle(self, event) -> None:
        return

    def onQueryTerminated(self, event) -> None:
        """An error that ended a query is reported, whoever waits for it."""
        if event.exception:
            for r in self.reporters:
                r.report({"query": str(event.id), "error": event.exception})
