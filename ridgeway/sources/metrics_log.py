"""Table of run metrics, a partition per run."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

METRICS_SCHEMA = "run_id string, step string, metric string, value double, elapsed_s double"


class MetricsLog:
    """Collects ``(step, metric, value)`` with the time since the start.

    Rows are few (one per reported number). :meth:`flush` writes all of the run's rows so
    far in place of those written before: a run that is flushed or tried again counts once,
    other runs stay as they are, and a run leaves one small file, not one per metric.
    """

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark = spark
        self.path = path
        self.run_id = run_id or uuid.uuid4().hex
        self._start = time.monotonic()
        self._rows: list[tuple[str, str, str, float | None, float]] = []

    def add(self, step: str, metric: str, value: float | None) -> None:
        elapsed = time.monotonic() - self._start
        number = None if value is None else float(value)
        self._rows.append((self.run_id, step, metric, number, elapsed))

    def flush(self) -> None:
        if self._rows:
            rows = self.spark.createDataFrame(self._rows, METRICS_SCHEMA).coalesce(1)
            writer = rows.write.partitionBy("run_id").mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def read(self) -> DataFrame:
        """The rows of all runs."""
        found = self.spark.read.schema(METRICS_SCHEMA).parquet(self.path)
        return found.select(*(field.split()[0] for field in METRICS_SCHEMA.split(", ")))
