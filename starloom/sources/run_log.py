"""A log of what each stage of a run wrote, counted by the write itself."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.sources.sinks import append, ensure_table

RUN_SCHEMA = """
    run string, stage string, status string, rows bigint, metrics map<string, string>,
    message string, started_at timestamp, ended_at timestamp
"""
DONE, FAILED = "done", "failed"


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class RunLog:
    """Appends a row per stage to ``table``, whether it succeeds or fails.

    Numbers come from ``DataFrame.observe``: they are gathered while the rows are
    written, without another pass. ``clock`` gives the times, in UTC.
    """

    def __init__(self, spark: SparkSession, table: str, run: str, clock: Callable[[], datetime] = _now):
        self.spark, self.table, self.run, self.clock = spark, table, run, clock
        ensure_table(spark, table, RUN_SCHEMA)

    def write(
        self,
        stage: str,
        df: DataFrame,
        writer: Callable[[DataFrame], object],
        metrics: Mapping[str, Column] | None = None,
    ) -> int:
        """Hand ``df`` to ``writer``, which writes it once, and log how many rows it had.

        ``metrics`` are further aggregates of ``df``. An error is logged and raised.
        """
        started = self.clock()
        seen = Observation()
        names = dict(metrics or {})
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in names.items()])
        try:
            writer(observed)
        except Exception as error:
            self._add(stage, FAILED, None, {}, str(error)[:1000], started)
            raise
        found = seen.get
        told = {n: None if found[n] is None else str(found[n]) for n in names}
        self._add(stage, DONE, found["rows"], told, None, started)
        return found["rows"]

    def _add(self, stage, status, rows, metrics, message, started) -> None:
        row = (self.run, stage, status, rows, metrics, message, started, self.clock())
        append(self.spark.createDataFrame([row], RUN_SCHEMA), self.table)

    def rows(self) -> DataFrame:
        """What was logged of this run."""
        return self.spark.table(self.table).where(F.col("run") == self.run)
