"""Counters of a run, taken while its rows are written: no second pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession

STATS = "run string, counter string, value long"


def observed(rows: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """rows, and what counts them once they have been written or read by one action.  An action that reads rows twice (a sort of the
    whole, before it deals them out) counts them twice, so settle what is observed."""
    seen = Observation()
    return rows.observe(seen, *(c.alias(name) for name, c in counts.items())), seen


def save(spark: SparkSession, path: str, run: str, counts: dict[str, int | None]) -> None:
    """Adds a run's counters to the table of runs."""
    rows = [(run, name, int(value or 0)) for name, value in sorted(counts.items())]
    spark.createDataFrame(rows, STATS).coalesce(1).write.mode("append").parquet(path)
