"""What is new: anti-joins against what has landed or been sent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .minutes import has_speech


def new_rows(rows: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    return rows.join(landed.select(key), key, "left_anti")


def to_enrich(meetings: DataFrame, corrupt: str | None = None) -> DataFrame:
    """Meetings without any speech text, and unreadable ones."""
    wanted = ~has_speech(F.col("speechRecord"))
    return meetings.where(wanted | F.col(corrupt).isNotNull() if corrupt else wanted)


def enriched(listed: DataFrame, full: DataFrame, key: str = "issueID") -> DataFrame:
    """One row for each meeting: the full record where there is one."""
    both = listed.withColumn("_full", F.lit(0)).unionByName(full.withColumn("_full", F.lit(1)))
    return both.groupBy(key).agg(F.max_by(F.struct(*(c for c in listed.columns if c != key)), "_full").alias("_m")).select(key, "_m.*")
