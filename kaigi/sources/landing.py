"""The landed table: Parquet with one folder a day.  New rows land once; changed ones are merged by key, and only the days that
hold a changed key are written anew.

A day is rewritten by Spark's dynamic partition overwrite: its files are staged beside the table and take the place of the old
ones when all of them are there, so a run that fails leaves the table as it was and can be repeated.  Two runs must not write
to one table at the same time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import settled

#: The partition column; rows without a day are in `none`.
DAY = "landed_day"
NO_DAY = "none"


@dataclass(frozen=True)
class Landing:
    """Counts of a run: keys that are new, changed, and as they were; rows without a key, which don't land; the days rewritten."""

    inserted: int = 0
    updated: int = 0
    unchanged: int = 0
    skipped: int = 0
    rewritten: tuple[str, ...] = field(default=())


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def landed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table with its partition column; of the given schema and empty where nothing has landed yet."""
    whole = None if schema is None else T.StructType([*schema.fields, T.StructField(DAY, T.StringType())])
    if whole is not None and not _exists(spark, path):
        return spark.createDataFrame([], whole)
    if whole is None:
        found = spark.read.parquet(path).schema
        whole = T.StructType([f for f in found.fields if f.name != DAY] + [T.StructField(DAY, T.StringType())])
    return spark.read.schema(whole).parquet(path)


def _last(rows: DataFrame, key: str, order: Column | None) -> DataFrame:
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    by = F.struct(F.lit(0) if order is None else order, F.xxhash64(row))
    return rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, by).alias("_row")).select("_row.*")


def merge(rows: DataFrame, path: str, key: str, day: str, order: Column | None = None, moves: bool = False, update: bool = True) -> Landing:
    """Brings rows (of the table's columns) into the table by key: new keys are appended, changed ones replace what was there.

    Of rows with one key the last by `order` counts, ties by a hash of the row.  `day` is the column that names the partition.
    moves: a key may have landed under another day than it has now; without it only the days of the rows are read.
    update=False leaves keys that have landed as they are."""
    spark, columns = rows.sparkSession, rows.columns
    whole = F.struct(*(F.col(f"`{c}`") for c in columns))
    given = _last(rows.where(F.col(key).isNotNull()), key, order).withColumn(DAY, F.coalesce(F.nullif(F.col(day).cast("string"), F.lit("")), F.lit(NO_DAY)))
    skipped = rows.where(F.col(key).isNull()).count()
    given = settled(given)
    table = landed(spark, path, rows.schema)
    # As many as the rows have days, which the calendar bounds.
    days = [r[0] for r in given.select(DAY).distinct().collect()]
    there = table if moves else table.where(F.col(DAY).isin(days))
    prints = lambda df, a, b: df.select(F.col(key).alias("_key"), F.xxhash64(whole).alias(a), F.xxhash64(F.lit(1), whole).alias(b), F.col(DAY).alias(f"{a}_day"))
    both = prints(given, "new", "new2").join(prints(there, "old", "old2"), "_key", "left")
    state = F.when(F.col("old").isNull(), "new").when((F.col("new") == F.col("old")) & (F.col("new2") == F.col("old2")) & (F.col("new_day") == F.col("old_day")), "same").otherwise("changed")
    told = settled(both.select("_key", F.col("new_day"), F.col("old_day"), state.alias("state")))
    n = {r.state: r.n for r in told.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}
    changed = told.where("state = 'changed'") if update else told.where("false")
    touched = sorted(r[0] for r in changed.select(F.explode(F.array("new_day", "old_day"))).distinct().collect())
    fresh = given.join(told.where("state = 'new'").select(F.col("_key").alias(key)), key, "left_semi").select(*columns, DAY)
    if touched:
        kept = table.where(F.col(DAY).isin(touched)).join(changed.select(F.col("_key").alias(key)), key, "left_anti").select(*columns, DAY)
        moved = given.join(changed.select(F.col("_key").alias(key)), key, "left_semi").select(*columns, DAY)
        result = kept.unionByName(moved).unionByName(fresh.where(F.col(DAY).isin(touched)))
        left = {r[0] for r in result.select(DAY).distinct().collect()} if moves else set(touched)
        result.repartition(DAY, F.pmod(F.xxhash64(key), F.lit(_spread(spark)))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
        for gone in set(touched) - left:
            _delete(spark, f"{path}/{DAY}={gone}")
    if n.get("new"):
        rest = fresh.where(~F.col(DAY).isin(touched)) if touched else fresh
        rest.repartition(DAY, F.pmod(F.xxhash64(key), F.lit(_spread(spark)))).write.mode("append").partitionBy(DAY).parquet(path)
    return Landing(n.get("new", 0), n.get("changed", 0) if update else 0, n.get("same", 0) + (0 if update else n.get("changed", 0)), skipped, tuple(touched))


def land(rows: DataFrame, path: str, key: str, day: str) -> Landing:
    """Appends the rows whose key has not landed; running again lands nothing."""
    return merge(rows, path, key, day, moves=True, update=False)


def _spread(spark: SparkSession) -> int:
    """Tasks that share a day, so that no day is one task's; AQE joins small ones again."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
