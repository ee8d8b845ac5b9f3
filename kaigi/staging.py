"""Intermediate results in the shared checkpoint folder: written once, read by everything that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.  Where it is unset, a local session uses a folder of the system's own;
    a cluster, whose machines don't share one, gets an error.  What is written there goes when nothing refers to it."""
    context = spark.sparkContext
    scala = context._jsc.sc()
    if not scala.getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named:
            if not scala.isLocal():
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            import tempfile

            named = tempfile.mkdtemp(prefix="kaigi-")
        context.setCheckpointDir(named)
    if not scala.conf().contains(_CLEAN_CHECKPOINTS):
        scala.conf().set(_CLEAN_CHECKPOINTS, "true")
    return scala.getCheckpointDir().get()


_CLEAN_CHECKPOINTS = "spark.cleaner.referenceTracking.cleanCheckpoints"
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder: lost executors cost no recomputation, and the shuffle files
    that led to them go as soon as they are written."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared checkpoint folder, made anew at every call and left there."""
    import uuid

    folder = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return folder
