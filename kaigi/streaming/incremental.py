"""Incremental runs: new meetings only, and sending that resumes where it stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.incremental import new_rows
from ..sources import retrieval, sinks
from ..sources.meeting_api import enable
from ..sources.readers import MEETING, UPLOADS, parsed_meetings, upload_log


def landed_meetings(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of meeting files.  land_stream leaves out what has landed."""
    return spark.readStream.schema(MEETING).option("multiLine", True).option("maxFilesPerTrigger", files_per_batch).json(folder)


def listed_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A stream of the meetings that the service lists, from the position that the last batch reached."""
    enable(spark)
    return parsed_meetings(spark.readStream.format("meeting_api").options(**options).load())


def land_stream(meetings: DataFrame, path: str, checkpoint: str, **trigger):
    """A query that lands each meeting once (all there are, unless a trigger says otherwise).  Each batch meets the landed table in an
    anti-join, so there is no state that grows; a batch that runs again lands nothing twice."""

    def land(batch: DataFrame, _: int) -> None:
        sinks.land_meetings(batch, path)

    return meetings.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def send_batch(sessions: DataFrame, log_path: str, sink: sinks.RetrievalSink) -> int:
    """Sends sessions (session_name, text) that the log lacks to a sink of whole tables and adds them to the log; the number sent.
    Running again is a no-op."""
    new = new_rows(sessions, upload_log(sessions.sparkSession, log_path), "session_name")
    ids = sink.send(new).cache()
    n = ids.count()
    if n:
        ids.select(*(x.split()[0] for x in UPLOADS.split(", "))).write.mode("append").parquet(log_path)
    ids.unpersist()
    return n


def send_items(sessions: DataFrame, log: str, tasks: int = 1, **options: str) -> None:
    """Sends sessions (session_name, text) that the log lacks one by one, each logged when it is sent (sources.retrieval); of equal
    names one.  Nothing is scanned again from item to item."""
    spark = sessions.sparkSession
    spark.dataSource.register(retrieval.Retrieval)
    new = new_rows(sessions.select("session_name", "text").dropDuplicates(["session_name"]), retrieval.sent_items(spark, log), "session_name")
    new.repartition(tasks, "session_name").write.format("retrieval").options(log=log, **options).mode("append").save()


def send_stream(sessions: DataFrame, log: str, checkpoint: str, **options: str):
    """A query that sends all sessions there are and stops; a batch that was cut short goes on with what is not logged."""
    sessions.sparkSession.dataSource.register(retrieval.Retrieval)
    writer = sessions.select("session_name", "text").writeStream.format("retrieval").options(log=log, **options)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
