"""Exports.  Tables stay parquet; ordered files for readers outside Spark are written in ranges, part by part."""

from __future__ import annotations

import csv
import io
import json
import os
import tempfile
import uuid
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_filename, strip
from ..operators.minutes import file_name
from .landing import Landing, land, merge
from .readers import require


def meeting_file(meeting: DataFrame) -> Column:
    """YYYYMMDD_house_meeting_issue_issueID.json of each meeting."""
    part = lambda c: safe_filename(F.coalesce(F.col(c), F.lit("")))
    return F.concat(F.concat_ws("_", F.replace(F.coalesce(F.col("date"), F.lit("00000000")), F.lit("-"), F.lit("")), part("nameOfHouse"), part("nameOfMeeting"), part("issue"), part("issueID")), F.lit(".json"))


def land_meetings(meetings: DataFrame, path: str) -> Landing:
    """Lands whole records, with the name that each one's file would have in file_name, in a table by day; meetings that are there
    stay as they are."""
    return land(meetings.withColumn("file_name", meeting_file(meetings)), path, "issueID", "date")


def merge_meetings(meetings: DataFrame, path: str) -> Landing:
    """Puts whole records in the place of those with their issueID."""
    return merge(meetings.withColumn("file_name", meeting_file(meetings)), path, "issueID", "date")


def meeting_files(meetings: DataFrame, folder: str) -> int:
    """One JSON file for each meeting, named by meeting_file, as save_files writes them."""
    record = F.to_json(F.struct(*(c for c in meetings.columns if c not in ("file_name", "_corrupt"))), {"ignoreNullFields": "false"})
    return save_files(meetings.select(meeting_file(meetings).alias("file_name"), record.cast("binary").alias("content")), folder)


def save_files(rows: DataFrame, folder: str) -> int:
    """Writes each row's content (binary) as folder/file_name, from the tasks, and returns the number of files.

    The folder must be the same on all machines, such as a mount.  Each file appears whole or not at all, so a task that runs
    again does no harm; of equal names one stays."""

    def written(batches):
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with tempfile.NamedTemporaryFile(dir=folder, prefix=".part-", delete=False) as out:
                    out.write(content or b"")
                os.chmod(out.name, 0o644)
                os.replace(out.name, os.path.join(folder, os.path.basename(name)))
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return rows.select("file_name", "content").mapInArrow(written, "n long").agg(F.sum("n")).first()[0] or 0


def features_json(ranked: DataFrame, sessions: DataFrame, path: str, key: str = "session_seq", label: str = "label") -> None:
    """One JSON line for each label, in the order in which labels first appear: the words with score and count, by rank, of the last
    session that has the label; none where that session has none."""
    count = "count" if "count" in ranked.columns else "tf"
    item = F.struct("rank", F.col("term").alias("word"), F.round("weight", 4).alias("score"), F.col(count).alias("count"))
    items = F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("rank"))
    names = sessions.groupBy(label).agg(F.min(key).alias("_first"), F.max(key).alias(key))
    rows = names.join(ranked.groupBy(key).agg(items.alias("items")), key, "left")
    ordered_json(rows.select(label, F.coalesce("items", F.array()).alias("items"), "_first"), path, "_first", drop=("_first",))


def ordered_json(rows: DataFrame, path: str, *order, drop: tuple[str, ...] = ()) -> None:
    """JSON lines in part files by ranges of the order: read by name, or as _parts.json lists them, they make up the whole."""
    rows.orderBy(*order).drop(*drop).write.mode("overwrite").json(path)
    _list_parts(rows.sparkSession, path)


def ordered_csv(rows: DataFrame, path: str, *order, drop: tuple[str, ...] = ()) -> None:
    """CSV in part files by ranges of the order; the header is the first line of the first."""
    shown = [c for c in rows.columns if c not in drop]
    flat = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes if c in shown]
    options = {"escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    names = io.StringIO()
    csv.writer(names, lineterminator="").writerow(shown)
    header = rows.sparkSession.createDataFrame([(0, names.getvalue())], "_place int, _line string")
    lines = rows.withColumn("_place", F.lit(1)).withColumn("_line", F.to_csv(F.struct(*flat), options))
    lines.unionByName(header, allowMissingColumns=True).orderBy("_place", *order).select("_line").write.mode("overwrite").text(path)
    _list_parts(rows.sparkSession, path)


def _put(spark: SparkSession, path: str, text: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop, True)
    out.write(bytearray(text.encode()))
    out.close()


def _list_parts(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = sorted(s.getPath().getName() for s in hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hadoop))
    _put(spark, f"{path}/_parts.json", json.dumps([n for n in names if not n.startswith(("_", "."))]))


def last_sessions(sessions: DataFrame, name: str = "session_name", order: str = "session_seq") -> DataFrame:
    """name, text of the sessions with text: stripped, with a line end; of equal names the last."""
    last = sessions.groupBy(name).agg(F.max_by("text", order).alias("text"))
    return last.where(F.length(strip(F.col("text"))) > 0).select(name, F.concat(strip(F.col("text")), F.lit("\n")).alias("text"))


def session_files(sessions: DataFrame, folder: str, space: str = "_", name: str = "session_name", order: str = "session_seq") -> int:
    """One text file for each session, named by minutes.file_name, as save_files writes them."""
    last = last_sessions(sessions, name, order)
    return save_files(last.select(file_name(safe_filename(F.col(name)), space).alias("file_name"), F.col("text").cast("binary").alias("content")), folder)


def corpus_text(sessions: DataFrame, path: str, order: str = "session_seq") -> None:
    """The concatenated corpus: texts by `order`, in part files that make it up one after the other."""
    sessions.orderBy(order).select("text").write.mode("overwrite").text(path)


class RetrievalSink(Protocol):
    """Where texts are sent for retrieval."""

    def create(self, name: str) -> str:
        """A new store; its id."""

    def send(self, rows: DataFrame) -> DataFrame:
        """The file ids of (session_name, text) rows."""


class ManifestSink:
    """The local sink: a parquet manifest with names, sizes and ids, no network."""

    def __init__(self, path: str, granularity: str = "session"):
        self.path, self.granularity = path, granularity

    def create(self, name: str) -> str:
        return new_store_id()

    def send(self, rows: DataFrame) -> DataFrame:
        made = rows.select("session_name", F.sha2(F.concat_ws("\n", "session_name", "text"), 256).alias("file_id"), F.length("text").alias("n_chars"), F.lit(self.granularity).alias("granularity"))
        made.write.mode("append").parquet(self.path)
        return made.select("session_name", "file_id")


def new_store_id() -> str:
    return f"store-{uuid.uuid4().hex}"


def send_corpus(spark: SparkSession, sessions: DataFrame, sink: RetrievalSink, name: str, id_path: str) -> str:
    """Makes a store, sends the whole corpus and writes the store's id to id_path; the id."""
    store = sink.create(name)
    sink.send(sessions.select(F.col("label").alias("session_name"), "text"))
    spark.createDataFrame([(store,)], "value string").coalesce(1).write.mode("overwrite").text(id_path)
    return store


def store_id(spark: SparkSession, given: str | None, id_path: str) -> str:
    """The store to use: the one given, else the one written by send_corpus, else a ValueError."""
    if given and given.strip():
        return given.strip()
    try:
        rows = spark.read.text(require(spark, id_path)).collect()
    except FileNotFoundError:
        raise ValueError(f"no store is given and there is none in {id_path}") from None
    return rows[0].value.strip()


def retrieval_filter(log: DataFrame, session_name: str) -> dict | None:
    """What limits a retrieval to one session; None if it was never sent."""
    found = log.where(F.col("session_name") == session_name).select("file_id").limit(1).collect()
    return {"type": "eq", "key": "file_id", "value": found[0].file_id} if found else None
