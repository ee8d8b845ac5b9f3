"""Sending texts for retrieval as a data sink, batch and stream: every item is logged when it is sent.

    spark.dataSource.register(Retrieval)
    sessions.write.format("retrieval").option("log", folder).option("client", "package.module:factory").mode("append").save()

The log is a folder with one small JSON file an item, whose name follows from the item's; it appears whole, right after the item
was sent.  So a task, a batch or a run that is repeated sends what was not logged and nothing else: only the item that was on its
way when it was cut short can be sent twice.  Each run adds its counts to the log's runs when it is complete.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

UPLOADS = "session_name string, file_id string"
RUNS = "run string, sent long, skipped long, error long"


class Client(Protocol):
    """A store that takes one text at a time."""

    def send(self, name: str, text: str) -> str:
        """The id under which the text can be found; OSError or ValueError where it is not taken."""


class LocalClient:
    """Gives ids by content and sends nothing: the local stand-in, and what tests use."""

    def __init__(self, options: dict):
        pass

    def send(self, name: str, text: str) -> str:
        return hashlib.sha256(f"{name}\n{text}".encode()).hexdigest()


class ItemLog:
    """The log's files: items/<two digits>/<digest of the name>.json and runs/<run>.json."""

    def __init__(self, folder: str):
        if folder.startswith("file:"):
            folder = "/" + folder[5:].lstrip("/")
        self.store, self.root = pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder else (pyarrow.fs.LocalFileSystem(), folder)

    def _item(self, name: str) -> str:
        digest = hashlib.sha256(name.encode()).hexdigest()
        return f"{self.root}/items/{digest[:2]}/{digest}.json"

    def holds(self, name: str) -> bool:
        return self.store.get_file_info(self._item(name)).type == pyarrow.fs.FileType.File

    def _put(self, path: str, record: dict) -> None:
        folder, _, name = path.rpartition("/")
        self.store.create_dir(folder, recursive=True)
        own = f"{folder}/.{name}-{uuid.uuid4().hex}"
        with self.store.open_output_stream(own) as out:
            out.write(json.dumps(record, ensure_ascii=False).encode())
        self.store.move(own, path)

    def add(self, name: str, file_id: str) -> None:
        self._put(self._item(name), {"session_name": name, "file_id": file_id})

    def run(self, name: str, counts: dict) -> None:
        self._put(f"{self.root}/runs/{name}.json", {"run": name, **counts})


@dataclass
class Sent(WriterCommitMessage):
    """What a task did."""

    sent: int
    skipped: int
    error: int


class _Sender:
    """The part that both writers share.  A null name or text is an error and is not sent; errors of the client are counted where
    option on_error is `count`, and end the task otherwise."""

    def __init__(self, options: dict):
        if "log" not in options:
            raise ValueError("option log is needed")
        self.options = options
        self.pause = float(options.get("pause", 0))

    def write(self, iterator: Iterator) -> Sent:
        log = ItemLog(self.options["log"])
        module, _, factory = self.options.get("client", f"{__name__}:LocalClient").partition(":")
        client: Client = getattr(importlib.import_module(module), factory)(self.options)
        sent = skipped = error = 0
        for row in iterator:
            if row.session_name is None or row.text is None:
                error += 1
                continue
            if log.holds(row.session_name):
                skipped += 1
                continue
            try:
                file_id = client.send(row.session_name, row.text)
            except (OSError, ValueError):
                if self.options.get("on_error") != "count":
                    raise
                error += 1
                continue
            log.add(row.session_name, file_id)
            sent += 1
            time.sleep(self.pause)
        return Sent(sent, skipped, error)

    def finish(self, messages: list[Sent | None], run: str) -> None:
        counts = {k: sum(getattr(m, k) for m in messages if m is not None) for k in ("sent", "skipped", "error")}
        ItemLog(self.options["log"]).run(run, counts)


class _Writer(_Sender, DataSourceWriter):
    def commit(self, messages) -> None:
        self.finish(messages, self.options.get("run") or uuid.uuid4().hex)

    def abort(self, messages) -> None:
        """What was sent stays logged."""


class _StreamWriter(_Sender, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        self.finish(messages, f"{self.options.get('run', 'batch')}-{batchId}")

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        """What was sent stays logged."""


class Retrieval(DataSource):
    """Rows (session_name, text).  Options: log (folder), client ("package.module:factory", called with the options), pause (seconds
    after each item), on_error (`count`), run (a name for the run's counts)."""

    @classmethod
    def name(cls) -> str:
        return "retrieval"

    def schema(self) -> str:
        return "session_name string, text string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer({k.lower(): v for k, v in self.options.items()})

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:  # noqa: N802
        return _StreamWriter({k.lower(): v for k, v in self.options.items()})


def sent_items(spark: SparkSession, log: str) -> DataFrame:
    """session_name and file_id of what the log holds; empty where there is no log."""
    return _records(spark, f"{log}/items/*", log, UPLOADS)


def run_stats(spark: SparkSession, log: str) -> DataFrame:
    """run, sent, skipped, error of the complete runs."""
    return _records(spark, f"{log}/runs", log, RUNS)


def _records(spark: SparkSession, path: str, log: str, schema: str) -> DataFrame:
    held = ItemLog(log)
    if held.store.get_file_info(f"{held.root}/{path.removeprefix(log).split('/')[1]}").type != pyarrow.fs.FileType.Directory:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)
