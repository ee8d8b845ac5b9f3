"""The meeting service as a data source: batch and stream, read in ranges of pages, with conditions sent to the service.

    enable(spark)
    spark.read.format("meeting_api").option("base", "https://host/api").load().where("session = 213 and date >= '2024-01-01'")

Conditions come from options and from filters of the plan, for which enable() turns on Spark's pushdown into Python sources.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..staging import settled

PAGE = 100
#: Conditions: options and the names the service knows them by.
CONDITIONS = {"session": "session", "house": "nameOfHouse", "meeting": "nameOfMeeting", "from": "from", "until": "until", "speaker": "speaker", "any": "any"}
SCHEMA = "issueID string, session int, nameOfHouse string, nameOfMeeting string, date string, record string"
PAGES = SCHEMA + ", page int, failed boolean"


def get_bytes(url: str, timeout: float = 30) -> tuple[bytes, str | None]:
    """What the address holds, and the character set that the answer names.  Failures are OSError."""
    with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310
        return answer.read(), answer.headers.get_content_charset()


def get_json(url: str, query: dict, timeout: float = 30) -> dict:
    """A JSON answer; failures are OSError, other content ValueError."""
    return json.loads(get_bytes(f"{url}?{urllib.parse.urlencode(query)}", timeout)[0])


@dataclass(frozen=True)
class Pages(InputPartition):
    """Records from `start` (counted from 1) up to `stop`, or all there are from there where stop is 0.  share: the tasks that share
    the service."""

    start: int
    stop: int = 0
    share: int = 1


class Service:
    """Pages of meetings under conditions."""

    def __init__(self, options: dict):
        self.options = options
        self.query = {send: options[k] for k, send in CONDITIONS.items() if options.get(k) and not (k == "session" and options[k] == "0")}
        if "fetch" not in options and "base" not in options:
            raise ValueError("option base or fetch is needed")

    def page(self, at: int, size: int = PAGE) -> dict:
        if not self.query:
            raise ValueError("a search condition is needed")
        query = {**self.query, "maximumRecords": size, "startRecord": at, "recordPacking": "json"}
        if "fetch" in self.options:
            module, _, function = self.options["fetch"].partition(":")
            return getattr(importlib.import_module(module), function)(query)
        return get_json(f"{self.options['base'].rstrip('/')}/meeting_list", query)

    def total(self) -> int:
        return int(self.page(1, 1).get("numberOfRecords", 0))

    def rest(self, share: int) -> None:
        """The pause after a page; it holds for the service as a whole, so each of several tasks waits as many times longer."""
        time.sleep(float(self.options.get("pause", 0.5)) * share)

    def read(self, part: Pages) -> Iterator[tuple[int, dict | None]]:
        """(number of the page, record) of the part; (number, None) for a page that fails, which ends the part."""
        at, seen = part.start, part.start - 1
        while at and not (part.stop and at >= part.stop):
            number = (at - 1) // PAGE
            try:
                page = self.page(at, min(PAGE, part.stop - at) if part.stop else PAGE)
            except (OSError, ValueError):
                if not self.query:
                    raise
                yield number, None
                return
            for record in page.get("meetingRecord", []):
                seen += 1
                yield number, record
            at = int(page.get("nextRecordPosition") or 0)
            if not at or seen >= int(page.get("numberOfRecords", 0)):
                return
            self.rest(part.share)


def enable(spark: SparkSession) -> None:
    """Makes the format meeting_api known to the session, and lets filters reach it."""
    spark.dataSource.register(MeetingApi)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def columns(record: dict) -> tuple:
    number = str(record.get("session", ""))
    return record.get("issueID"), int(number) if number.isascii() and number.isdigit() else None, record.get("nameOfHouse"), record.get("nameOfMeeting"), record.get("date"), json.dumps(record, ensure_ascii=False)


class MeetingApi(DataSource):
    """Meeting lists.  Pages come from base/meeting_list, or from option fetch, "package.module:function", a function that takes the
    query as a dict and returns one page as a dict with meetingRecord, numberOfRecords and nextRecordPosition.

    Options: session, house, meeting, from, until, speaker, any (one condition at least, or a filter; empty ones and session 0 are
    not sent), pause (seconds), partitions (1: page after page, and what came before a page that fails is all there is; more: so
    many ranges of pages at once, see listed_meetings for the same rule over them), pages (true: further columns `page` and
    `failed`, a row without a record for each page that fails), pushdown (false: filters stay in Spark, for sessions where
    spark.sql.python.filterPushdown.enabled is off)."""

    @classmethod
    def name(cls) -> str:
        return "meeting_api"

    def schema(self) -> str:
        return PAGES if self._options().get("pages") == "true" else SCHEMA

    def _options(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> DataSourceReader:
        options = self._options()
        return MeetingReader(options) if options.get("pushdown") == "false" else FilteredReader(options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return MeetingStream(self._options())


class MeetingReader(DataSourceReader):
    """Ranges of pages, one task each."""

    def __init__(self, options: dict):
        self.service = Service(options)
        self.parts, self.pages = int(options.get("partitions", 1)), options.get("pages") == "true"

    def partitions(self) -> list[InputPartition]:
        if not self.service.query:
            raise ValueError("a search condition is needed")
        if self.parts < 2:
            return [Pages(1)]
        pages = -(-self.service.total() // PAGE)
        parts = max(1, min(self.parts, pages))
        bounds = [1 + PAGE * (pages * i // parts) for i in range(parts)]
        # The last range is open, for what has been added since.
        return [Pages(a, b, parts) for a, b in zip(bounds, [*bounds[1:], 0], strict=True)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for number, record in self.service.read(partition):
            if self.pages:
                yield (*(columns(record) if record is not None else [None] * 6), number, record is None)
            elif record is not None:
                yield columns(record)


class FilteredReader(MeetingReader):
    """Conditions that are filters of the plan go to the service.  The session is exact there; names may be understood more widely
    and days without a month are texts like any other, so Spark looks at all others again."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        query = self.service.query
        names = {("nameOfHouse",): "nameOfHouse", ("nameOfMeeting",): "nameOfMeeting"}
        for f in filters:
            match f:
                case EqualTo(("session",), int(n)) if n > 0 and query.get("session", str(n)) == str(n):
                    query["session"] = str(n)
                case EqualTo(column, str(value)) if column in names and value and names[column] not in query:
                    query[names[column]] = value
                    yield f
                case EqualTo(("date",), str(day)):
                    self._narrow("from", day, max)
                    self._narrow("until", day, min)
                    yield f
                case GreaterThanOrEqual(("date",), str(day)) | GreaterThan(("date",), str(day)):
                    self._narrow("from", day, max)
                    yield f
                case LessThanOrEqual(("date",), str(day)) | LessThan(("date",), str(day)):
                    self._narrow("until", day, min)
                    yield f
                case _:
                    yield f

    def _narrow(self, bound: str, day: str, tighter) -> None:
        """Days as YYYY-MM-DD only: other texts have an order of their own."""
        if len(day) == 10 and day[4] == day[7] == "-" and (day[:4] + day[5:7] + day[8:]).isdigit():
            self.service.query[bound] = tighter(self.service.query.get(bound, day), day)


class MeetingStream(DataSourceStreamReader):
    """Records from the position that the last batch reached: what the service lists later gets higher positions.  A page that fails
    fails its batch, which is read again."""

    def __init__(self, options: dict):
        self.service = Service(options)
        self.parts = int(options.get("partitions", 1))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"records": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"records": self.service.total()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first, n = start["records"], end["records"] - start["records"]
        parts = max(1, min(self.parts, -(-n // PAGE)))
        bounds = [1 + first + n * i // parts for i in range(parts + 1)]
        return [Pages(a, b, parts) for a, b in zip(bounds, bounds[1:], strict=False) if b > a]

    def read(self, partition: Pages) -> Iterator[tuple]:
        n = 0
        for _, record in self.service.read(partition):
            if record is None:
                raise OSError(f"the page at record {partition.start + n} can't be read")
            n += 1
            yield columns(record)


def listed_meetings(spark: SparkSession, options: dict[str, str], partitions: int = 8) -> DataFrame:
    """The listed meetings under the conditions in options, several ranges of pages at once, in the checkpoint folder.  A page that
    fails ends the list: what comes after it counts for nothing, whichever task has read it."""
    enable(spark)
    read = settled(spark.read.format("meeting_api").options(**options).option("partitions", str(partitions)).option("pages", "true").load())
    failed = read.where("failed").agg(F.min("page")).first()[0]
    found = read.where("not failed")
    return (found if failed is None else found.where(F.col("page") < failed)).drop("page", "failed")
