"""The meeting service as a source and retrieval as a sink, against a stub that remembers what it was asked."""

import json
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from kaigi.sources import landing, meeting_api, retrieval
from kaigi.streaming import incremental as streams


class Meetings(BaseHTTPRequestHandler):
    """Meetings 1 to `total`: session 213 or 214, three houses, days of January; understands its conditions."""

    def do_GET(self):
        query = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query).items()}
        own = self.server
        own.asked.append(query)
        every = [{"issueID": str(i), "session": 213 + i % 2, "nameOfHouse": f"house {i % 3}", "nameOfMeeting": f"m{i % 5}", "date": f"2024-01-{1 + i % 28:02d}"} for i in range(1, own.total + 1)]
        match = lambda m: (
            query.get("session", str(m["session"])) == str(m["session"]) and query.get("nameOfHouse", "") in m["nameOfHouse"] and query.get("nameOfMeeting", "") in m["nameOfMeeting"]
            and query.get("from", "") <= m["date"] <= query.get("until", "9")
        )
        found = [m for m in every if match(m)]
        at, size = int(query["startRecord"]), int(query["maximumRecords"])
        if any(at <= bad < at + size for bad in own.bad) and size > 1:
            self.send_error(500)
            return
        body = json.dumps({"numberOfRecords": len(found), "nextRecordPosition": at + size if at + size <= len(found) else None, "meetingRecord": found[at - 1 : at - 1 + size]}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def service():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Meetings)
    server.total, server.bad, server.asked = 730, set(), []
    server.url = f"http://127.0.0.1:{server.server_port}/api"
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield server
    server.shutdown()


FILTERS = (
    "session = 213", "nameOfHouse = 'house 1'", "nameOfMeeting = 'm1' and session = 214", "date >= '2024-01-10' and date <= '2024-01-12'", "date > '2024-01-10' and date < '2024-01-12'", "date = '2024-01-05'",
    "date >= '2024-01-10' and date >= '2024-01-20'", "session = 213 and nameOfHouse = 'house'", "date >= '2024' and session = 213", "session = 213 and nameOfHouse is null", "session = 213 and issueID like '1%'",
)


@pytest.mark.parametrize("condition", FILTERS)
def test_filters_go_to_the_service(spark, service, condition):
    meeting_api.enable(spark)
    read = spark.read.format("meeting_api").option("base", service.url).option("pause", "0")
    found = sorted(r.issueID for r in read.load().where(condition).collect())
    sent = [q for q in service.asked if int(q["maximumRecords"]) > 1]
    assert sent and all(q.keys() & {"session", "nameOfHouse", "nameOfMeeting", "from", "until"} for q in sent)
    whole = read.option("from", "2024-01-01").load().select("issueID", "session", "nameOfHouse", "nameOfMeeting", "date").collect()
    assert found == sorted(r.issueID for r in spark.createDataFrame(whole).where(condition).collect()) and len(whole) == 730


def test_conditions_that_are_sent(spark, service):
    meeting_api.enable(spark)
    read = spark.read.format("meeting_api").option("base", service.url).option("pause", "0").option("until", "2024-01-20").load()
    assert read.where("session = 213 and date >= '2024-01-10' and date <= '2024-01-28' and nameOfMeeting = 'm2'").count() > 0
    query = service.asked[-1]
    assert (query["session"], query["from"], query["until"], query["nameOfMeeting"]) == ("213", "2024-01-10", "2024-01-20", "m2")


def test_sessions_without_pushdown(spark, service):
    meeting_api.enable(spark)
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    read = spark.read.format("meeting_api").options(base=service.url, pushdown="false", pause="0", session="213").load()
    assert read.where("date = '2024-01-05'").count() == 26 and "from" not in service.asked[-1]


def test_a_condition_is_needed(spark, service):
    meeting_api.enable(spark)
    read = spark.read.format("meeting_api").option("base", service.url).option("session", "0")
    with pytest.raises(Exception, match="search condition"):
        read.load().count()
    with pytest.raises(Exception, match="base or fetch"):
        spark.read.format("meeting_api").option("session", "213").load().count()


@pytest.mark.parametrize("partitions", [1, 3, 20])
def test_ranges_of_pages(spark, service, partitions):
    options = {"base": service.url, "from": "2024-01-01", "pause": "0"}
    found = meeting_api.listed_meetings(spark, options, partitions)
    assert sorted(int(r.issueID) for r in found.collect()) == list(range(1, 731))
    starts = [int(q["startRecord"]) for q in service.asked if q["maximumRecords"] == "100"]
    assert sorted(starts) == [1 + 100 * i for i in range(8)]
    # what comes before the page that fails is all there is, whichever task reads what comes after it
    service.bad = {250, 610}
    found = meeting_api.listed_meetings(spark, options, partitions)
    assert sorted(int(r.issueID) for r in found.collect()) == list(range(1, 201))
    service.bad = {1}
    assert meeting_api.listed_meetings(spark, options, partitions).count() == 0
    service.bad, service.total = set(), 0
    assert meeting_api.listed_meetings(spark, options, partitions).count() == 0


def test_several_tasks_read(spark, service):
    meeting_api.enable(spark)
    read = spark.read.format("meeting_api").options(base=service.url, session="213", pause="0", partitions="4").load()
    assert read.select(F.spark_partition_id()).distinct().count() == 4


def test_the_stream_goes_on_where_it_stopped(spark, service, tmp_path):
    options, table, checkpoint = {"base": service.url, "from": "2024-01-01", "pause": "0", "partitions": "3"}, str(tmp_path / "t"), str(tmp_path / "ck")
    service.total = 250
    for total in (250, 250, 420):
        service.total, service.asked = total, []
        streams.land_stream(streams.listed_stream(spark, options), table, checkpoint).awaitTermination(120)
        assert sorted(int(r.issueID) for r in landing.landed(spark, table).collect()) == list(range(1, total + 1))
    read = [int(q["startRecord"]) for q in service.asked if q["maximumRecords"] != "1"]
    assert min(read) == 251
    # a page that fails fails its batch, and the next run reads it again
    service.total, service.bad = 600, {580}
    query = streams.land_stream(streams.listed_stream(spark, options), table, checkpoint)
    with pytest.raises(Exception, match="read"):
        query.awaitTermination(120)
    service.bad = set()
    streams.land_stream(streams.listed_stream(spark, options), table, checkpoint).awaitTermination(120)
    found = landing.landed(spark, table)
    assert found.count() == 600 == found.select("issueID").distinct().count()


class Fragile:
    """Counts what it is sent in a folder, and fails once at a name."""

    def __init__(self, options):
        self.folder, self.bad = options["folder"], options.get("bad")

    def send(self, name, text):
        import os
        import uuid

        if name == self.bad and not os.path.exists(f"{self.folder}/failed"):
            open(f"{self.folder}/failed", "w").close()
            raise OSError(name)
        open(f"{self.folder}/{name}-{uuid.uuid4().hex}", "w").close()
        return f"id of {name}: {len(text)}"


def test_what_was_sent_is_not_sent_again(spark, tmp_path):
    (tmp_path / "sent").mkdir()
    log, options = str(tmp_path / "log"), {"client": "tests.test_services:Fragile", "folder": str(tmp_path / "sent"), "bad": "s17"}
    sessions = spark.createDataFrame([(f"s{i}", "x" * i) for i in range(30)], "session_name string, text string")
    with pytest.raises(Exception, match="s17"):
        streams.send_items(sessions, log, tasks=3, **options)
    first = {r.session_name for r in retrieval.sent_items(spark, log).collect()}
    assert "s17" not in first and retrieval.run_stats(spark, log).count() == 0
    for _ in range(2):
        streams.send_items(sessions, log, tasks=3, run="again", **options)
    names = [p.name.split("-")[0] for p in (tmp_path / "sent").iterdir() if p.name != "failed"]
    assert sorted(names) == sorted(f"s{i}" for i in range(30))
    assert {r.session_name: r.file_id for r in retrieval.sent_items(spark, log).collect()} == {f"s{i}": f"id of s{i}: {i}" for i in range(30)}
    assert [tuple(r) for r in retrieval.run_stats(spark, log).collect()] == [("again", 0, 0, 0)]


def test_errors_and_repeated_names_are_counted(spark, tmp_path):
    (tmp_path / "sent").mkdir()
    spark.dataSource.register(retrieval.Retrieval)
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), (None, "x"), ("b", None), ("c", "3"), ("会議?", "4")], "session_name string, text string").coalesce(1)
    write = lambda name: rows.write.format("retrieval").options(log=str(tmp_path / "log"), client="tests.test_services:Fragile", folder=str(tmp_path / "sent"), bad="c", on_error="count", run=name).mode("append").save()
    assert retrieval.sent_items(spark, str(tmp_path / "log")).count() == 0
    write("one")
    write("two")
    assert {tuple(r) for r in retrieval.run_stats(spark, str(tmp_path / "log")).collect()} == {("one", 2, 1, 3), ("two", 1, 3, 2)}
    with pytest.raises(Exception, match="option log"):
        rows.write.format("retrieval").mode("append").save()


def test_a_stream_that_is_cut_short(spark, tmp_path):
    (tmp_path / "sent").mkdir()
    log, options = str(tmp_path / "log"), {"client": "tests.test_services:Fragile", "folder": str(tmp_path / "sent"), "bad": "s5"}
    spark.createDataFrame([(f"s{i}", "x") for i in range(12)], "session_name string, text string").write.parquet(str(tmp_path / "sessions"))
    stream = spark.readStream.schema("session_name string, text string").parquet(str(tmp_path / "sessions"))
    with pytest.raises(Exception, match="s5"):
        streams.send_stream(stream, log, str(tmp_path / "ck"), **options).awaitTermination(120)
    streams.send_stream(stream, log, str(tmp_path / "ck"), **options).awaitTermination(120)
    names = [p.name.split("-")[0] for p in (tmp_path / "sent").iterdir() if p.name != "failed"]
    assert sorted(names) == sorted(f"s{i}" for i in range(12))
