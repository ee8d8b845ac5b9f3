"""Time partitions against a plain version, rows at the edges of the calendar, hot moments, and files that stay."""

import calendar
import collections
import datetime as dt
import hashlib
import os
import random
import zlib

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from kaigi.llm import queries, time_partitions
from kaigi.staging import new_folder

SF = "/root/testdata/sf0.001"
SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"


def moment(click_id, ts):
    k = zlib.crc32(str(click_id).encode()) % 128 if click_id is not None else 64
    if ts is None:
        return None
    if k < 16:
        return ts - dt.timedelta(days=(k + 6) ** 3)
    if k > 111:
        day = ts.date() - dt.timedelta(days=ts.weekday())
        return dt.datetime(day.year, day.month, day.day)
    return ts


def children(node):
    """The node's parts in time order; a node is (year[, month[, day[, hour]]])."""
    if len(node) == 1:
        return [(*node, m) for m in range(1, 13)]
    if len(node) == 2:
        return [(*node, d) for d in range(1, calendar.monthrange(*node)[1] + 1)]
    return [(*node, h) for h in range(24)]


def leaves(moments, limit):
    """From the top down: {leaf: moments within}."""
    held = collections.defaultdict(list)
    for m in moments:
        parts = (m.year, m.month, m.day, m.hour)
        for k in range(1, 5):
            held[parts[:k]].append(m)
    out = {}

    def fit(siblings):
        run = []
        for node in [*siblings, None]:
            within = node is not None and len(held[node]) <= limit
            if run and (not within or sum(len(held[x]) for x in run) + len(held[node]) > limit):
                name(run)
                run = []
            if within:
                run.append(node)
            elif node is not None and len(node) == 4:
                name([node])
            elif node is not None:
                fit(children(node))

    def name(run):
        if any(held[x] for x in run):
            label = [f"{v:04d}" if i == 0 else f"{v:02d}" for i, v in enumerate(run[0])]
            last = f"{run[-1][-1]:04d}" if len(run[0]) == 1 else f"{run[-1][-1]:02d}"
            out["/".join([*label[:-1], f"{label[-1]}-{last}"])] = run

    if moments:
        fit([(y,) for y in range(min(moments).year, max(moments).year + 1)])
    return out


def files(rows, limit):
    """{(leaf, part): rows in order} of the rows (click_id, ts, arrived_at, ...)."""
    timed = [(moment(r[0], r[1]), r) for r in rows]
    runs = leaves([m for m, _ in timed if m], limit)
    of = {node: leaf for leaf, run in runs.items() for node in run}
    grouped = collections.defaultdict(list)
    for m, r in timed:
        parts = (m.year, m.month, m.day, m.hour) if m else ()
        leaf = next(of[parts[:k]] for k in range(1, 5) if parts[:k] in of) if m else "null"
        grouped[leaf].append((m, r))
    out = {}
    first = lambda v: (v is not None, v or 0)
    time = lambda v: (v is not None, v or dt.datetime.min)
    for leaf, own in grouped.items():
        own.sort(key=lambda x: (time(x[0]), time(x[1][2]), first(x[1][0])))
        for i in range(0, len(own), limit):
            out[leaf, i // limit + 1] = [r for _, r in own[i : i + limit]]
    return out


def plain(rows, until, limit):
    early = [r for r in rows if r[2] is not None and r[2] < until]
    start = files(early, limit)
    out = []
    for (leaf, part), own in files(rows, limit).items():
        stays = sorted(map(repr, start.get((leaf, part), []))) == sorted(map(repr, own))
        new = sum(not (r[2] is not None and r[2] < until) for r in own)
        out.append((leaf, part, len(own), new, hashlib.sha256(",".join("null" if r[0] is None else str(r[0]) for r in own).encode()).hexdigest(), not stays))
    return sorted(out)


def laid(spark, rows, until, schema=SCHEMA):
    clicks = spark.createDataFrame(rows, schema) if isinstance(rows, list) else rows
    folder = new_folder(spark, "clicks")
    found = queries.partitioned_twice(clicks, until, folder).collect()
    paths = [r.path.removeprefix("file://") for r in found]
    assert sorted(paths) == sorted(os.path.join(d, f) for d, _, names in os.walk(folder.removeprefix("file:")) for f in names if f.endswith(".parquet"))
    for r, path in zip(found, paths, strict=True):
        read = pq.read_table(path, partitioning=None)
        assert ",".join(read.column_names) == r.columns and read.num_rows == r.n_rows
        ids = ["null" if x is None else str(x) for x in read["click_id"].to_pylist()]
        assert hashlib.sha256(",".join(ids).encode()).hexdigest() == r.ids_sha256
    return sorted((r.leaf, r.part, r.n_rows, r.n_new, r.ids_sha256, r.rewritten) for r in found)


def test_clicks_in_two_steps(spark):
    until = "2024-03-10 12:00:00"
    clicks = spark.read.parquet(f"{SF}/clicks.parquet")
    rows = [tuple(r) for r in clicks.collect()]
    found = laid(spark, clicks, until)
    assert found == plain(rows, dt.datetime.fromisoformat(until), 1 + len(rows) // 500)
    assert len(found) > 400 and any(r[1] > 1 for r in found) and any(r[0] == "null" for r in found)
    assert any(r[5] for r in found) and not all(r[5] for r in found)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/clicks.parquet").collect()]
    found = queries.queries()["op11_time_partitions"](spark, SF)
    assert sorted((r.leaf, r.part, r.n_rows, r.n_new, r.ids_sha256, r.rewritten) for r in found.collect()) == plain(rows, dt.datetime(2024, 5, 1), 1 + len(rows) // 500)


def made(n, seed):
    """Rows with repeated and null values; a third at one moment, a third without any."""
    r, out = random.Random(seed), []
    for i in range(n):
        ts = [None, dt.datetime(2024, 2, 29, 7), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=r.randrange(130 * 86400))][r.randrange(3)]
        arrived = None if r.random() < 0.05 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randrange(3200))
        out.append((None if r.random() < 0.02 else r.randrange(n), ts, arrived, r.choice([None, 1]), "k", 0.5, "p"))
    return out + out[: n // 10]


def test_hot_moments_and_nulls(spark):
    rows = made(2000, 1)
    found = laid(spark, rows, "2024-03-01 00:00:00")
    assert found == plain(rows, dt.datetime(2024, 3, 1), 1 + len(rows) // 500)


def test_few_rows_and_none(spark):
    edge = [(i, t, dt.datetime(2024, 6, 1), 1, "k", 1.0, None) for i, t in enumerate([dt.datetime(2023, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 29, 23), dt.datetime(2024, 3, 1), None])]
    for rows in ([], edge[4:], edge * 3):
        assert laid(spark, rows, "2024-05-01 00:00:00") == plain(rows, dt.datetime(2024, 5, 1), 1 + len(rows) // 500)


def test_columns_of_any_name(spark):
    rows = [(*r, "x", 1, 2, "y", 3) for r in made(300, 9)]
    schema = SCHEMA + ", leaf string, part int, number int, row string, tie int"
    assert laid(spark, rows, "2024-03-01 00:00:00", schema) == plain(rows, dt.datetime(2024, 3, 1), 1 + len(rows) // 500)


def test_layout_of_hours(spark):
    """Many small trees, from hours to leaves."""
    r = random.Random(4)
    for limit in (1, 10):
        moments = [dt.datetime(r.choice([1999, 2003, 2004, 2024]), r.choice([1, 2, 12]), r.choice([1, 2, 28]), r.randrange(24)) for _ in range(60)]
        hours = spark.createDataFrame([(m,) for m in moments], "m timestamp_ntz").groupBy(time_partitions.hour_node(F.col("m")).alias("hour")).count().withColumnRenamed("count", "n")
        layout = time_partitions.Layout(hours, limit)
        expected = leaves(moments, limit)
        assert [x.name for x in layout.leaves.orderBy("leaf").collect()] == sorted(expected)
