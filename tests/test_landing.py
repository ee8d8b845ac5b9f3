"""The landed table: merges against a dict, files of untouched days, failures, and enrichment in place."""

import os
import random

import pytest
from pyspark.sql import functions as F

from kaigi.plans import catalogue, pipelines
from kaigi.sources import landing, readers, sinks

SF = "/root/testdata/sf0.001"
SCHEMA = "id string, date string, n int, items array<struct<x:string>>"


def table(spark, path):
    return {r.id: (r.date, r.n, [i.x for i in r["items"]] if r["items"] is not None else None) for r in landing.landed(spark, path).collect()}


def files(path):
    return {os.path.join(d, f).removeprefix(path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merges_equal_a_dict(spark, tmp_path):
    r, path, expected = random.Random(7), str(tmp_path / "t"), {}
    for step in range(5):
        rows = [(f"k{r.randrange(40)}", r.choice([None, "", "2024-01-01", "2024-01-02", "2024-02-01"]), r.randrange(3), r.choice([None, [], [("a",)], [("b",), (None,)]])) for _ in range(30)]
        last = {k: (d, n, None if x is None else [y[0] for y in x]) for k, d, n, x in rows}
        df = spark.createDataFrame([(*x, i) for i, x in enumerate(rows)], SCHEMA + ", at int")
        new, same = sum(k not in expected for k in last), sum(expected.get(k) == v for k, v in last.items())
        done = landing.merge(df.select("id", "date", "n", "items", "at").transform(lambda d: d.groupBy("id").agg(F.max_by(F.struct("date", "n", "items"), "at").alias("r")).select("id", "r.*")), path, "id", "date", moves=True)
        expected |= last
        assert table(spark, path) == expected
        assert (done.inserted, done.unchanged, done.updated) == (new, same, len(last) - new - same)
        again = landing.merge(landing.landed(spark, path).drop(landing.DAY), path, "id", "date")
        assert (again.inserted, again.updated, again.rewritten) == (0, 0, ())


def test_untouched_days_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"k{i}", f"2024-01-{1 + i % 5:02d}", i, None) for i in range(50)]
    assert landing.land(spark.createDataFrame(rows, SCHEMA), path, "id", "date").inserted == 50
    before = files(path)
    changed = [("k1", "2024-01-02", -1, [("new",)]), ("k6", "2024-01-02", 6, None), ("k90", "2024-01-04", 9, None), (None, "2024-01-01", 1, None)]
    done = landing.merge(spark.createDataFrame(changed, SCHEMA), path, "id", "date")
    assert done == landing.Landing(1, 1, 1, 1, ("2024-01-02",))
    after = files(path)
    assert {f for f in before if "2024-01-02" not in f} <= after and not {f for f in before if "2024-01-02" in f} & after
    # a key that lands under another day leaves the old one, which goes when it was the only one
    landing.merge(spark.createDataFrame([("k90", "2024-03-01", 9, None)], SCHEMA), path, "id", "date", moves=True)
    assert table(spark, path)["k90"] == ("2024-03-01", 9, None) and len(table(spark, path)) == 51
    landing.merge(spark.createDataFrame([("k90", "2024-03-02", 9, None)], SCHEMA), path, "id", "date", moves=True)
    assert not os.path.exists(f"{path}/{landing.DAY}=2024-03-01")
    # landing again changes nothing
    assert landing.land(spark.createDataFrame(rows + changed[:3], SCHEMA), path, "id", "date") == landing.Landing(0, 0, 51, 0, ())


def test_the_last_by_order_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    landing.merge(spark.createDataFrame([("a", "2024-01-01", n, None) for n in (3, 1, 2)], SCHEMA), path, "id", "date", order=-F.col("n"))
    assert table(spark, path)["a"][1] == 1
    assert landing.merge(spark.createDataFrame([], SCHEMA), path, "id", "date") == landing.Landing()


def test_a_failure_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    landing.land(spark.createDataFrame([("a", "2024-01-01", 1, None), ("b", "2024-01-02", 2, None)], SCHEMA), path, "id", "date")
    before, held = files(path), table(spark, path)
    bad = spark.createDataFrame([("a", "2024-01-01", 5, None), ("b", "2024-01-02", 0, None)], SCHEMA).withColumn("n", F.expr("case when id = 'b' then int(raise_error('lost')) else n end"))
    with pytest.raises(Exception, match="lost"):
        landing.merge(bad, path, "id", "date")
    assert files(path) == before and table(spark, path) == held


def test_enrichment_in_place(spark, tmp_path):
    path = str(tmp_path / "meetings")
    listed = readers.parsed_meetings(spark.createDataFrame([(f'{{"issueID": "{i}", "date": "2024-01-0{1 + i % 3}", "nameOfHouse": "h"}}',) for i in range(9)], "record string"))
    assert sinks.land_meetings(listed, path).inserted == 9
    fetch = lambda issue: None if issue == "4" else {"issueID": issue, "date": f"2024-01-0{1 + int(issue) % 3}", "nameOfHouse": "h", "speechRecord": [{"speaker": "甲", "speech": f"s{issue}"}]}
    assert pipelines.enrich_landed(spark, path, fetch, 0) == {"targets": 9, "ok": 8, "error": 1}
    assert pipelines.enrich_landed(spark, path, fetch, 0) == {"targets": 1, "ok": 0, "error": 1}
    found = {r.issueID: r for r in landing.landed(spark, path).collect()}
    assert len(found) == 9 and all((r.speechRecord is None) == (i == "4") for i, r in found.items())
    assert found["5"].speechRecord[0].speech == "s5" and found["5"].file_name == "20240103_h___5.json"


def test_query(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").collect()
    changed = {r.ts.date().isoformat() for r in events if r.event_type in ("error", "purchase") and r.props is not None}
    expected = sorted((r.event_id, r.ts.date().isoformat(), r.event_type, r.props if r.event_type in ("error", "purchase") else None, r.ts.date().isoformat() in changed) for r in events)
    assert sorted(map(tuple, catalogue.queries()["landed_merge"](spark, SF).collect())) == expected
