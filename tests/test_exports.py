"""Exports in ordered parts, features by label, and counters of the same pass."""

import csv
import io
import json
import random

from pyspark.sql import functions as F

from kaigi.plans import pipelines
from kaigi.sources import run_stats, sinks


def whole(folder):
    return "".join((folder / name).read_text() for name in json.loads((folder / "_parts.json").read_text()))


def test_parts_make_up_the_whole_file(spark, tmp_path):
    r = random.Random(2)
    odd = ["a,b", 'say "x"', " edge ", "", "line\nbreak", "日本", "\\n", "'"]
    rows = [(i, r.choice(odd), r.random(), [1, 2, i] if i % 3 else []) for i in range(3000)]
    df = spark.createDataFrame(rows, "n int, name string, x double, terms array<int>").repartition(7)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.ordered_csv(df, str(tmp_path / "c"), F.desc("x"), drop=("n",))
        sinks.ordered_json(df, str(tmp_path / "j"), "n", drop=("x",))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["name", "x", "terms"])
    text = whole(tmp_path / "c")
    assert len(json.loads((tmp_path / "c" / "_parts.json").read_text())) > 50
    read = list(csv.reader(io.StringIO(text)))
    assert read[0] == ["name", "x", "terms"]
    assert [(a, float(b), c) for a, b, c in read[1:]] == [(name, x, ",".join(map(str, t))) for _, name, x, t in sorted(rows, key=lambda v: -v[2])]
    assert [json.loads(x) for x in whole(tmp_path / "j").splitlines()] == [{"n": n, "name": name, "terms": t} for n, name, _, t in sorted(rows)]


def test_features_by_label(spark, tmp_path):
    sessions = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "c"), (5, "c")], "session_seq int, label string")
    ranked = spark.createDataFrame([(1, 1, "old", 0.9, 3, 3), (3, 2, "v", 0.1, 1, 0), (3, 1, "w", 0.12345, 3, 2), (2, 1, "x", 0.5, 1, 1), (4, 1, "gone", 0.5, 1, 1)], "session_seq int, rank int, term string, weight double, tf int, count int")
    sinks.features_json(ranked, sessions, str(tmp_path / "f"))
    found = [json.loads(x) for x in whole(tmp_path / "f").splitlines()]
    assert found == [
        {"label": "b", "items": [{"word": "w", "score": 0.1235, "count": 2}, {"word": "v", "score": 0.1, "count": 0}]}, {"label": "a", "items": [{"word": "x", "score": 0.5, "count": 1}]}, {"label": "c", "items": []},
    ]


def test_counters_of_one_pass(spark, tmp_path):
    folder = tmp_path / "m"
    folder.mkdir()
    for i in range(6):
        (folder / f"2024010{i + 1}_h_m_1_{i}.json").write_text("{broken" if i == 2 else json.dumps({"session": 1, "issueID": str(i), "date": f"2024-01-0{i + 1}", "speechRecord": [{"speaker": "甲", "speech": f"s{i}"}]}))
    runs = [pipelines.format_corpus(spark, str(folder), str(tmp_path / "corpus"), run, str(tmp_path / "stats")) for run in ("first", "second")]
    assert runs == [{"files": 6, "ok": 5, "error": 1}] * 2
    text = "".join(p.read_text() for p in sorted((tmp_path / "corpus").glob("part-*")))
    assert [text.index(f"\ns{i}") for i in (0, 1, 3, 4, 5)] == sorted(text.index(f"\ns{i}") for i in (0, 1, 3, 4, 5))
    saved = spark.read.schema(run_stats.STATS).parquet(str(tmp_path / "stats")).collect()
    assert {(r.run, r.counter, r.value) for r in saved} == {(run, k, v) for run in ("first", "second") for k, v in runs[0].items()}
