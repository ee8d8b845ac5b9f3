import pytest

from kaigi.plans import catalogue
from tests.compare import same_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    same_rows(spark, catalogue.queries()[name], catalogue.oracle_sql()[name], SF)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_sql_but_one_that_writes():
    assert set(catalogue.queries()) - set(catalogue.oracle_sql()) == {"landed_merge"}


@pytest.mark.parametrize("name", ["session_tfidf_top30", "utterance_segments", "category_scores"])
def test_plans_have_no_cartesian_product(spark, name):
    plan = catalogue.queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan


def test_sessions_are_weighed_where_their_texts_are(spark, monkeypatch):
    """Texts are sent by session; their counts and weights stay there."""
    monkeypatch.setattr(catalogue.tfidf, "PART_BYTES", 1 << 16)
    plan = catalogue.queries()["session_tfidf_top30"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    sent = [x for x in plan.splitlines() if "Exchange hashpartitioning(doc_id" in x]
    assert sent and all("REPARTITION_BY_NUM" in x for x in sent)


def test_first_session_alone_is_weighed(spark):
    plan = catalogue.queries()["first_session_terms"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id" in plan


def test_texts_of_one_session_are_counted_together(spark, tmp_path):
    docs = [(1, "aa bb aa"), (1, "aa cc"), (2, "bb cc"), (None, "aa bb"), (None, "bb"), (3, None), (4, "")]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = {(r.doc_id, r.term): r.tf for r in catalogue.queries()["session_term_counts"](spark, str(tmp_path)).collect()}
    assert found == {(1, "aa"): 3, (1, "bb"): 1, (1, "cc"): 1, (2, "bb"): 1, (2, "cc"): 1, (None, "aa"): 1, (None, "bb"): 2}


def test_settled_rows_go_with_their_last_reference(spark):
    import gc
    import os
    import time

    from kaigi.staging import checkpoint_dir, settled

    folder = checkpoint_dir(spark).removeprefix("file:")
    held = settled(spark.range(1000))
    part = max((x for x in os.listdir(folder) if x.startswith("rdd-")), key=lambda x: int(x[4:]))
    assert settled(held.groupBy().count()).first()[0] == 1000
    del held
    for _ in range(20):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
        if not os.path.exists(f"{folder}/{part}"):
            return
    raise AssertionError("still there")
