"""The nearest texts against scores of all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kaigi.operators import retrieval, tfidf
from kaigi.plans import catalogue
from kaigi.staging import settled


def plain(weights, queries, k):
    docs, out = {}, []
    for e, t, w in weights:
        docs.setdefault(e, {})[t] = w
    asked = {}
    for q, t, w in queries:
        asked.setdefault(q, {})[t] = w
    for q, terms in asked.items():
        scores = sorted(((-round(sum(w * d.get(t, 0.0) for t, w in terms.items()), 10), e) for e, d in docs.items()))
        out += [(q, i + 1, e, -s) for i, (s, e) in enumerate(scores[:k]) if s < 0]
    return sorted(out)


def made(r, n, terms, of):
    out = []
    for i in range(n):
        own = {int(r.paretovariate(0.7)) % terms: r.random() for _ in range(r.randrange(0, of))}
        norm = math.sqrt(sum(w * w for w in own.values())) or 1
        out += [(i, f"t{t}", w / norm) for t, w in own.items()]
    return out


@pytest.mark.parametrize("seed,k,first", [(1, 5, 3), (2, 1, 1), (3, 50, 2)])
def test_nearest(spark, seed, k, first):
    r = random.Random(seed)
    weights, queries = made(r, 300, 80, 25), made(r, 25, 90, 12)
    weights += [(1000 + i, t, w) for i in range(4) for e, t, w in weights if e == 7]  # equal texts: ties go by entity
    w = settled(spark.createDataFrame(weights, "e int, term string, weight double"))
    q = settled(spark.createDataFrame(queries, "q int, term string, weight double"))
    found = retrieval.nearest(w, q, k, "e", "q", first).collect()
    assert sorted((x.q, x.rank, x.e, round(x.score, 10)) for x in found) == [(a, b, c, pytest.approx(d, abs=1e-9)) for a, b, c, d in plain(weights, queries, k)]


def test_nothing_in_common_and_nothing_at_all(spark):
    w = spark.createDataFrame([(1, "a", 1.0)], "e int, term string, weight double")
    q = spark.createDataFrame([(1, "b", 1.0)], "q int, term string, weight double")
    assert retrieval.nearest(w, q, 3, "e", "q").collect() == []
    assert retrieval.nearest(w.where("false"), q, 3, "e", "q").collect() == [] and retrieval.nearest(w, q.where("false"), 3, "e", "q").collect() == []


def test_frequent_terms_find_no_candidates(spark):
    """A term that every text has: texts that share only it with a query are never scored."""
    weights = [(i, t, w) for i in range(2000) for t, w in (("the", 0.1), (f"r{i // 20}", 0.99))]
    w = settled(spark.createDataFrame(weights, "e int, term string, weight double"))
    q = settled(spark.createDataFrame([(j, t, x) for j in range(50) for t, x in (("the", 0.2), (f"r{j}", 0.98))], "q int, term string, weight double"))
    seen = []
    before = retrieval.settled
    retrieval.settled = lambda df: seen.append(before(df)) or seen[-1]
    try:
        found = retrieval.nearest(w, q, 10, "e", "q").agg(F.count(F.lit(1))).first()[0]
    finally:
        retrieval.settled = before
    assert found == 500 and max(x.count() for x in seen) <= 50 * 20


@pytest.mark.parametrize("few_products,short,sent", [(1e9, 50_000, 500_000), (1e9, 3, 0), (0, 3, 500_000), (0, 50_000, 0)])
def test_search_by_either_way(spark, monkeypatch, few_products, short, sent):
    """All products in one pass or bounds, short lists or joins by term: each gives the scores of all pairs, also for a text
    without an id and one that is in two rows."""
    for name, value in (("FEW_PRODUCTS", few_products), ("SHORT_LIST", short), ("SENT_ROWS", sent)):
        monkeypatch.setattr(retrieval, name, value)
    r = random.Random(5)
    word = lambda: f"t{int(r.paretovariate(0.6)) % 90}"
    rows = [(None if i == 7 else i - i % 40 // 39, " ".join(word() for _ in range(r.randrange(0, 30)))) for i in range(200)]
    asked = [(q, " ".join(word() for _ in range(r.randrange(1, 9)))) for q in range(20)] + [(99, "nowhere")]
    texts = {}
    for e, t in rows:
        texts.setdefault(e, []).extend(t.split())
    n, df = len(texts), {}
    for t in texts.values():
        for w in set(t):
            df[w] = df.get(w, 0) + 1

    def weights(words):
        raw = {w: words.count(w) * (math.log((1 + n) / (1 + df[w])) + 1) for w in words if w in df}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items()}

    docs, expected = {e: weights(t) for e, t in texts.items()}, []
    for q, t in asked:
        scores = sorted((-round(sum(x * d.get(w, 0.0) for w, x in weights(t.split()).items()), 10), -1 if e is None else e) for e, d in docs.items())
        expected += [(q, i + 1, e, -s) for i, (s, e) in enumerate(scores[:5]) if s < 0]
    split = lambda found, key: found.select(key, F.explode(F.split("text", " ")).alias("term")).where("term <> ''")
    counts = settled(tfidf.term_counts(split(tfidf.by_entity(spark.createDataFrame(rows, "e long, text string"), "e", "text"), "e"), "e"))
    frequency = settled(tfidf.document_frequency(counts).select("term", "df"))
    queries = settled(retrieval.query_weights(tfidf.term_counts(split(spark.createDataFrame(asked, "q long, text string"), "q"), "q"), frequency, n, "q"))
    found = retrieval.search(counts, frequency, n, queries, 5, "e", "q").collect()
    assert sorted((x.q, x.rank, -1 if x.e is None else x.e, x.score) for x in found) == [(a, b, c, pytest.approx(d, abs=1e-9)) for a, b, c, d in sorted(expected)]


def test_postings_are_not_sent_by_term(spark):
    """A frequent term's postings would all meet in one task."""
    plan = catalogue.queries()["retrieval_top10"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan and "hashpartitioning(_e" not in plan
