"""Retrieval by weighted terms: the k texts that are nearest to each query, over tables of weights.

Weights of one text have length 1, so the sum of products is the cosine.  A frequent term weighs little and is in nearly every
text; to score every text that shares one with a query would be queries times texts.  So each query first gets a bound: the texts that do best by its
rarest terms are scored with all of them, and the k-th best score is one that the k nearest reach at least.  Terms that together cannot
lift a text to it (by the largest weight that each has anywhere) find no candidates; they only add to the scores of texts that
other terms have found, and of those again only where the bound is still in reach.  The result is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import settled
from .tfidf import SHORT_LIST, smooth_idf

#: Scores within this of each other count as equal in the bounds, as sums differ with their order.
SLACK = 1e-9
#: Texts for each of the k that the terms of a bound are to be found in.
ENOUGH = 20
#: Products of a posting with queries' terms that are made without looking for bounds.
FEW_PRODUCTS = 16
#: Rows of queries' terms, also for each text in question, that go to every task.
SENT_ROWS = 500_000


def query_weights(counts: DataFrame, frequency: DataFrame, n_entities: int, query: str, term: str = "term") -> DataFrame:
    """query, term, weight of queries' term counts (tf) against a corpus' frequencies (df): as tfidf weighs texts, each query's of
    length 1.  Terms that the corpus lacks have none."""
    raw = counts.join(frequency.select(term, "df"), term).withColumn("raw", F.col("tf") * smooth_idf(n_entities))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(query)))
    return raw.select(query, term, (F.col("raw") / norm).alias("weight"))


def text_weights(counts: DataFrame, frequency: DataFrame, n_entities: int, entity: str, queries: DataFrame, term: str = "term") -> DataFrame:
    """entity, term, weight of texts' term counts (tf), as tfidf weighs them with every term, for terms of the queries only.

    counts in parts by entity (tfidf.by_entity), settled; frequency and queries settled too.  Most counts are of frequent terms,
    whose frequencies go to every task; only those of the rest are sent by term."""
    counts, idf = counts.select(entity, term, "tf"), frequency.select(term, "df", smooth_idf(n_entities).alias("idf"))
    raw = F.col("tf") * F.col("idf")
    squares = F.sum(raw * raw).alias("squares")
    frequent = settled(idf.orderBy(F.desc("df"), term).limit(SHORT_LIST).select(term, "idf"))
    near = counts.join(F.broadcast(frequent), term).groupBy(entity).agg(squares)
    far = counts.join(F.broadcast(frequent), term, "left_anti").join(idf, term).groupBy(entity).agg(squares)
    norms = settled(near.unionAll(far).groupBy(entity).agg(F.sqrt(F.sum("squares")).alias("norm")))
    without_id = norms.where(F.col(entity).isNull()).select("norm").scalar()  # which no join finds
    asked = idf.join(queries.select(term).distinct(), term, "left_semi").select(term, "idf")
    found = _sent(counts, settled(asked), term).join(norms, entity, "left")
    return found.select(entity, term, (raw / F.coalesce("norm", without_id)).alias("weight"))


def search(counts: DataFrame, frequency: DataFrame, n_entities: int, queries: DataFrame, k: int, entity: str, query: str, term: str = "term") -> DataFrame:
    """nearest, over texts' term counts and frequencies as text_weights takes them.  Where a posting has few products with queries,
    one pass makes them all, which costs less than what bounds need."""
    weights = text_weights(counts, frequency, n_entities, entity, queries, term)
    asked = queries.groupBy(term).agg(F.count(F.lit(1)).alias("n")).join(frequency, term)
    work = asked.agg(F.sum(F.col("n") * F.col("df")).alias("products"), F.sum("df").alias("postings")).first()
    if (work.products or 0) > FEW_PRODUCTS * (work.postings or 0):
        return nearest(settled(weights), queries, k, entity, query, term=term)
    scores = _sent(weights.withColumnRenamed("weight", "_w"), queries, term).groupBy(query, entity).agg(F.sum(F.col("weight") * F.col("_w")).alias("score"))
    return _best(scores, k, entity, query)


def _best(scores: DataFrame, k: int, entity: str, query: str) -> DataFrame:
    order = Window.partitionBy(query).orderBy(F.desc(F.round("score", 10)), entity)
    return scores.where(F.col("score") > 0).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def _sent(rows: DataFrame, few: DataFrame, on) -> DataFrame:
    """Joined with what belongs to queries: that goes to every task as long as it is small, and the rows stay where they are."""
    return rows.join(F.broadcast(few) if few.count() <= SENT_ROWS else few, on)


def nearest(weights: DataFrame, queries: DataFrame, k: int, entity: str, query: str, first: int = 3, term: str = "term") -> DataFrame:
    """query, entity, score, rank (1 to k): the entities with the highest scores above 0, ties (to 10 places) by entity.

    weights: entity, term, weight; queries: query, term, weight; both settled, none negative.  first: the rarest terms of each
    query that give its bound, or more until ENOUGH * k texts hold them."""
    postings = weights.select(F.col(term).alias("_t"), F.col(entity).alias("_e"), F.col("weight").alias("_w"))
    tops = weights.groupBy(term).agg(F.max("weight").alias("top"), F.count(F.lit(1)).alias("df"))
    by_df = Window.partitionBy(query).orderBy("df", term)
    rarer = F.coalesce(F.sum("df").over(by_df.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    early = (F.row_number().over(by_df) <= first) | (rarer < ENOUGH * k)
    terms = settled(queries.join(tops, term).select(query, term, "weight", (F.col("weight") * F.col("top")).alias("reach"), early.alias("early")))
    product = F.sum(F.col("weight") * F.col("_w"))
    same_term, same = F.col("_t") == F.col(term), (F.col("_t") == F.col(term)) & F.col("_e").eqNullSafe(F.col("_f"))
    # The k-th best score that some texts reach with all terms: those that do best by the early ones.
    guess = _sent(postings, terms.where("early"), same_term).groupBy(query, "_e").agg(product.alias("score"))
    guess = guess.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), "_e"))).where(F.col("rank") <= 2 * k)
    guess = settled(guess.select(query, F.col("_e").alias("_f"))).join(terms, query).select(query, "_f", term, "weight")
    guess = _sent(postings, guess, same).groupBy(query, "_e").agg(product.alias("score"))
    best = guess.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), "_e"))).where(F.col("rank") == k)
    bounds = best.select(query, (F.col("score") - SLACK).alias("bound"))
    upto = F.sum("reach").over(Window.partitionBy(query).orderBy("reach", term).rowsBetween(Window.unboundedPreceding, 0))
    split = settled(terms.join(bounds, query, "left").fillna(0.0, ["bound"]).withColumn("upto", upto).withColumn("finds", F.col("upto") >= F.col("bound")))
    rest = split.groupBy(query).agg(F.sum(F.when(~F.col("finds"), F.col("reach")).otherwise(0.0)).alias("rest"), F.first("bound").alias("bound"))
    found = _sent(postings, split.where("finds"), same_term).groupBy(query, "_e").agg(product.alias("score"))
    found = settled(found.join(rest, query).where(F.col("score") + F.col("rest") >= F.col("bound")).select(query, "_e", "score"))
    # What the other terms add, for candidates only: each meets its query's few terms, and then its own weights.
    others = found.withColumnRenamed("_e", "_f").join(split.where("not finds").select(query, term, "weight"), query)
    more = _sent(postings, others.select(query, "_f", term, "weight"), same).groupBy(query, "_e").agg(product.alias("score"))
    scores = found.unionAll(more).groupBy(query, F.col("_e").alias(entity)).agg(F.sum("score").alias("score"))
    return _best(scores, k, entity, query)
