"""Term statistics in long form: counts, document frequencies, pruned vocabulary, weights and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of text in a part of `by_entity`, so that its counts fit in memory, and the most parts.
PART_BYTES, MOST_PARTS = 4 << 20, 20_000
#: Lists of terms up to this long go to every task.
SHORT_LIST = 50_000


def by_entity(texts: DataFrame, entity: str, text: str) -> DataFrame:
    """texts, each entity's in one part: its terms are counted, weighed and ranked there, so texts are sent once and counts never.
    For entities that are many and small."""
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return texts.repartition(min(1 + size // PART_BYTES, MOST_PARTS), entity)


def term_counts(tokens: DataFrame, entity: str, term: str = "term") -> DataFrame:
    """entity, term, tf and, where tokens tell by `exact` which of them were written as the term is, how many were: `count`."""
    exact = [F.count_if("exact").alias("count")] if "exact" in tokens.columns else []
    return tokens.groupBy(entity, term).agg(F.count(F.lit(1)).alias("tf"), *exact)


def document_frequency(tf: DataFrame, term: str = "term") -> DataFrame:
    """term, df, total_tf; tf has one row for each entity and term."""
    return tf.groupBy(term).agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_tf"))


def vocabulary(df: DataFrame, n_entities: int, min_df: int, max_df: float, max_features: int | None = None, term: str = "term") -> DataFrame:
    """Terms with min_df <= df <= max_df * n_entities, of these the max_features most frequent ones, ties by term."""
    kept = df.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df * n_entities))))
    return kept.orderBy(F.desc("total_tf"), term).limit(max_features) if max_features else kept


def smooth_idf(n_entities: int) -> Column:
    return F.log(F.lit(1.0 + n_entities) / (1 + F.col("df"))) + 1


def tfidf(
    tf: DataFrame, entity: str, n_entities: int, *, min_df: int = 2, max_df: float = 1.0, max_features: int | None = None, sublinear: bool = False, term: str = "term"
) -> DataFrame:
    """entity, term, tf, df, weight (and what else tf has): smooth inverse document frequency, each entity's weights of length 1.

    n_entities counts entities without tokens too.  No term left gives no rows.
    """
    vocab = vocabulary(document_frequency(tf, term), n_entities, min_df, max_df, max_features, term).select(term, "df")
    vocab = F.broadcast(vocab) if max_features and max_features <= SHORT_LIST else vocab
    count = 1 + F.log(F.col("tf")) if sublinear else F.col("tf").cast("double")
    raw = tf.join(vocab, term).withColumn("raw", count * smooth_idf(n_entities))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(entity)))
    rest = [c for c in tf.columns if c not in (entity, term, "tf")]
    return raw.withColumn("weight", F.col("raw") / norm).select(entity, term, "tf", "df", "weight", *rest)


def ranked(weights: DataFrame, entity: str, n: int, term: str = "term") -> DataFrame:
    """weights with rank (1 .. n): by weight, ties (to 10 places) by term."""
    order = Window.partitionBy(entity).orderBy(F.desc(F.round("weight", 10)), term)
    return weights.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def most_used(counts: DataFrame, by: Column, n: int) -> DataFrame:
    return counts.orderBy(F.desc(by)).limit(n)
