"""Mixing sources to target weights (3): hierarchical budgets over a domain - language - source tree.

Budgets go down the tree.  At every node the budget is dealt to the children by weight; a child that can't use its share,
because its leaves hold too few tokens for `max_epochs` epochs, gets what it can use and its siblings share the rest, so a
shortage reaches an ancestor's siblings only when the whole subtree is short.  Tokens that the division leaves over go one each
to the siblings with the largest fractions, ties by name, so every budget is met to the token.  A leaf's budget is filled with whole epochs
and then with a prefix of one more epoch; each epoch deals the leaf's documents in an order seeded anew, and the prefix ends
inside a document if need be.  Only DataFrame functions are used.

The prefix is found digit by digit: sums over the buckets of the order's hash, then over those of the one bucket that the
prefix ends in, and so on, so no task sorts more than some 256 rows of a leaf.  A node's children, one row of sums each, are
put in order in one task.  Tokens are words [^\\x20\\x09-\\x0D]+.  Null and wordless texts hold no tokens and are never taken; null
domains, languages and sources count as the empty string.  Equal rows are taken each for itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exchange import settled, sized
from .quality import words_of

LEVELS = ("domain", "lang", "source")
#: What the query and the pipeline use: weights of domains and languages, share of all tokens, epochs at most, and seed.
WEIGHTS = {"domain": {"d4": 1, "d5": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}}
SHARE, EPOCHS, ORDER_SEED = (6, 10), 3, 17


def domain_of(docs: DataFrame) -> Column:
    """Stands for the domain, which the tables don't have: sources by the length of their name."""
    return F.concat(F.lit("d"), F.length(docs["source"]).cast("string"))


def _named(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def counted(docs: DataFrame, domain: Column) -> DataFrame:
    """doc_id, row (tells rows of one doc_id apart), domain, lang, source, tokens; rows without tokens left out."""
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("row"), _named(domain).alias("domain"), _named(docs["lang"]).alias("lang"), _named(docs["source"]).alias("source"), F.size(words_of(docs["text"])).cast("long").alias("tokens")
    )
    return rows.where("tokens > 0")


def _weight(weights: dict[str, dict[str, int]], level: str) -> Column:
    """Whole-number weights by name; a name without one has 1."""
    w = F.lit(1)
    for name, value in weights.get(level, {}).items():
        if int(value) != value or value < 0:
            raise ValueError("weights are whole numbers of 0 or more")
        w = F.when(F.col(level) == name, F.lit(int(value))).otherwise(w)
    return w.cast("decimal(38,0)")


def budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], total: int, max_epochs: int) -> DataFrame:
    """domain, lang, source, tokens, budget of every leaf; leaves: one row for each, with its tokens."""
    wide = "decimal(38,0)"
    down = leaves.groupBy(F.lit(0).alias("root")).agg(F.least(F.lit(int(total)).cast(wide), F.sum(F.col("tokens") * max_epochs).cast(wide)).alias("budget"))
    leaves = leaves.withColumn("root", F.lit(0))
    for depth, level in enumerate(LEVELS):
        parent, path = ["root", *LEVELS[:depth]], ["root", *LEVELS[: depth + 1]]
        nodes = leaves.groupBy(*path).agg(F.sum("tokens").cast(wide).alias("tokens"), F.sum(F.col("tokens") * max_epochs).cast(wide).alias("room")).withColumn("w", _weight(weights, level)).where("w > 0")
        nodes = nodes.join(down, parent)
        # in the order of room / w, a node is full if the level at which it fills up still leaves enough for those after it
        order = Window.partitionBy(*parent).orderBy((F.col("room") / F.col("w")), *path)
        before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
        nodes = nodes.withColumn("used", F.coalesce(F.sum("room").over(before), F.lit(0)).cast(wide)).withColumn("open_w", F.sum("w").over(after).cast(wide))
        nodes = nodes.withColumn("full", F.expr("room * open_w + used * w <= budget * w"))
        node = Window.partitionBy(*parent)
        rest = F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(node), F.lit(0)).cast(wide)
        open_w = F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(node), F.lit(0)).cast(wide)
        nodes = nodes.withColumn("filled", rest).withColumn("weight_left", F.greatest(open_w, F.lit(1).cast(wide)))
        nodes = nodes.withColumn("share", F.expr("CAST(CASE WHEN full THEN room ELSE (w * (budget - filled)) div weight_left END AS decimal(38,0))"))
        # what division leaves over goes to those who lost the largest part of a token by it
        lost = F.expr("CASE WHEN full THEN -1 ELSE (w * (budget - filled)) % weight_left END")
        nodes = nodes.withColumn("place", F.row_number().over(Window.partitionBy(*parent).orderBy(lost.desc(), *path)))
        left = F.col("budget") - F.sum("share").over(node)
        down = nodes.select(*path, "tokens", (F.col("share") + F.when(~F.col("full") & (F.col("place") <= left), 1).otherwise(0)).cast(wide).alias("budget"))
        if depth < 2:
            down = down.drop("tokens")
    return down.select(*LEVELS, F.col("tokens").cast("long").alias("tokens"), F.col("budget").cast("long").alias("budget"))


def cut(text: Column, tokens: Column) -> Column:
    """The first `tokens` words of a text, joined by one space."""
    return F.array_join(F.slice(words_of(text), F.lit(1), tokens.cast("int")), " ")


def order_key(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix(docs: DataFrame, domain: Column, weights: dict[str, dict[str, int]], share: tuple[int, int] = (1, 1), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """doc_id, row, domain, lang, source, epoch (from 0), tokens, n_taken: one row for each time that a document is taken;
    n_taken < tokens where a leaf's prefix ends inside it.  share: numerator and denominator of the tokens to take, of all."""
    rows = settled(counted(docs, domain))
    leaves = settled(rows.groupBy(*LEVELS).agg(F.sum("tokens").cast("long").alias("tokens"), F.count(F.lit(1)).alias("held")))
    whole, n = leaves.agg(F.sum("tokens"), F.sum("held")).first()
    total = (whole or 0) * share[0] // share[1]
    digits = max(1, math.ceil(math.log(max(n or 1, 2), 16)) - 2)
    plan = budgets(leaves, weights, total, max_epochs).withColumn("epochs", F.expr("budget div tokens")).withColumn("rest", F.expr("budget % tokens"))
    plan = settled(plan.withColumnRenamed("tokens", "leaf_tokens"))
    # one row for each leaf
    dealt = rows.join(sized(plan), list(LEVELS))
    full = dealt.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs").cast("int") - 1))).withColumn("n_taken", F.col("tokens"))
    last = dealt.where("rest > 0").withColumn("epoch", F.col("epochs").cast("int")).withColumn("key", order_key(seed, F.col("epoch"))).withColumn("from", F.lit(0).cast("long"))
    columns = ["doc_id", "row", *LEVELS, F.col("epoch").cast("int").alias("epoch"), "tokens", F.col("n_taken").cast("long").alias("n_taken")]
    taken = full.select(*columns)
    for at in range(0, digits, 2):
        # of each leaf, `last` holds the one bucket that its prefix ends in, `from` what comes before that
        last = last.withColumn("bucket", F.substring("key", 1, min(at + 2, digits)))
        # written, so that rows are added up by leaf and bucket, and only the sums are dealt by leaf for the window
        sums = settled(last.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("held"), F.first("rest").alias("leaf_rest"), F.first("from").alias("leaf_from")))
        before = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("start", F.col("leaf_from") + F.coalesce(F.sum("held").over(before), F.lit(0))).where("start < leaf_rest").drop("leaf_rest", "leaf_from")
        last = settled(last.join(sums, [*LEVELS, "bucket"]))
        taken = taken.unionByName(last.where("start + held <= rest").withColumn("n_taken", F.col("tokens")).select(*columns))
        last = last.where("start + held > rest").withColumn("from", F.col("start")).drop("start", "held", "bucket")
    bucket = Window.partitionBy(*LEVELS).orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    edge = last.withColumn("start", F.col("from") + F.coalesce(F.sum("tokens").over(bucket), F.lit(0))).where("start < rest")
    return taken.unionByName(edge.withColumn("n_taken", F.least("tokens", F.col("rest") - F.col("start"))).select(*columns))
