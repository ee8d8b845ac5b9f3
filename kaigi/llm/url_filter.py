"""URL filters (2): a temporal list join.

Dated list entries (add, remove) become validity intervals; every capture is held against the entries that were active when
it was fetched.  An entry is a host, which covers its subdomains too, or a host with the first part of a path.  A capture
turns into the few keys that could cover it, and an equi-join on the key with a condition on time does the rest.  Keys with
very many captures are dealt over tasks by their counts, with copies of their few intervals; an entry's events are put in
order day by day, and then its days.  Only DataFrame functions are used.

A null url or fetch time, or a url without a host, is covered by nothing (blocked false); so is one whose host has over 253
characters, which no host may have.  Addresses in figures (10.0.0.1) have no parent domains.  Entries with a null key, time or
action, or another action than add and remove, are no entries.  At equal times a removal counts after an addition; repeated
additions are one.  Equal captures each get their row; other columns of the captures are carried along, and where one has the
name of a new column, the new one gets underscores at its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exchange import salted, settled

LONGEST_HOST = 253


def host_of(url: Column) -> Column:
    """The host in lower case without user, port or final dot; null if there is none or it is longer than hosts can be."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.nullif(F.when(F.length(host) <= LONGEST_HOST, F.regexp_replace(host, r"\.$", "")), F.lit(""))


def path_head(url: Column) -> Column:
    """The first part of the path, null if there is none."""
    return F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+/([^/?#]+)", 1), F.lit(""))


def keys_of(url: Column) -> Column:
    """Everything that could cover the url: the host, each of its parents of two labels or more, and host/part."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    suffixes = F.when(host.rlike(r"^[0-9.]+$"), F.array(host)).otherwise(suffixes)
    return F.when(host.isNull(), F.array().cast("array<string>")).otherwise(F.array_compact(F.concat(suffixes, F.array(F.concat(host, F.lit("/"), path_head(url))))))


def intervals(entries: DataFrame) -> DataFrame:
    """entry, valid_from, valid_to (exclusive; null: still active) from entry, action, at."""
    events = entries.where("entry is not null and at is not null and action in ('add', 'remove')").groupBy("entry", "at").agg(F.max("action").alias("action"))
    events = settled(events.withColumn("day", F.floor(F.col("at").cast("double") / 86400)))
    days = events.groupBy("entry", "day").agg(F.min("at").alias("first"))
    days = days.select("entry", "day", F.lead("first").over(Window.partitionBy("entry").orderBy("day")).alias("next_day"))
    within = F.lead("at").over(Window.partitionBy("entry", "day").orderBy("at"))
    ended = events.withColumn("next", within).join(days, ["entry", "day"])
    return ended.where("action = 'add'").select("entry", F.col("at").alias("valid_from"), F.coalesce("next", "next_day").alias("valid_to"))


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """captures with blocked, n_entries and entry: how many entries covered each capture when it was fetched, and the first
    of them by name (null if none)."""
    taken = {c.lower() for c in captures.columns}

    def free(name):
        while name in taken:
            name += "_"
        return name

    row = F.struct(*(F.col(f"`{c}`") for c in captures.columns)).alias("c")
    keyed = captures.select(row, F.col(at).alias("t"), F.array_distinct(keys_of(F.col(url))).alias("keys"), F.monotonically_increasing_id().alias("id"))
    left, right = salted(keyed.select("id", "c", "t", F.explode_outer("keys").alias("entry")), intervals(entries), "entry", F.xxhash64("t", "id"))
    active = (F.col("t") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("t") < F.col("valid_to")))
    joined = left.alias("l").join(right.alias("r"), (F.col("l.entry") == F.col("r.entry")) & (F.col("l.salt") == F.col("r.salt")) & active, "left")
    found = joined.groupBy("l.id").agg(F.first("l.c").alias("c"), F.countDistinct("r.entry").alias("n"), F.min("r.entry").alias("e"))
    return found.select("c.*", (F.col("n") > 0).alias(free("blocked")), F.col("n").alias(free("n_entries")), F.col("e").alias(free("entry")))
