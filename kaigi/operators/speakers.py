"""Speakers: counts, metadata, profile joins and category scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import or_empty


def utterance_counts(segments: DataFrame, speaker: str = "speaker_id", text: str = "text", order: str = "seg_id") -> DataFrame:
    """speaker, utterance_count (non-empty texts), first_seg."""
    return segments.groupBy(speaker).agg(F.count_if(F.length(text) > 0).alias("utterance_count"), F.min(order).alias("first_seg"))


def active(segments: DataFrame, counts: DataFrame, least: int, speaker: str = "speaker_id") -> DataFrame:
    """Segments of speakers with `least` utterances or more: filtered before anything is tokenised."""
    return segments.join(counts.where(F.col("utterance_count") >= least).select(speaker), speaker, "left_semi")


def first_values(markers: DataFrame, speaker: str, order: str, name: str = "name", role: str = "role") -> DataFrame:
    """speaker, raw_name of the first marker, role of the first marker that has one."""
    return markers.groupBy(speaker).agg(F.min_by(name, order).alias("raw_name"), F.min_by(F.when(or_empty(F.col(role)) != "", F.col(role)), F.when(or_empty(F.col(role)) != "", F.col(order))).alias("role"))


def harvested(speeches: DataFrame, speaker: str, order: str, role: str, party: str) -> DataFrame:
    """speaker, role at the first speech even if empty, first party that is not empty ('' if none)."""
    some = or_empty(F.col(party)) != ""
    return speeches.groupBy(speaker).agg(F.min_by(or_empty(F.col(role)), order).alias("role"), F.coalesce(F.min_by(F.when(some, F.col(party)), F.when(some, F.col(order))), F.lit("")).alias("party"))


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key: the last by order."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*(c for c in rows.columns if c != key)), order).alias("_last")).select(key, "_last.*")


def members(profiles: DataFrame, keep_order: bool = False) -> DataFrame:
    """name, kana, gender, party, faction (of the last term), terms from the nested member table; of equal names the last.
    keep_order: with seq, the place in the table."""
    m = F.col("m")
    last = F.when(F.size(m["terms"]) > 0, F.element_at(m["terms"], -1))
    flat = profiles.select(F.posexplode("members").alias("seq", "m")).select(
        "seq", m["name"].alias("name"), m["kana"].alias("kana"), m["gender"].alias("gender"), F.coalesce(last["party"], F.lit("-")).alias("party"), F.coalesce(last["faction"], F.lit("-")).alias("faction"),
        F.transform(m["terms"], lambda t: t["term"]).alias("terms"),
    )
    found = last_wins(flat, "name", "seq")
    return found if keep_order else found.drop("seq")


def with_harvest(speakers: DataFrame, dim: DataFrame, speaker: str = "speaker_id") -> DataFrame:
    """Left join; the marker's role goes before the harvested one, missing values are ''."""
    d = dim.select(speaker, F.col("role").alias("_role"), F.col("party").alias("_party"))
    return speakers.join(d, speaker, "left").withColumn("role", F.coalesce(F.nullif("role", F.lit("")), "_role", F.lit(""))).withColumn("party", or_empty(F.col("_party"))).drop("_role", "_party")


def with_members(speakers: DataFrame, dim: DataFrame, speaker: str = "speaker_id", key: str = "name") -> DataFrame:
    """Left join with member profiles under different defaults for matched and unmatched speakers, flagged in_member_json.
    Where speakers have a `name`, that of the profile goes before it."""
    joined = speakers.alias("s").join(dim.alias("d"), F.col(f"s.{speaker}") == F.col(f"d.{key}"), "left")
    known = F.col(f"d.{key}").isNotNull()
    filled = [F.coalesce(F.col(f"d.{c}"), F.lit("")).alias(c) for c in ("kana", "gender", "party", "faction")]
    name = lambda c: F.coalesce("d.name", "s.name").alias("name") if c == "name" else F.col(f"s.{c}")
    rest = [name(c) for c in speakers.columns if c not in ("role", "party")]
    role = F.coalesce(F.nullif(F.col("s.role"), F.lit("")), F.when(known, "議員").otherwise("不明"))
    return joined.select(*rest, role.alias("role"), *filled, F.coalesce(F.col("d.terms"), F.array().cast("array<int>")).alias("terms"), known.alias("in_member_json"))


def category_scores(weights: DataFrame, entities: DataFrame, categories: DataFrame, entity: str, term: str = "term") -> DataFrame:
    """entity, cat_seq, category, score, word_count (distinct words matched), top_words (five, by weight, ties by word).

    Every entity has every category; the categories are a dictionary given by the caller, so its copies stay small.
    """
    matched = weights.join(categories, F.col(term) == F.col("word"))
    order = Window.partitionBy(entity, "cat_seq").orderBy(F.desc(F.round("weight", 10)), "word")
    sums = matched.withColumn("_r", F.row_number().over(order)).groupBy(entity, "cat_seq").agg(
        F.sum("weight").alias("score"), F.count(F.lit(1)).alias("word_count"), F.array_sort(F.collect_list(F.when(F.col("_r") <= 5, F.struct("_r", "word")))).alias("_top")
    )
    names = categories.groupBy("cat_seq").agg(F.first("category").alias("category")).groupBy().agg(F.array_sort(F.collect_list(F.struct("cat_seq", "category"))).alias("c"))
    every = entities.select(entity).distinct().crossJoin(F.broadcast(names)).select(entity, F.explode("c").alias("c")).select(entity, "c.cat_seq", "c.category")
    return every.join(sums, [entity, "cat_seq"], "left").select(
        entity, "cat_seq", "category", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("word_count", F.lit(0)).cast("long").alias("word_count"), F.coalesce(F.array_join(F.transform("_top", lambda t: t["word"]), ","), F.lit("")).alias("top_words")
    )


def unreachable_words(categories: DataFrame, stops: list[str]) -> DataFrame:
    """cat_seq, category, word, reason of dictionary words that no token can equal."""
    w = F.col("word")
    reason = F.when(F.length(w) < 2, "short").when(w.isin(stops), "stop word").when(w.rlike("[A-Za-z]"), "ascii").when(w != F.lower(w), "capitals").when(w.rlike("^[ァ-ヴー]+$"), "katakana").when(w.rlike("^[ぁ-ん]+$"), "hiragana")
    return categories.select("cat_seq", "category", "word", reason.alias("reason")).where("reason is not null")
