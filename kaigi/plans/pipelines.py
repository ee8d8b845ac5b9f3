"""The whole ways from sources to results, each one plan without files in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import front_matter
from ..functions.text import chunks, folded_name, nfkc
from ..operators import incremental, minutes, speakers, tfidf, tokens
from ..profiles import Profile
from ..sources import landing, run_stats, sinks
from ..sources.readers import body_lines, full_meetings, meetings, readable, sort_key
from ..staging import settled


def parliament_sessions(found: DataFrame) -> DataFrame:
    """session_seq, label, text of readable meetings in the order of (day, number, file name)."""
    some = found.where("_corrupt is null")
    header = minutes.parliament_header(*(F.col(c) for c in ("session", "nameOfHouse", "nameOfMeeting", "issue", "date")))
    key = sort_key(F.col("file_name"))
    return some.select(F.concat_ws("|", key["day"], F.lpad(key["number"].cast("string"), 38, "0"), "file_name").alias("session_seq"), minutes.strip_label(header).alias("label"), minutes.meeting_text(header, F.col("speechRecord")).alias("text"))


def format_corpus(spark: SparkSession, folder: str, path: str, run: str, stats: str) -> dict[str, int]:
    """Meeting files to the concatenated corpus; the counts of files, ok and error (no JSON), which are added to the table stats, come
    from the same pass."""
    corrupt = F.col("_corrupt").isNotNull()
    found, seen = run_stats.observed(meetings(spark, folder), files=F.count(F.lit(1)), ok=F.count_if(~corrupt), error=F.count_if(corrupt))
    sinks.corpus_text(settled(parliament_sessions(found)), path)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    run_stats.save(spark, stats, run, counts)
    return counts


def council_sessions(documents: DataFrame) -> DataFrame:
    meta = readable(documents).withColumn("meta", front_matter(F.col("first_page")))
    header = minutes.council_header(F.col("meta"))
    return meta.select(F.col("path").alias("session_seq"), minutes.strip_label(header).alias("label"), F.concat(header, minutes.strip(F.col("full_text"))).alias("text"), "meta")


def session_features(sessions: DataFrame, profile: Profile, tokenizer=tokens.letter_runs) -> DataFrame:
    """session_seq, term, tf, df, weight, count, rank."""
    body = tokens.without_front_matter(F.col("text")) if profile.strip_markers else F.col("text")
    texts = tfidf.by_entity(sessions.select("session_seq", body.alias("body")), "session_seq", "body")
    found = tokens.token_table(texts, "session_seq", "body", profile.session_rules, tokenizer)
    low, high = profile.session_df
    weights = tfidf.tfidf(settled(tfidf.term_counts(found, "session_seq")), "session_seq", sessions.count(), min_df=low, max_df=high, max_features=profile.max_features)
    return tfidf.ranked(weights, "session_seq", profile.top_session_terms)


def first_session_terms(features: DataFrame, sessions: DataFrame, n: int = 10) -> DataFrame:
    """The first session's n best terms, as a look at the result."""
    first = sessions.agg(F.min("session_seq")).first()[0]  # a value, so that the others are left out before they are weighed and ranked
    return features.where((F.col("session_seq") == F.lit(first)) & (F.col("rank") <= n)).orderBy("rank")


def corpus_size(sessions: DataFrame) -> DataFrame:
    """n_sessions, n_chars, n_bytes, n_empty of a corpus."""
    return text_counters(sessions, "text").select(F.col("n").alias("n_sessions"), "n_chars", "n_bytes", F.col("skipped").alias("n_empty"))


def text_counters(rows: DataFrame, text: str) -> DataFrame:
    """n, ok (with text), skipped (without), n_chars, n_bytes: the counters of a run."""
    long = F.length(text) > 0
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(long).alias("ok"), F.count_if(~F.coalesce(long, F.lit(False))).alias("skipped"), F.sum(F.length(text)).cast("long").alias("n_chars"), F.sum(F.octet_length(text)).cast("long").alias("n_bytes"))


def corpus_segments(sessions: DataFrame, profile: Profile) -> DataFrame:
    """Utterances with speaker_id of sessions (session_seq, text) in the order of session_seq, of whatever type it is."""
    return settled(named_segments(minutes.utterances(body_lines(sessions, "session_seq", "text"), "session_seq"), profile))


def normalised(names: DataFrame, name: str, profile: Profile) -> DataFrame:
    """name and speaker_id of the distinct names: each is normalised once."""
    return names.select(name).where(F.col(name).isNotNull()).distinct().withColumn("speaker_id", folded_name(nfkc(name), profile.fold_variants))


def named_segments(segments: DataFrame, profile: Profile) -> DataFrame:
    """segments with speaker_id; segments of an empty name go."""
    return segments.join(normalised(segments, "name", profile), "name").where(F.length("speaker_id") > 0)


def enrich_landed(spark: SparkSession, path: str, fetch: Callable[[str], dict | None], pause: float = 0.5) -> dict[str, int]:
    """Looks up the landed meetings that have no speech and puts the full records in their place; counts of targets, ok, error.

    Each target is looked up once; a lookup that fails leaves its meeting as it is and a target of the next run."""
    targets = settled(incremental.to_enrich(landing.landed(spark, path)).select("issueID"))
    full = settled(full_meetings(targets, fetch, pause))
    n, ok = targets.count(), full.count()
    if ok:
        sinks.merge_meetings(full, path)
    return {"targets": n, "ok": ok, "error": n - ok}


def harvested_speakers(found: DataFrame, profile: Profile) -> DataFrame:
    """speaker_id, role, party from the meetings' speeches (file_name, speechRecord) in the order of the files."""
    key = sort_key(F.col("file_name"))
    speeches = found.select(key["day"].alias("day"), key["number"].alias("number"), "file_name", F.posexplode("speechRecord").alias("i", "s"))
    speeches = speeches.select("s.speaker", "s.speakerRole", "s.speakerGroup", F.struct("day", "number", "file_name", "i").alias("at"))
    named = speeches.join(normalised(speeches, "speaker", profile), "speaker").where(F.length("speaker_id") > 0)
    return speakers.harvested(named, "speaker_id", "at", "speakerRole", "speakerGroup")


def member_dimension(profiles: DataFrame, profile: Profile) -> DataFrame:
    """speaker_id and the profile of each member; of names that are equal when normalised, the last one's."""
    flat = speakers.members(profiles, keep_order=True)
    return speakers.last_wins(flat.join(normalised(flat, "name", profile), "name"), "speaker_id", "seq").drop("seq")


def speaker_analysis(segments: DataFrame, profile: Profile, categories: DataFrame | None = None, tokenizer=tokens.letter_runs) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(speakers, ranked words, category scores); counting comes before tokenising, which takes texts in slices of 2,000."""
    counts = speakers.utterance_counts(segments)
    kept = counts.where(F.col("utterance_count") >= profile.min_utterances)
    some = speakers.active(segments, counts, profile.min_utterances).select("speaker_id", F.explode(chunks(F.col("text"))).alias("text"))
    found = tokens.token_table(some, "speaker_id", "text", profile.speaker_rules, tokenizer)
    tf = settled(tfidf.term_counts(found, "speaker_id"))
    low, high = profile.speaker_df
    weights = tfidf.tfidf(tf, "speaker_id", kept.count(), min_df=low, max_df=high, sublinear=True)
    totals = tf.groupBy("speaker_id").agg(F.sum("tf").alias("total_words"))
    info = speakers.first_values(segments, "speaker_id", "seg_id")
    meta = kept.join(info, "speaker_id").join(totals, "speaker_id", "left").fillna(0, ["total_words"]).withColumn("is_pseudo", F.col("speaker_id").isin("会議録情報", "(発言者不明君)"))
    scores = speakers.category_scores(weights, kept, categories, "speaker_id") if categories is not None else None
    return meta, tfidf.ranked(weights, "speaker_id", profile.top_speaker_terms), scores


PARLIAMENT_INFO = ("name", "role", "party")
COUNCIL_INFO = ("name", "role", "gender", "party", "faction", "terms")


def speaker_tables(segments: DataFrame, profile: Profile, dim: DataFrame, categories: DataFrame, tokenizer=tokens.letter_runs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(speakers_meta, tfidf_words, tfidf_categories) with their columns in order.

    dim: harvested_speakers for a profile without members, member_dimension for one with (`terms` in it decides).  speakers_meta
    has the further column first_seg, by which speakers with equally many utterances are put in order.
    """
    meta, words, scores = speaker_analysis(segments, profile, categories, tokenizer)
    meta = settled(meta)
    base = meta.select("speaker_id", F.col("raw_name").alias("name"), F.coalesce("role", F.lit("")).alias("role"), "utterance_count", "total_words", "first_seg")
    if "terms" in dim.columns:
        about, info = speakers.with_members(base, dim, key="speaker_id"), COUNCIL_INFO
        columns = ("name", "kana", "gender", "party", "faction", "terms", "role", "in_member_json")
    else:
        about, info, columns = speakers.with_harvest(base, dim), PARLIAMENT_INFO, PARLIAMENT_INFO
    speakers_meta = about.select(F.col("speaker_id").alias("id"), *columns, "utterance_count", "total_words", "first_seg")
    carried = about.select("speaker_id", *info, "utterance_count")
    joined = lambda rows, *rest: rows.join(carried, "speaker_id").select("speaker_id", *info, "utterance_count", *rest)
    tfidf_words = joined(words.select("speaker_id", F.col("term").alias("word"), F.round("weight", 6).alias("tfidf"), "count", "rank"), "word", "tfidf", "count", "rank")
    tfidf_categories = joined(scores.select("speaker_id", "cat_seq", "category", F.round("score", 6).alias("score"), "word_count", "top_words"), "category", "score", "word_count", "top_words", "cat_seq")
    return speakers_meta, tfidf_words, tfidf_categories


def export_speaker_tables(tables: tuple[DataFrame, DataFrame, DataFrame], folder: str) -> None:
    """speakers_meta as JSON by utterances, the other two as CSV by speaker and rank or category."""
    meta, words, scores = tables
    sinks.ordered_json(meta.withColumn("_by", -F.col("utterance_count")), f"{folder}/speakers_meta", "_by", "first_seg", drop=("_by", "first_seg"))
    place = meta.select(F.col("id").alias("speaker_id"), "first_seg")
    sinks.ordered_csv(words.join(place, "speaker_id"), f"{folder}/tfidf_words", "first_seg", "rank", drop=("first_seg",))
    sinks.ordered_csv(scores.join(place, "speaker_id"), f"{folder}/tfidf_categories", "first_seg", "cat_seq", drop=("first_seg", "cat_seq"))
