"""One query for each operator over the test tables, with SQL that gives the same rows.

documents stand for sessions (doc_id) and, by source, for speakers; conversations for meetings; labels for a dimension that
covers some documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import incremental, minutes, retrieval, speakers, tfidf, tokens
from ..profiles import COUNCIL, PARLIAMENT
from ..sources import landing, readers, run_stats, sinks
from ..staging import new_folder, settled
from . import pipelines, sql

#: A stand-in dictionary of category words, as the tables hold no Japanese.
CATEGORIES = [(0, "articles", w) for w in ("the", "der", "die", "das", "le", "la", "les", "el", "los")] + [
    (1, "links", w) for w in ("and", "und", "et", "que", "with", "avec")
] + [(2, "places", w) for w in ("in", "on", "at", "dans", "von", "de")] + [(3, "mixed", w) for w in ("de", "la", "that", "this", "pour", "para")] + [(4, "never", w) for w in ("A", "x1", "オープン")]
STOPS = ("the", "and", "of", "la", "de", "die")
#: Letters and the full-width ones that stand for them where rules leave out what has ASCII letters.
_SMALL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WIDE = "".join(chr(ord(x) + 0xFEE0) for x in _SMALL)
#: Letters that older forms of characters stand for.
_FOLDED = "enfrdscu"
#: A katakana sign for each letter.
_KANA = "".join(chr(0x30A2 + i) for i in range(52))
_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}]{2,}')"


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _docs(spark, sf):
    return _read(spark, sf, "documents")


def _tokens(docs, entity="doc_id"):
    return docs.select(entity, F.explode(text.words(F.col("text"))).alias("term"))


def _counts(spark, sf):
    """Of the documents, in parts by doc_id; to split texts again costs less than to keep the counts."""
    return tfidf.term_counts(_tokens(tfidf.by_entity(_docs(spark, sf).select("doc_id", "text"), "doc_id", "text")), "doc_id")


def _settled_counts(spark, sf):
    """Of the sources; texts are split once."""
    return settled(tfidf.term_counts(_tokens(_docs(spark, sf), "source"), "source"))


def session_tfidf_top30(spark, sf):
    weights = tfidf.tfidf(_counts(spark, sf), "doc_id", _docs(spark, sf).count(), min_df=2, max_df=0.7, max_features=10_000)
    return tfidf.ranked(weights, "doc_id", 30).select("doc_id", "rank", "term", F.round("weight", 4).alias("score"), "tf")


def session_term_counts(spark, sf):
    return _counts(spark, sf)


def document_frequency(spark, sf):
    return tfidf.document_frequency(_counts(spark, sf))


def vocabulary_pruned(spark, sf):
    return tfidf.vocabulary(document_frequency(spark, sf), _docs(spark, sf).count(), 2, 0.7, 10_000)


def speaker_utterance_stats(spark, sf):
    docs = _docs(spark, sf)
    counts = speakers.utterance_counts(docs, "source", "text", "doc_id").where(F.col("utterance_count") >= 10)
    totals = docs.groupBy("source").agg(F.sum(F.size(text.words(F.col("text")))).cast("long").alias("total_words"))
    return counts.join(totals, "source").orderBy(F.desc("utterance_count"), "first_seg")


def _speaker_weights(spark, sf):
    return tfidf.tfidf(_settled_counts(spark, sf), "source", _docs(spark, sf).select("source").distinct().count(), min_df=2, max_df=0.6, sublinear=True)


def speaker_tfidf_top200(spark, sf):
    return tfidf.ranked(_speaker_weights(spark, sf), "source", 200).select("source", "rank", "term", F.round("weight", 6).alias("tfidf"), F.col("tf").alias("count"))


def top3_speakers_top5_words(spark, sf):
    top = speakers.utterance_counts(_docs(spark, sf), "source", "text", "doc_id").orderBy(F.desc("utterance_count"), "first_seg").limit(3)
    return tfidf.ranked(_speaker_weights(spark, sf), "source", 5).join(top.select("source"), "source").select("source", "rank", "term")


def speaker_meta_left_join(spark, sf):
    talk = _read(spark, sf, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.min_by("role", "turn").alias("role"))
    dim = _read(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("conv_id"), F.lit("").alias("role"), F.concat(F.lit("group"), (F.col("toxic")).cast("string")).alias("party"))
    return speakers.with_harvest(talk.withColumn("role", F.when(F.col("n_turns") > 2, F.col("role"))), speakers.harvested(dim, "conv_id", "conv_id", "role", "party"), "conv_id")


def member_flag_join(spark, sf):
    docs = _docs(spark, sf).select(F.col("doc_id").cast("string").alias("speaker_id"), F.lit("").alias("role"), "source")
    labels = _read(spark, sf, "labels")
    dim = labels.select(F.col("doc_id").cast("string").alias("name"), F.lit(None).cast("string").alias("kana"), F.lit("").alias("gender"), F.col("quality").cast("string").alias("party"), F.col("toxic").cast("string").alias("faction"), F.array("quality", "toxic").alias("terms"))
    joined = speakers.with_members(docs, dim)
    return joined.select("speaker_id", "source", "role", "party", "faction", F.array_join(F.col("terms").cast("array<string>"), ",").alias("terms"), "in_member_json")


def _categories(spark):
    return spark.createDataFrame(CATEGORIES, "cat_seq int, category string, word string")


def _scores(spark, sf):
    return speakers.category_scores(_speaker_weights_all(spark, sf), _docs(spark, sf).select("source"), _categories(spark), "source")


def _speaker_weights_all(spark, sf):
    return tfidf.tfidf(_settled_counts(spark, sf), "source", _docs(spark, sf).select("source").distinct().count(), min_df=2, max_df=1.0, sublinear=True)


def category_scores(spark, sf):
    return _scores(spark, sf).select("source", "cat_seq", "category", F.round("score", 4).alias("score"), "word_count")


def category_top5(spark, sf):
    return _scores(spark, sf).select("source", "cat_seq", "top_words")


def category_lint(spark, sf):
    """The words of every benchmark item as a dictionary; a seventh of the items in katakana."""
    word = F.explode(F.array_distinct(F.split(F.regexp_replace("text", r"[^\p{L} ]", ""), " +")))
    found = _read(spark, sf, "benchmark").select(F.col("item_id").cast("int").alias("cat_seq"), F.concat(F.lit("c"), "item_id").alias("category"), word.alias("word")).where("word <> ''")
    kana = F.when(F.col("cat_seq") % 7 == 0, F.translate("word", _SMALL, _KANA)).otherwise(F.col("word"))
    return speakers.unreachable_words(found.withColumn("word", kana), list(STOPS)).distinct()


def stopword_anti_join(spark, sf):
    stops = spark.createDataFrame([(w,) for w in STOPS], "term string")
    return tokens.drop_stop_words(_tokens(_docs(spark, sf)), stops).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))


def token_class_filters(spark, sf):
    word = F.explode(F.filter(F.split("text", r"\s+"), lambda x: x != "")).alias("word")
    w, count = F.col("word"), lambda c, name: F.count_if(c).alias(name)
    return _docs(spark, sf).select("source", word).groupBy("source").agg(
        count(F.length(w) < 2, "short"), count(tokens.is_number(w), "digits"), count(tokens.has_ascii(w), "ascii"), count(w.contains("-"), "hyphen"), count(tokens.is_hiragana(w), "hiragana"), count(tokens.is_katakana(w), "katakana"), count(F.length(w) > 10, "long_words")
    )


def token_filters(spark, sf):
    """Words as morphemes whose classes follow from their length: what stays under the rules of both profiles."""
    word = F.explode(F.filter(F.split("text", r"\s+"), lambda x: x != "")).alias("w")
    kinds = F.array(*map(F.lit, ("普通名詞", "固有名詞", "数詞", "接尾辞", "助数詞相当語")))
    n = F.length("w")
    m = F.struct(
        F.col("w").alias("surface"), F.when(n % 7 > 0, F.translate("w", _SMALL, _WIDE)).alias("lemma"), F.when(n % 11 > 0, tokens.NOUN).otherwise("動詞").alias("pos1"), F.element_at(kinds, n % 5 + 1).alias("pos2"), F.when(n % 3 == 0, tokens.PERSON).alias("pos3")
    )
    rules = {"parliament_sessions": PARLIAMENT.session_rules, "parliament_speakers": PARLIAMENT.speaker_rules, "council_sessions": COUNCIL.session_rules, "council_speakers": COUNCIL.with_speaker_stops(STOPS).speaker_rules}
    return _docs(spark, sf).select("source", word).select("source", m.alias("m")).groupBy("source").agg(*(F.count_if(tokens.keeps(F.col("m"), r)).alias(name) for name, r in rules.items()))


def _assembly(spark, sf):
    """Conversations as meetings of 12 speakers of each role, with texts that the rules of the parliament take."""
    group, conv = F.when(F.col("turn") > 0, F.concat(F.lit("group"), F.col("conv_id") % 3)), F.col("conv_id") % 12
    speech = F.struct(F.col("turn"), F.concat("role", conv).alias("speaker"), F.when(F.col("conv_id") % 5 == 0, "委員").alias("speakerRole"), group.alias("speakerGroup"), F.translate("text", _SMALL, _WIDE).alias("speech"))
    found = _read(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(speech)).alias("speechRecord"))
    return found.withColumn("file_name", F.concat(F.lit("20240126_"), "conv_id", F.lit(".json")))


def _speaker_tables(spark, sf):
    meetings = _assembly(spark, sf)
    header = minutes.parliament_header(F.col("conv_id"), F.lit("house"), F.lit("meeting"), F.lit("1"), F.lit("2024-01-26"))
    sessions = meetings.select(F.lpad(F.col("conv_id").cast("string"), 12, "0").alias("session_seq"), minutes.meeting_text(header, F.col("speechRecord")).alias("text"))
    categories = _categories(spark).withColumn("word", F.translate("word", _SMALL, _WIDE))
    return pipelines.speaker_tables(pipelines.corpus_segments(sessions, PARLIAMENT), PARLIAMENT, pipelines.harvested_speakers(meetings, PARLIAMENT), categories)


def speakers_meta(spark, sf):
    return _speaker_tables(spark, sf)[0].drop("first_seg")


def tfidf_words(spark, sf):
    return _speaker_tables(spark, sf)[1]


def tfidf_categories(spark, sf):
    return _speaker_tables(spark, sf)[2].drop("cat_seq")


def safe_file_names(spark, sf):
    return _read(spark, sf, "pages").select("page_id", text.safe_filename(F.col("url")).alias("file_name"))


def stripped_texts(spark, sf):
    return _docs(spark, sf).select("doc_id", F.length(text.strip(F.col("text"))).cast("long").alias("n_chars"), F.size(text.split_lines(F.col("text"), every_kind=True)).cast("long").alias("n_lines"))


def to_enrich(spark, sf):
    """Meetings without any speech; those without an assistant's turn count as unreadable."""
    some = F.max(F.when(F.col("role") == "assistant", 1)).alias("a")
    found = _read(spark, sf, "conversations").groupBy("conv_id").agg(some, F.collect_list(F.struct(F.when(F.col("turn") > 1, F.col("text")).alias("speech"))).alias("speechRecord"))
    return incremental.to_enrich(found.withColumn("bad", F.when(F.col("a").isNull(), "x")), "bad").select("conv_id")


def latest_members(spark, sf):
    """Labels as a member table: the last term's party and all terms of each member."""
    term = F.struct(F.col("doc_id").cast("int").alias("term"), F.concat(F.lit("p"), "quality").alias("party"), F.concat(F.lit("f"), "toxic").alias("faction"))
    rows = _read(spark, sf, "labels").withColumn("member", F.floor(F.col("doc_id") / 7)).groupBy("member").agg(F.array_sort(F.collect_list(term)).alias("terms"))
    table = rows.select(F.array(F.struct(F.concat(F.lit("m"), F.col("member") % 1000).alias("name"), F.col("member").cast("string").alias("kana"), F.lit("x").alias("gender"), "terms")).alias("members")).groupBy().agg(F.flatten(F.array_sort(F.collect_list("members"))).alias("members"))
    return speakers.members(table).withColumn("terms", F.array_join(F.col("terms").cast("array<string>"), ","))


def _meetings(spark, sf):
    """Conversations as meetings: conv_id, speechRecord in the order of turns."""
    speech = F.struct(F.col("turn"), F.when(F.col("role") == "assistant", "").otherwise(F.col("role")).alias("speaker"), F.when(F.col("role") == "user", "議長").alias("speakerRole"), F.col("text").alias("speech"))
    return _read(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(speech)).alias("speechRecord"))


def _texts(spark, sf):
    header = minutes.parliament_header(F.col("conv_id"), F.lit("house"), F.lit("meeting"), F.when(F.col("conv_id") % 3 > 0, F.lit("1")), F.when(F.col("conv_id") % 5 > 0, F.lit("2024-01-26")))
    return _meetings(spark, sf).select("conv_id", minutes.meeting_text(header, F.col("speechRecord")).alias("text"))


def transcript_format(spark, sf):
    return _texts(spark, sf).select("conv_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


def _lines(spark, sf):
    return readers.body_lines(_texts(spark, sf), "conv_id", "text")


def utterance_segments(spark, sf):
    found = minutes.utterances(_lines(spark, sf), "conv_id")
    return found.select(F.col("seg_id").cast("long").alias("seg_id"), "role", "name", "conv_id", F.md5("text").alias("digest"))


def session_split_loose(spark, sf):
    return minutes.loose_sessions(_texts(spark, sf)).select("conv_id", F.col("session_no").cast("long").alias("session_no"), "label", F.md5("content").alias("digest"))


def session_split_strict(spark, sf):
    placed = minutes.strict_sessions(_lines(spark, sf), ["conv_id"], PARLIAMENT.header)
    return placed.groupBy("conv_id", "session_no").agg(F.max("name").alias("name"), F.count(F.lit(1)).alias("n_lines"))


def first_value_meta(spark, sf):
    return speakers.first_values(_read(spark, sf, "conversations").withColumn("r", F.when(F.col("turn") > 0, F.col("role"))), "conv_id", "turn", "role", "r")


def last_wins_dedup(spark, sf):
    return speakers.last_wins(_read(spark, sf, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


def incremental_new_sessions(spark, sf):
    return incremental.new_rows(_docs(spark, sf).select("doc_id", "source"), _read(spark, sf, "labels"), "doc_id")


def incremental_new_meetings(spark, sf):
    found = _read(spark, sf, "events").select(F.expr("event_id div 3").alias("issue")).distinct()
    return incremental.new_rows(found, _read(spark, sf, "labels").select(F.col("doc_id").alias("issue")), "issue")


def landed_merge(spark, sf):
    """Events as a listing without props land by day, then the records of errors and purchases take their place; the table as it
    is then, in a folder of its own, and the days that were rewritten."""
    folder = new_folder(spark, "landed")
    events = _read(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("day"), "event_type", "value", "props")
    landing.land(events.withColumn("props", F.lit(None).cast("string")), folder, "event_id", "day")
    done = landing.merge(events.where(F.col("event_type").isin("error", "purchase")), folder, "event_id", "day")
    return landing.landed(spark, folder).select("event_id", landing.DAY, "event_type", "props", F.col(landing.DAY).isin(list(done.rewritten)).alias("rewritten"))


def html_links(spark, sf):
    found = readers.links(_read(spark, sf, "pages"), suffix="")
    return found.groupBy("page_id", "target", "file_name").agg(F.count(F.lit(1)).alias("n"))


def retrieval_top10(spark, sf):
    """The ten documents nearest to each benchmark item."""
    n, counts = _docs(spark, sf).count(), settled(_counts(spark, sf))
    frequency = settled(tfidf.document_frequency(counts).select("term", "df"))
    asked = tfidf.term_counts(_read(spark, sf, "benchmark").select("item_id", F.explode(text.words(F.col("text"))).alias("term")), "item_id")
    queries = settled(retrieval.query_weights(asked, frequency, n, "item_id"))
    return retrieval.search(counts, frequency, n, queries, 10, "doc_id", "item_id").select("item_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def links_by_kind(spark, sf):
    """How often each page refers to something, by the tag that does."""
    return readers.linked(_read(spark, sf, "pages")).groupBy("page_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def json_props(spark, sf):
    return _read(spark, sf, "events").select(text.json_int(F.col("props"), "k").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def has_text_predicate(spark, sf):
    return _meetings(spark, sf).select("conv_id", minutes.has_speech(F.col("speechRecord")).alias("has_text"), F.size("speechRecord").cast("long").alias("n"))


def chunk_2000(spark, sf):
    return _docs(spark, sf).select("doc_id", F.posexplode(text.chunks(F.col("text"))).alias("chunk_no", "chunk")).select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.md5("chunk").alias("digest"))


def printable_ratio(spark, sf):
    return _docs(spark, sf).select("doc_id", F.round(text.printable_ratio(F.col("text")), 6).alias("ratio"))


def _era_text(doc_id):
    """A date in one of six eras (one of them unknown), with a first year here and there and digits of both widths."""
    number = lambda n: F.when(doc_id % 2 == 0, F.translate(n.cast("string"), "0123456789", text.FULL_WIDTH_DIGITS)).otherwise(n.cast("string"))
    era = F.element_at(F.array(*map(F.lit, (*dates.ERAS, "大和"))), (doc_id % 6 + 1).cast("int"))
    return F.concat(F.lit("議会　"), era, F.when(doc_id % 13 == 0, "元").otherwise(number(doc_id % 64 + 1)), F.lit("年 "), number(doc_id % 12 + 1), F.lit("月"), number(doc_id % 31 + 1), F.lit("日から"))


def era_date_parse(spark, sf):
    return _docs(spark, sf).select("doc_id", dates.parse_date(_era_text(F.col("doc_id"))).alias("day"))


def filename_sort_key(spark, sf):
    """Every document as a file, a fifth of them without a day and number."""
    name = F.when(F.col("doc_id") % 5 == 0, F.concat("source", F.lit(".json"))).otherwise(F.concat((20240101 + F.col("doc_id") % 28).cast("string"), F.lit("_"), "lang", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".json")))
    key = readers.sort_key(name)
    return _docs(spark, sf).select("doc_id", key["day"].alias("day"), key["number"].cast("long").alias("number"))


def nfkc_name(spark, sf):
    """Sources in full-width characters with a wide blank, which normalise to the sources."""
    wide = F.concat(F.translate("source", _SMALL + "0123456789", _WIDE + text.FULL_WIDTH_DIGITS), F.lit("　"), F.translate("lang", _SMALL, _WIDE))
    names = _docs(spark, sf).select(wide.alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("docs"))
    return names.select("n", text.folded_name(text.nfkc("n"), True).alias("name"), "docs")


def council_headers(spark, sf):
    """Every document as a council's first page: a third without a kind of session, a quarter without a last day."""
    d = F.col("doc_id")
    day = lambda m, n: F.concat(F.lit("令和"), (d % 6 + 1).cast("string"), F.lit("年"), (m % 12 + 1).cast("string"), F.lit("月"), (n % 28 + 1).cast("string"), F.lit("日"))
    kind = F.element_at(F.array(F.lit("定例会"), F.lit("臨時会"), F.lit("会")), (d % 3 + 1).cast("int"))
    page = F.concat(F.lit("令和"), (d % 6 + 1).cast("string"), F.lit("年 第"), (d % 9 + 1).cast("string"), F.lit("回 "), kind, F.lit("\n自 "), day(d, d), F.when(d % 4 == 0, "").otherwise(F.concat(F.lit("\n至 "), day(d + 1, d * 7))))
    return _docs(spark, sf).select("doc_id", minutes.council_header(dates.front_matter(page)).alias("header"))


def front_matter_removed(spark, sf):
    """Every text as a session with a block of attendance (the text itself) before its first speaker."""
    body = F.concat(F.lit("◎会議録情報\n"), "text", F.lit("\n◎甲君\n"), "text")
    return _docs(spark, sf).select("doc_id", F.md5(tokens.without_front_matter(body)).alias("digest"))


def kanji_variants(spark, sf):
    """Sources spelt with older forms of characters, folded to the newer ones."""
    old = F.translate(F.concat("lang", "source"), _FOLDED, text.VARIANTS[0])
    return _docs(spark, sf).select(old.alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("docs")).select(text.folded_name(F.col("n"), True).alias("name"), "docs")


def session_file_names(spark, sf):
    """Every document's session, the file it is written to by either kind of minutes, and the name that the file stands for."""
    name = F.concat_ws(" ", F.concat(F.lit("第"), F.col("doc_id").cast("string"), F.lit("回")), "lang", "source")
    files = _docs(spark, sf).select("doc_id", minutes.file_name(name, "_").alias("parliament"), minutes.file_name(name, "").alias("council"))
    return files.withColumn("name", minutes.session_name(F.col("parliament"), "_")).withColumn("short", minutes.session_name(F.col("council"), ""))


def meeting_file_names(spark, sf):
    """Conversations as meetings: the names of their files, some without a day."""
    day = F.when(F.col("conv_id") % 4 > 0, F.concat(F.lit("2024-01-"), F.lpad((F.col("conv_id") % 28 + 1).cast("string"), 2, "0")))
    found = _read(spark, sf, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    found = found.select("conv_id", day.alias("date"), F.lit("h/o").alias("nameOfHouse"), F.concat(F.lit("m:"), "turns").alias("nameOfMeeting"), F.when(F.col("conv_id") % 3 > 0, "no?").alias("issue"), F.col("conv_id").cast("string").alias("issueID"))
    return found.select("conv_id", sinks.meeting_file(found).alias("file_name"))


def first_session_terms(spark, sf):
    docs = _docs(spark, sf)
    features = session_tfidf_top30(spark, sf).withColumnRenamed("doc_id", "session_seq")
    return pipelines.first_session_terms(features, docs.select(F.col("doc_id").alias("session_seq"))).select("rank", "term", "score")


def corpus_size(spark, sf):
    return pipelines.corpus_size(_docs(spark, sf))


def readable_documents(spark, sf):
    """Documents as files whose first page is the text, or for a tenth of them control characters and the text."""
    page = F.when(F.col("doc_id") % 10 == 0, F.concat(F.repeat(F.lit("\x01"), F.length("text") + 1), "text")).when(F.col("doc_id") % 10 == 1, "　\n ").otherwise(F.col("text"))
    found = readers.readable(_docs(spark, sf).select(F.col("doc_id").alias("path"), F.array(page, F.lit("")).alias("pages")))
    return found.select(F.col("path").alias("doc_id"), F.length("full_text").cast("long").alias("n_chars"))


def observed_counters(spark, sf):
    """run_counters, taken while the documents are written for something else."""
    long = F.length("text") > 0
    counts = {"n": F.count(F.lit(1)), "ok": F.count_if(long), "skipped": F.count_if(~F.coalesce(long, F.lit(False))), "n_chars": F.sum(F.length("text")).cast("long"), "n_bytes": F.sum(F.octet_length("text")).cast("long")}
    rows, seen = run_stats.observed(_docs(spark, sf), **counts)
    settled(rows.select("doc_id", F.length("text")))
    return spark.createDataFrame([tuple(seen.get[c] for c in counts)], ", ".join(f"{c} long" for c in counts))


def run_counters(spark, sf):
    return pipelines.text_counters(_docs(spark, sf), "text")


_QUERIES = (
    session_tfidf_top30, session_term_counts, document_frequency, vocabulary_pruned, speaker_utterance_stats, speaker_tfidf_top200, top3_speakers_top5_words, speaker_meta_left_join, member_flag_join, category_scores, category_top5,
    category_lint, stopword_anti_join, token_class_filters, transcript_format, utterance_segments, session_split_loose, session_split_strict, first_value_meta, last_wins_dedup, incremental_new_sessions, incremental_new_meetings,
    retrieval_top10, html_links, links_by_kind, json_props, has_text_predicate, chunk_2000, printable_ratio, era_date_parse, filename_sort_key, nfkc_name, council_headers, front_matter_removed, kanji_variants, session_file_names, meeting_file_names, first_session_terms, corpus_size, readable_documents, run_counters, observed_counters,
    speakers_meta, tfidf_words, tfidf_categories, token_filters, safe_file_names, stripped_texts, to_enrich, latest_members, landed_merge,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES} | {name: sql.query(name) for name in sql.QUERIES}


def _weights(entity: str, max_df: str, cap: str, sublinear: bool) -> str:
    count = "1 + ln(tf)" if sublinear else "tf"
    return f"""tok AS (SELECT {entity}, unnest({_TOKENS}) AS term FROM documents), tf AS (SELECT {entity}, term, count(*) AS tf FROM tok GROUP BY ALL),
n AS (SELECT count(DISTINCT {entity})::DOUBLE AS n FROM documents), df AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS total_tf FROM tf GROUP BY term),
vocab AS (SELECT term, df FROM df, n WHERE df >= 2 AND df <= {max_df} * n ORDER BY total_tf DESC, term {cap}),
raw AS (SELECT {entity}, term, tf, df, ({count}) * (ln((1.0 + n) / (1 + df)) + 1) AS raw FROM tf JOIN vocab USING (term), n),
weights AS (SELECT {entity}, term, tf, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {entity})) AS weight FROM raw),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {entity} ORDER BY round(weight, 10) DESC, term) AS rank FROM weights)"""


_TOK = f"tok AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents), tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL)"
_CATS = "cats(cat_seq, category, word) AS (VALUES " + ", ".join(f"({a}, '{b}', '{c}')" for a, b, c in CATEGORIES) + ")"
_SPEECHES = """sp AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN '' ELSE coalesce(role, '') END AS speaker, CASE WHEN role = 'user' THEN '議長' ELSE '' END AS r, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS speech FROM conversations),
mk AS (SELECT conv_id, turn, CASE WHEN speaker = '' THEN '◎（発言者不明君）' WHEN r <> '' THEN '◎' || r || '（' || speaker || '君）' ELSE '◎' || speaker || '君' END AS marker, speech FROM sp),
tx AS (SELECT conv_id, chr(10) || chr(10) || '==== 第' || conv_id || '回 house meeting ' || CASE WHEN conv_id % 3 > 0 THEN '1' ELSE '?' END || ' ' || CASE WHEN conv_id % 5 > 0 THEN '2024-01-26' ELSE '?' END || ' ====' || chr(10) || chr(10)
  || string_agg(chr(10) || marker || CASE WHEN speech = '' THEN '' ELSE chr(10) || speech END, chr(10) ORDER BY turn) AS text FROM mk GROUP BY conv_id)"""
_LINES = _SPEECHES + ", ln AS (SELECT conv_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM tx)"
_SCORES = f"""WITH {_weights("source", "1.0", "", True)}, {_CATS}, e AS (SELECT DISTINCT source FROM documents), c AS (SELECT DISTINCT cat_seq, category FROM cats),
m AS (SELECT source, cat_seq, word, weight, row_number() OVER (PARTITION BY source, cat_seq ORDER BY round(weight, 10) DESC, word) AS r FROM weights JOIN cats ON term = word)"""

_WIDE_TEXT = f"translate({{}}, '{_SMALL}', '{_WIDE}')"
_WIDE_CATS = "cats(cat_seq, category, word) AS (VALUES " + ", ".join(f"({a}, '{b}', '{c.translate(str.maketrans(_SMALL, _WIDE))}')" for a, b, c in CATEGORIES) + ")"
_SPEAKERS = f"""WITH sp AS (SELECT conv_id, turn, role || (conv_id % 12) AS speaker, CASE WHEN conv_id % 5 = 0 THEN '委員' ELSE '' END AS r, CASE WHEN turn > 0 THEN 'group' || (conv_id % 3) END AS grp, trim(coalesce({_WIDE_TEXT.format('text')}, ''), ' ' || chr(9) || chr(10) || chr(13)) AS speech FROM conversations),
mk AS (SELECT conv_id, turn, CASE WHEN r <> '' THEN '◎' || r || '（' || speaker || '君）' ELSE '◎' || speaker || '君' END AS marker, speech FROM sp),
tx AS (SELECT conv_id, chr(10) || chr(10) || '==== 第' || conv_id || '回 house meeting 1 2024-01-26 ====' || chr(10) || chr(10) || string_agg(chr(10) || marker || CASE WHEN speech = '' THEN '' ELSE chr(10) || speech END, chr(10) ORDER BY turn) AS text FROM mk GROUP BY conv_id),
ln AS (SELECT conv_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM tx),
k AS (SELECT *, starts_with(line, '◎') AND contains(line, '君') AS titled FROM ln WHERE NOT starts_with(line, '◎') OR contains(line, '君')),
s AS (SELECT *, sum(titled::INT) OVER (ORDER BY conv_id, line_no ROWS UNBOUNDED PRECEDING) AS seg_id FROM k),
g AS (SELECT seg_id, max(CASE WHEN titled THEN substr(line, 2) END) AS marker, trim(coalesce(string_agg(line, chr(10) ORDER BY conv_id, line_no) FILTER (WHERE NOT titled), ''), ' ' || chr(9) || chr(10) || chr(13)) AS text FROM s WHERE seg_id > 0 GROUP BY seg_id),
seg AS (SELECT seg_id, CASE WHEN starts_with(marker, '委員（') THEN '委員' END AS role, regexp_extract(marker, '([a-z]+[0-9]+)君', 1) AS speaker_id, text FROM g),
info AS (SELECT speaker_id, speaker_id AS name, arg_min(role, seg_id) FILTER (WHERE role IS NOT NULL) AS role, count(*) FILTER (WHERE text <> '') AS utterance_count FROM seg GROUP BY speaker_id HAVING count(*) FILTER (WHERE text <> '') >= 10),
dim AS (SELECT speaker AS speaker_id, arg_min(r, (conv_id, turn)) AS role, arg_min(grp, (conv_id, turn)) FILTER (WHERE grp IS NOT NULL) AS party FROM sp GROUP BY speaker),
pieces AS (SELECT speaker_id, unnest(list_transform(range((greatest(length(text), 1) + 1999) // 2000), lambda i: substr(text, 2000 * i + 1, 2000))) AS text FROM seg SEMI JOIN info USING (speaker_id)),
tok AS (SELECT * FROM (SELECT speaker_id, unnest({_TOKENS}) AS term FROM pieces) WHERE NOT regexp_matches(term, '[a-zA-Z]')),
tf AS (SELECT speaker_id, term, count(*) AS tf FROM tok GROUP BY ALL), n AS (SELECT count(*)::DOUBLE AS n FROM info), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (SELECT speaker_id, term, tf, (1 + ln(tf)) * (ln((1.0 + n) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (term), n WHERE df >= 2 AND df <= 0.6 * n),
weights AS (SELECT speaker_id, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY speaker_id)) AS weight FROM raw),
ranked AS (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY round(weight, 10) DESC, term) AS rank FROM weights),
about AS (SELECT speaker_id, name, coalesce(nullif(info.role, ''), dim.role, '') AS role, coalesce(party, '') AS party, utterance_count, total_words FROM info LEFT JOIN dim USING (speaker_id) LEFT JOIN (SELECT speaker_id, sum(tf) AS total_words FROM tf GROUP BY speaker_id) USING (speaker_id))"""
_KEEPS = r"""CASE WHEN length(w) % 11 > 0 AND list_element(['普通名詞', '固有名詞', '数詞', '接尾辞', '助数詞相当語'], length(w) % 5 + 1) NOT IN ({skip}) AND length(b) >= 2 {more}
AND NOT regexp_matches(b, '^[0-9０-９\s\-・]+$') AND NOT regexp_matches(b, '^[ぁ-ん]+$') AND NOT regexp_matches(b, '[a-zA-Z]') AND NOT contains(b, '-') AND NOT regexp_matches(b, '^[ァ-ヴー]+$') AND b NOT IN {stops} THEN 1 END"""
_SKIP = "'数詞', '接尾辞', '非自立可能'"
_TOKEN_FILTERS = rf"""WITH w AS (SELECT source, unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS w FROM documents), m AS (SELECT source, w, CASE WHEN length(w) % 7 > 0 THEN {_WIDE_TEXT.format('w')} ELSE w END AS b FROM w)
SELECT source, count({_KEEPS.format(skip=_SKIP, more="AND length(w) % 3 <> 0 AND length(b) <= 10", stops=PARLIAMENT.session_rules.stop)}) AS parliament_sessions,
count({_KEEPS.format(skip=_SKIP + ", '助数詞相当語'", more="AND NOT suffix(b, '君')", stops=PARLIAMENT.speaker_rules.stop)}) AS parliament_speakers,
count({_KEEPS.format(skip=_SKIP, more="AND b NOT IN ('明治', '大正', '昭和', '平成', '令和')", stops=COUNCIL.session_rules.stop)}) AS council_sessions,
count({_KEEPS.format(skip=_SKIP + ", '助数詞相当語'", more="AND NOT suffix(b, '君')", stops=STOPS)}) AS council_speakers FROM m GROUP BY source"""

_ORACLES = {
    "session_tfidf_top30": f"WITH {_weights('doc_id', '0.7', 'LIMIT 10000', False).replace('count(DISTINCT doc_id)', 'count(*)')} SELECT doc_id, rank, term, round(weight, 4) AS score, tf FROM ranked WHERE rank <= 30",
    "session_term_counts": f"WITH {_TOK} SELECT * FROM tf",
    "document_frequency": f"WITH {_TOK} SELECT term, count(*) AS df, sum(tf)::BIGINT AS total_tf FROM tf GROUP BY term",
    "vocabulary_pruned": f"WITH {_TOK}, df AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS total_tf FROM tf GROUP BY term) SELECT * FROM df WHERE df >= 2 AND df <= 0.7 * (SELECT count(*) FROM documents) ORDER BY total_tf DESC, term LIMIT 10000",
    "speaker_utterance_stats": f"SELECT source, count(*) FILTER (WHERE length(text) > 0) AS utterance_count, min(doc_id) AS first_seg, sum(len({_TOKENS}))::BIGINT AS total_words FROM documents GROUP BY source HAVING count(*) FILTER (WHERE length(text) > 0) >= 10",
    "speaker_tfidf_top200": f"WITH {_weights('source', '0.6', '', True)} SELECT source, rank, term, round(weight, 6) AS tfidf, tf AS count FROM ranked WHERE rank <= 200",
    "top3_speakers_top5_words": f"WITH {_weights('source', '0.6', '', True)}, top AS (SELECT source FROM documents GROUP BY source ORDER BY count(*) FILTER (WHERE length(text) > 0) DESC, min(doc_id) LIMIT 3) SELECT source, rank, term FROM ranked WHERE rank <= 5 AND source IN (FROM top)",
    "speaker_meta_left_join": "WITH t AS (SELECT conv_id, count(*) AS n_turns, arg_min(role, turn) AS role FROM conversations GROUP BY 1), d AS (SELECT doc_id, 'group' || min(toxic) AS party FROM labels WHERE quality = 1 GROUP BY doc_id) SELECT conv_id, n_turns, CASE WHEN n_turns > 2 THEN coalesce(role, '') ELSE '' END AS role, coalesce(party, '') AS party FROM t LEFT JOIN d ON conv_id = doc_id",
    "member_flag_join": "SELECT d.doc_id::VARCHAR AS speaker_id, source, CASE WHEN l.doc_id IS NULL THEN '不明' ELSE '議員' END AS role, coalesce(quality::VARCHAR, '') AS party, coalesce(toxic::VARCHAR, '') AS faction, CASE WHEN l.doc_id IS NULL THEN '' ELSE quality || ',' || toxic END AS terms, l.doc_id IS NOT NULL AS in_member_json FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "category_scores": f"{_SCORES} SELECT source, cat_seq, category, round(coalesce(sum(weight), 0.0), 4) AS score, count(word) AS word_count FROM e CROSS JOIN c LEFT JOIN m USING (source, cat_seq) GROUP BY ALL",
    "category_top5": f"{_SCORES} SELECT source, cat_seq, coalesce(string_agg(word, ',' ORDER BY r) FILTER (WHERE r <= 5), '') AS top_words FROM e CROSS JOIN c LEFT JOIN m USING (source, cat_seq) GROUP BY ALL",
    "category_lint": f"""WITH b AS (SELECT item_id::INT AS cat_seq, 'c' || item_id AS category, unnest(string_split_regex(regexp_replace(text, '[^\\p{{L}} ]', '', 'g'), ' +')) AS w FROM benchmark),
cats AS (SELECT DISTINCT cat_seq, category, CASE WHEN cat_seq % 7 = 0 THEN translate(w, '{_SMALL}', '{_KANA}') ELSE w END AS word FROM b WHERE w <> '')
SELECT * FROM (SELECT cat_seq, category, word, CASE WHEN length(word) < 2 THEN 'short' WHEN word IN {STOPS} THEN 'stop word' WHEN regexp_matches(word, '[A-Za-z]') THEN 'ascii' WHEN word <> lower(word) THEN 'capitals' WHEN regexp_matches(word, '^[ァ-ヴー]+$') THEN 'katakana' WHEN regexp_matches(word, '^[ぁ-ん]+$') THEN 'hiragana' END AS reason FROM cats) WHERE reason IS NOT NULL""",
    "stopword_anti_join": f"WITH {_TOK} SELECT doc_id, count(*) AS n_tokens FROM tok WHERE term NOT IN {STOPS} GROUP BY doc_id",
    "token_class_filters": r"""WITH w AS (SELECT source, unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS word FROM documents)
SELECT source, count_if(length(word) < 2)::BIGINT AS short, count_if(regexp_matches(word, '^[0-9０-９\s\-・]+$'))::BIGINT AS digits, count_if(regexp_matches(word, '[a-zA-Z]'))::BIGINT AS ascii, count_if(contains(word, '-'))::BIGINT AS hyphen, count_if(regexp_matches(word, '^[ぁ-ん]+$'))::BIGINT AS hiragana, count_if(regexp_matches(word, '^[ァ-ヴー]+$'))::BIGINT AS katakana, count_if(length(word) > 10)::BIGINT AS long_words FROM w GROUP BY source""",
    "transcript_format": f"WITH {_SPEECHES} SELECT conv_id, length(text)::BIGINT AS n_chars, md5(text) AS digest FROM tx",
    "utterance_segments": f"""WITH {_LINES}, k AS (SELECT *, starts_with(line, '◎') AND contains(line, '君') AS titled FROM ln WHERE NOT starts_with(line, '◎') OR contains(line, '君')),
s AS (SELECT *, sum(titled::INT) OVER (ORDER BY conv_id, line_no ROWS UNBOUNDED PRECEDING) AS seg_id FROM k),
g AS (SELECT seg_id, max(CASE WHEN titled THEN conv_id END) AS conv_id, max(CASE WHEN titled THEN substr(line, 2) END) AS marker, string_agg(line, chr(10) ORDER BY conv_id, line_no) FILTER (WHERE NOT titled) AS text FROM s WHERE seg_id > 0 GROUP BY seg_id)
SELECT seg_id::BIGINT AS seg_id, nullif(regexp_extract(marker, '^(.+?)（(.+?)君）\\s*$', 1), '') AS role,
CASE WHEN regexp_matches(marker, '^(.+?)（(.+?)君）\\s*$') THEN regexp_extract(marker, '^(.+?)（(.+?)君）\\s*$', 2) WHEN regexp_matches(marker, '^(.+?)君\\s*$') THEN regexp_extract(marker, '^(.+?)君\\s*$', 1) ELSE marker END AS name,
conv_id, md5(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13))) AS digest FROM g""",
    "session_split_loose": f"WITH {_SPEECHES} SELECT conv_id, 1::BIGINT AS session_no, trim(regexp_extract(text, '====.+?===='), '= ' || chr(10)) AS label, md5(regexp_replace(text, '(?s)^.*?====.+?====', '')) AS digest FROM tx",
    "session_split_strict": f"WITH {_LINES}, h AS (SELECT *, regexp_extract(line, '^==== (.+?) \\d{{4}}-\\d{{2}}-\\d{{2}} ====$', 1) AS nm, count(*) FILTER (WHERE regexp_matches(line, '^==== (.+?) \\d{{4}}-\\d{{2}}-\\d{{2}} ====$')) OVER (PARTITION BY conv_id ORDER BY line_no) AS session_no FROM ln) SELECT conv_id, session_no, max(nullif(nm, '')) AS name, count(*) AS n_lines FROM h GROUP BY ALL",
    "first_value_meta": "SELECT conv_id, arg_min(role, turn) AS raw_name, arg_min(role, turn) FILTER (WHERE turn > 0 AND role <> '') AS role FROM conversations GROUP BY conv_id",
    "last_wins_dedup": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id",
    "incremental_new_sessions": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "incremental_new_meetings": "SELECT DISTINCT event_id // 3 AS issue FROM events WHERE event_id // 3 NOT IN (SELECT doc_id FROM labels)",
    "html_links": """WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)<a\\b[^<>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1)) AS href FROM pages),
r AS (SELECT page_id, href, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*)', 1) AS root, regexp_extract(regexp_replace(url, '[?#].*$', ''), '^([a-zA-Z][a-zA-Z0-9+.\\-]*://.*/)[^/]*$', 1) AS folder, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\\-]*:)', 1) AS scheme FROM h)
SELECT page_id, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.\\-]*:') THEN href WHEN starts_with(href, '//') THEN scheme || href WHEN starts_with(href, '/') THEN root || href WHEN length(folder) > length(root) THEN folder || href ELSE root || '/' || href END AS target, list_last(string_split(href, '/')) AS file_name, count(*) AS n FROM r GROUP BY ALL""",
    "retrieval_top10": f"""WITH {_TOK}, df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM df),
d AS (SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS w FROM tf JOIN idf USING (term)),
b AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest({_TOKENS}) AS term FROM benchmark) GROUP BY ALL),
q AS (SELECT item_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY item_id)) AS w FROM b JOIN idf USING (term)),
s AS (SELECT item_id, doc_id, sum(q.w * d.w) AS score FROM q JOIN d USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 10) DESC, doc_id) AS rank FROM s) WHERE rank <= 10""",
    "links_by_kind": r"""WITH c AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)(<(?:script|style)\b[^>]*>).*?</(?:script|style)\s*>', '\1', 'g') AS h FROM pages),
t AS (SELECT page_id, unnest(regexp_extract_all(h, '(?i)<(?:a|area|link|img|script|iframe|source)\s[^>]*>')) AS tag FROM c),
k AS (SELECT page_id, lower(regexp_extract(tag, '<(\w+)', 1)) AS kind, tag FROM t)
SELECT page_id, kind, count(*) AS n FROM k WHERE regexp_matches(tag, CASE WHEN kind IN ('a', 'area', 'link') THEN '(?i)\shref\s*=\s*("[^"]+"|''[^'']+''|[^\s"''>])' ELSE '(?i)\ssrc\s*=\s*("[^"]+"|''[^'']+''|[^\s"''>])' END) GROUP BY page_id, kind""",
    "json_props": "SELECT try_cast(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n FROM events GROUP BY 1",
    "has_text_predicate": "SELECT conv_id, bool_or(length(coalesce(text, '')) > 0) AS has_text, count(*) AS n FROM conversations GROUP BY conv_id",
    "chunk_2000": "SELECT doc_id, i::BIGINT AS chunk_no, md5(substr(text, 2000 * i + 1, 2000)) AS digest FROM (SELECT doc_id, text, unnest(range((greatest(length(text), 1) + 1999) // 2000)) AS i FROM documents WHERE text IS NOT NULL)",
    "printable_ratio": r"SELECT doc_id, round((length(regexp_replace(text, '[\p{C}\p{Zs}\p{Zl}\p{Zp}]', '', 'g')) + length(text) - length(replace(text, ' ', '')))::DOUBLE / greatest(length(text), 1), 6) AS ratio FROM documents",
    "era_date_parse": r"""WITH v AS (SELECT doc_id, '議会　' || (['明治', '大正', '昭和', '平成', '令和', '大和'])[doc_id % 6 + 1] || CASE WHEN doc_id % 13 = 0 THEN '元' ELSE (doc_id % 64 + 1)::VARCHAR END || '年 ' || (doc_id % 12 + 1) || '月' || (doc_id % 31 + 1) || '日から' AS u FROM documents),
p AS (SELECT doc_id, regexp_extract(u, '(明治|大正|昭和|平成|令和)\s*(元|\d+)\s*年\s*(\d+)\s*月\s*(\d+)\s*日', ['e', 'y', 'm', 'd']) AS x FROM v)
SELECT doc_id, CASE WHEN x.e <> '' THEN printf('%04d-%02d-%02d', CASE x.e WHEN '明治' THEN 1868 WHEN '大正' THEN 1912 WHEN '昭和' THEN 1926 WHEN '平成' THEN 1989 ELSE 2019 END + CASE WHEN x.y = '元' THEN 1 ELSE try_cast(x.y AS INT) END - 1, try_cast(x.m AS INT), try_cast(x.d AS INT)) END AS day FROM p""",
    "filename_sort_key": r"SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN split_part(source, '_', 1) ELSE (20240101 + doc_id % 28)::VARCHAR END AS day, CASE WHEN doc_id % 5 = 0 THEN coalesce(try_cast(regexp_extract(source, '(\d+)$', 1) AS BIGINT), 0) ELSE doc_id END AS number FROM documents",
    "nfkc_name": f"SELECT translate(source, '{_SMALL}0123456789', '{_WIDE}０１２３４５６７８９') || '　' || translate(lang, '{_SMALL}', '{_WIDE}') AS n, source || lang AS name, count(*) AS docs FROM documents GROUP BY ALL",
    "council_headers": """WITH v AS (SELECT doc_id, printf('%04d-%02d-%02d', 2019 + doc_id % 6, doc_id % 12 + 1, doc_id % 28 + 1) AS a, CASE WHEN doc_id % 4 = 0 THEN '?' ELSE printf('%04d-%02d-%02d', 2019 + doc_id % 6, (doc_id + 1) % 12 + 1, doc_id * 7 % 28 + 1) END AS b FROM documents)
SELECT doc_id, chr(10) || chr(10) || '==== 令和' || (doc_id % 6 + 1) || '年 第' || (doc_id % 9 + 1) || '回 ' || (['定例会', '臨時会', '種別不明'])[doc_id % 3 + 1] || ' ' || CASE WHEN a = b THEN a ELSE a || '〜' || b END || ' ====' || chr(10) AS header FROM v""",
    "front_matter_removed": "SELECT doc_id, md5(chr(10) || text) AS digest FROM documents",
    "kanji_variants": f"SELECT translate(lang || source, '{_FOLDED}', '{text.VARIANTS[1]}') AS name, count(*) AS docs FROM documents GROUP BY 1",
    "session_file_names": "SELECT doc_id, '第' || doc_id || '回_' || lang || '_' || source || '.txt' AS parliament, '第' || doc_id || '回' || lang || source || '.txt' AS council, '第' || doc_id || '回 ' || lang || ' ' || source AS name, '第' || doc_id || '回' || lang || source AS short FROM documents",
    "meeting_file_names": "SELECT conv_id, CASE WHEN conv_id % 4 > 0 THEN '202401' || lpad((conv_id % 28 + 1)::VARCHAR, 2, '0') ELSE '00000000' END || '_h_o_m_' || count(*) || '_' || CASE WHEN conv_id % 3 > 0 THEN 'no_' ELSE '' END || '_' || conv_id || '.json' AS file_name FROM conversations GROUP BY conv_id",
    "first_session_terms": f"WITH {_weights('doc_id', '0.7', 'LIMIT 10000', False).replace('count(DISTINCT doc_id)', 'count(*)')} SELECT rank, term, round(weight, 4) AS score FROM ranked WHERE rank <= 10 AND doc_id = (SELECT min(doc_id) FROM documents)",
    "corpus_size": "SELECT count(*) AS n_sessions, sum(length(text))::BIGINT AS n_chars, sum(strlen(text))::BIGINT AS n_bytes, count_if(coalesce(length(text), 0) = 0)::BIGINT AS n_empty FROM documents",
    "readable_documents": r"SELECT doc_id, length(text) + 1 AS n_chars FROM documents WHERE doc_id % 10 > 1 AND (length(regexp_replace(text, '[\p{C}\p{Zs}\p{Zl}\p{Zp}]', '', 'g')) + length(text) - length(replace(text, ' ', '')))::DOUBLE / greatest(length(text), 1) >= 0.5 AND regexp_matches(text, '[^\s\x0B\x1C-\x1F\x{85}\p{Z}]')",
    "observed_counters": "SELECT count(*) AS n, count_if(length(text) > 0)::BIGINT AS ok, count_if(coalesce(length(text), 0) = 0)::BIGINT AS skipped, sum(length(text))::BIGINT AS n_chars, sum(strlen(text))::BIGINT AS n_bytes FROM documents",
    "run_counters": "SELECT count(*) AS n, count_if(length(text) > 0)::BIGINT AS ok, count_if(coalesce(length(text), 0) = 0)::BIGINT AS skipped, sum(length(text))::BIGINT AS n_chars, sum(strlen(text))::BIGINT AS n_bytes FROM documents",
    "speakers_meta": f"{_SPEAKERS} SELECT speaker_id AS id, name, role, party, utterance_count, coalesce(total_words, 0)::BIGINT AS total_words FROM about",
    "tfidf_words": f"{_SPEAKERS} SELECT speaker_id, name, role, party, utterance_count, term AS word, round(weight, 6) AS tfidf, tf AS count, rank FROM ranked JOIN about USING (speaker_id) WHERE rank <= 200",
    "tfidf_categories": f"""{_SPEAKERS}, {_WIDE_CATS}, c AS (SELECT DISTINCT cat_seq, category FROM cats),
m AS (SELECT speaker_id, cat_seq, word, weight, row_number() OVER (PARTITION BY speaker_id, cat_seq ORDER BY round(weight, 10) DESC, word) AS r FROM weights JOIN cats ON term = word)
SELECT speaker_id, any_value(name) AS name, any_value(role) AS role, any_value(party) AS party, any_value(utterance_count) AS utterance_count, category, round(coalesce(sum(weight), 0.0), 6) AS score, count(word) AS word_count, coalesce(string_agg(word, ',' ORDER BY r) FILTER (WHERE r <= 5), '') AS top_words
FROM about CROSS JOIN c LEFT JOIN m USING (speaker_id, cat_seq) GROUP BY speaker_id, cat_seq, category""",
    "token_filters": _TOKEN_FILTERS,
    "safe_file_names": r"""SELECT page_id, trim(regexp_replace(url, '[\\/:*?"<>|]', '_', 'g')) AS file_name FROM pages""",
    "stripped_texts": r"SELECT doc_id, length(regexp_replace(regexp_replace(text, '^[\s\x0B\x1C-\x1F\x{85}\p{Z}]+', ''), '[\s\x0B\x1C-\x1F\x{85}\p{Z}]+$', ''))::BIGINT AS n_chars, len(regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'))::BIGINT AS n_lines FROM documents WHERE text IS NOT NULL",
    "to_enrich": "SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE turn > 1 AND length(text) > 0) = 0 OR count(*) FILTER (WHERE role = 'assistant') = 0",
    "latest_members": """WITH t AS (SELECT doc_id // 7 AS member, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS terms, arg_max('p' || quality, doc_id) AS party, arg_max('f' || toxic, doc_id) AS faction FROM labels GROUP BY 1)
SELECT 'm' || (member % 1000) AS name, arg_max(member::VARCHAR, member::VARCHAR) AS kana, 'x' AS gender, arg_max(party, member::VARCHAR) AS party, arg_max(faction, member::VARCHAR) AS faction, arg_max(terms, member::VARCHAR) AS terms FROM t GROUP BY 1""",
}


def oracle_sql() -> dict[str, str]:
    return _ORACLES | sql.ORACLES
