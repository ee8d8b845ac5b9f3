"""Minutes as text and back: headers, speaker markers, sessions and utterances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import or_empty, parse_marker, strip, strip_label

HEADER = "====.+?===="


def parliament_header(session: Column, house: Column, meeting: Column, issue: Column, date: Column) -> Column:
    given = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    return F.concat(F.lit("\n\n==== 第"), given(session), F.lit("回 "), given(house), F.lit(" "), given(meeting), F.lit(" "), given(issue), F.lit(" "), given(date), F.lit(" ====\n"))


def council_header(meta: Column) -> Column:
    """From dates.front_matter."""
    start, end = F.coalesce(meta["date_start"], F.lit("?")), F.coalesce(meta["date_end"], F.lit("?"))
    time = F.when(meta["kai"].isNotNull() & (meta["kai"] != 0), F.concat(F.lit("第"), meta["kai"].cast("string"), F.lit("回"))).otherwise("回不明")
    dates = F.when(start == end, start).otherwise(F.concat(start, F.lit("〜"), end))
    return F.concat(F.lit("\n\n==== "), F.coalesce(meta["nendo"], F.lit("年度不明")), F.lit(" "), time, F.lit(" "), F.coalesce(meta["session_type"], F.lit("種別不明")), F.lit(" "), dates, F.lit(" ====\n"))


def speaker_marker(speaker: Column, role: Column) -> Column:
    """The marker line of a speech; a speaker without a name is unknown."""
    name, role = strip(or_empty(speaker)), strip(or_empty(role))
    base = F.regexp_replace(name, "君$", "")
    return F.when(name == "", "◎（発言者不明君）").when(role != "", F.concat(F.lit("◎"), role, F.lit("（"), base, F.lit("君）"))).otherwise(F.concat(F.lit("◎"), base, F.lit("君")))


def meeting_text(header: Column, speeches: Column) -> Column:
    """Header and speeches (array of speaker, speakerRole, speech) as one text."""

    def lines(s):
        text = strip(or_empty(s["speech"]))
        marker = F.concat(F.lit("\n"), speaker_marker(s["speaker"], s["speakerRole"]))
        return F.when(text == "", F.array(marker)).otherwise(F.array(marker, text))

    return F.array_join(F.concat(F.array(header), F.flatten(F.transform(F.coalesce(speeches, F.array()), lines))), "\n")


def has_speech(speeches: Column) -> Column:
    return F.coalesce(F.exists(speeches, lambda s: F.coalesce(F.length(s["speech"]) > 0, F.lit(False))), F.lit(False))


def loose_sessions(corpus: DataFrame, text: str = "text") -> DataFrame:
    """corpus columns, session_no (from 1), label, content: every header anywhere starts a session, text before is dropped."""
    labels = F.regexp_extract_all(F.col(text), F.lit(HEADER), 0)
    bodies = F.split(F.col(text), HEADER, -1)
    zipped = F.arrays_zip(labels.alias("label"), F.slice(bodies, F.lit(2), F.size(labels)).alias("content"))
    rest = [c for c in corpus.columns if c != text]
    return corpus.select(*rest, F.posexplode(zipped).alias("i", "s")).select(*rest, (F.col("i") + 1).alias("session_no"), strip_label(F.col("s.label")).alias("label"), F.col("s.content").alias("content"))


def strict_sessions(lines: DataFrame, corpus: list[str], header: str, line_no: str = "line_no", line: str = "line") -> DataFrame:
    """lines with session_no (0: before the first header) and name (of the header line): only whole-line headers with a date
    start a session; other headers stay within the one before."""
    order = Window.partitionBy(*corpus).orderBy(line_no)
    is_header = F.col(line).rlike(header)
    return lines.withColumn("session_no", F.count(F.when(is_header, 1)).over(order)).withColumn("name", F.when(is_header, F.regexp_extract(line, header, 1)))


def file_name(name: Column, space: str) -> Column:
    return F.concat(F.replace(name, F.lit(" "), F.lit(space)), F.lit(".txt"))


def session_name(file: Column, space: str) -> Column:
    """The name that a file name stands for; where blanks were left out (space is empty) they stay out."""
    stem = F.regexp_replace(file, r"\.[^.]*$", "")
    return F.replace(stem, F.lit(space), F.lit(" ")) if space else stem


def prefix_sums(counts: DataFrame, order: str, value: str, blocks: int = 1024) -> DataFrame:
    """counts with `before`: the sum of value over smaller order values, of whatever type; order is unique.

    Rows are dealt into ranges between at most `blocks` of the order values, those with the least hashes, so that windows
    stay small; only these bounds reach the driver."""
    picked = [r[0] for r in counts.where(F.col(order).isNotNull()).orderBy(F.xxhash64(order), order).limit(blocks).select(order).collect()]
    bounds = F.array(*(F.lit(x) for x in picked)) if picked else F.array().cast("array<string>")
    key = F.col(order) if picked else F.col(order).cast("string")
    block = F.size(F.filter(bounds, lambda b: b <= key))
    sums = counts.groupBy(block.alias("_block")).agg(F.sum(value).alias("_sum")).groupBy().agg(F.map_from_entries(F.collect_list(F.struct("_block", "_sum"))).alias("_sums"))
    placed = counts.withColumn("_block", block).crossJoin(F.broadcast(sums))
    start = F.aggregate(F.map_entries("_sums"), F.lit(0).cast("long"), lambda s, e: s + F.when(e["key"] < F.col("_block"), e["value"]).otherwise(0).cast("long"))
    within = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("before", start + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_block", "_sums")


def utterances(lines: DataFrame, session: str = "session_seq", line_no: str = "line_no", line: str = "line", reset_at_session: bool = False) -> DataFrame:
    """seg_id, role, name, session of the marker, text: what is said from one speaker marker to the next.

    The speaker carries over into the next session unless reset_at_session; lines before the first marker and marker lines
    without a title go; texts are stripped and may be empty (a marker without a speech).  Lines without a session are one session,
    before all others.
    """
    is_marker = F.col(line).startswith("◎")
    titled = is_marker & F.col(line).contains("君")
    kept = lines.select(session, line_no, F.coalesce(F.col(line), F.lit("")).alias(line)).where(~is_marker | F.col(line).contains("君"))
    own = kept.withColumn("_at", F.count(F.when(titled, 1)).over(Window.partitionBy(session).orderBy(line_no)))
    starts = prefix_sums(kept.groupBy(session).agg(F.count(F.when(titled, 1)).alias("_n")), session, "_n").select(F.col(session).alias("_session"), "before")
    placed = own.join(starts, F.col(session).eqNullSafe(F.col("_session"))).withColumn("seg_id", F.col("before") + F.col("_at")).where((F.col("_at") > 0) if reset_at_session else (F.col("seg_id") > 0))
    marker = F.struct(session, parse_marker(F.substring(line, 2, 2_000_000_000)).alias("m"))
    pieces = F.array_sort(F.collect_list(F.when(~titled, F.struct(session, line_no, F.col(line).alias("x")))))
    segments = placed.groupBy("seg_id").agg(F.max(F.when(titled, marker)).alias("k"), pieces.alias("p"))
    return segments.select("seg_id", "k.m.role", "k.m.name", F.col(f"k.{session}").alias(session), strip(F.array_join(F.transform("p", lambda p: p["x"]), "\n")).alias("text"))
