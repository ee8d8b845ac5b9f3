"""The queries opN_<name> and their SQL: each operator over its whole table, with the parameters for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import new_folder
from . import decontaminate, filter_audit, jaccard_join, language_id, line_dedup, mixing, quality, secrets, substring_dedup, surrogates, time_partitions, token_files, url_filter

PII_KEY = "a key kept outside the repository in production"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.learn_and_scan(_read(spark, sf_dir, "documents"))


def captures_of(pages: DataFrame) -> DataFrame:
    """The pages with the time they stand for, as they have none: a minute of 2024 chosen by page_id."""
    minute = F.conv(F.substring(F.md5(F.concat(F.lit("t"), F.col("page_id").cast("string"))), 1, 4), 16, 10).cast("long")
    return pages.select("page_id", "url", (1704067200 + 60 * minute).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list made by rule from the pages' hosts, parent domains and first parts of paths: half of them enter it, most
    leave it again."""
    names = pages.select(F.explode(url_filter.keys_of(F.col("url"))).alias("entry")).distinct()
    number = lambda a: F.conv(F.substring(F.md5(F.concat(F.lit("l"), F.col("entry"))), a, 4), 16, 10).cast("long")
    listed = names.where(number(1) < 32768)
    added = listed.select("entry", F.lit("add").alias("action"), (1704067200 + 60 * number(5)).alias("at"))
    removed = listed.where(number(13) < 49152).select("entry", F.lit("remove").alias("action"), (1704067200 + 60 * (number(5) + number(9))).alias("at"))
    return added.unionByName(removed)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return url_filter.filter_captures(captures_of(pages), entries_of(pages))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.domain_of(docs), mixing.WEIGHTS, mixing.SHARE, mixing.EPOCHS, mixing.ORDER_SEED).drop("row")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("row")


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(_read(spark, sf_dir, "documents"), PII_KEY)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.learn_and_identify(_read(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(_read(spark, sf_dir, "documents"), k=3, percent=90)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(_read(spark, sf_dir, "documents")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return line_dedup.digest(docs, line_dedup.keep_bitmaps(docs))


def moment_of() -> Column:
    """A click's ts, moved back by some years for an eighth of the click_ids and to Monday 00:00 for another."""
    ts, k = F.col("ts").cast("timestamp_ntz"), F.crc32(F.col("click_id").cast("string")) % 128
    back = ts - F.make_dt_interval(days=((k + 6) * (k + 6) * (k + 6)).cast("int"))
    monday = F.date_sub(ts.cast("date"), F.weekday(ts)).cast("timestamp_ntz")
    return F.when(k < 16, back).when(k > 111, monday).otherwise(ts)


def partitioned_twice(clicks: DataFrame, until: str, folder: str) -> DataFrame:
    """The files of all clicks, laid over those of the clicks that had arrived before `until`."""
    limit, order = 1 + clicks.count() // 500, ("arrived_at", "click_id")
    early = F.col("arrived_at") < F.lit(until).cast("timestamp_ntz")
    moment = moment_of()
    first = time_partitions.lay_out(clicks.where(early), moment, order, limit, folder)
    files = time_partitions.lay_out(clicks, moment, order, limit, folder, first, early)
    return time_partitions.read_back(files, folder, clicks, "click_id").select("leaf", "part", "n_rows", "n_new", "columns", "ids_sha256", "path", "rewritten")


def op11_time_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitioned_twice(_read(spark, sf_dir, "clicks"), "2024-05-01 00:00:00", new_folder(spark, "op11"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "op12")
    token_files.encode_corpus(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return token_files.digest(token_files.decode_corpus(spark, folder))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_secret_scan, op2_url_filter, op3_source_mixing, op4_decontamination, op5_pii_surrogates, op6_language_id, op7_quality_rules, op8_jaccard_join, op9_substring_dedup, op10_line_dedup, op11_time_partitions, op12_token_files, op13_filter_audit)
    }


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
