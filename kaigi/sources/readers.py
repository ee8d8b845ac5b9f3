"""Readers with explicit schemas; a missing input raises FileNotFoundError."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import attribute, start_tags
from ..functions.text import last_part, printable_ratio, resolve_url, strip, unix_lines
from .meeting_api import get_bytes, get_json

SPEECH = "struct<speaker:string,speakerRole:string,speakerGroup:string,speech:string>"
MEETING = f"session string, nameOfHouse string, nameOfMeeting string, issue string, issueID string, date string, speechRecord array<{SPEECH}>"
MEMBERS = "members array<struct<name:string,kana:string,gender:string,terms:array<struct<term:int,party:string,faction:string>>>>"
UPLOADS = "session_name string, file_id string"


def require(spark: SparkSession, path: str) -> str:
    """The path, if it exists in whatever store it names."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop):
        raise FileNotFoundError(path)
    return path


def meetings(spark: SparkSession, folder: str) -> DataFrame:
    """Meeting files with file_name and _corrupt (set for files that are no JSON; filter or count them as the caller needs)."""
    raw = spark.read.text(require(spark, folder), wholetext=True).select("value", F.col("_metadata.file_name").alias("file_name"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return raw.select(F.from_json("value", f"{MEETING}, _corrupt string", options).alias("m"), "file_name").select("m.*", "file_name")


def sort_key(file_name: F.Column) -> F.Column:
    """struct(day, number): the part before the first underscore and the digits at the end of the stem, 0 if there are none."""
    stem = F.regexp_replace(file_name, r"\.[^.]*$", "")
    return F.struct(F.split_part(stem, F.lit("_"), F.lit(1)).alias("day"), F.coalesce(F.nullif(F.regexp_extract(stem, r"(\d+)$", 1), F.lit("")).try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias("number"))


def member_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MEMBERS).option("multiLine", True).json(require(spark, path))


def upload_log(spark: SparkSession, path: str) -> DataFrame:
    """What was sent before; an empty table where nothing was."""
    try:
        return spark.read.schema(UPLOADS).parquet(require(spark, path))
    except FileNotFoundError:
        return spark.createDataFrame([], UPLOADS)


def corpus(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files: file_name, text with line ends made equal."""
    return spark.read.text(require(spark, path), wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), unix_lines(F.col("value")).alias("text"))


def body_lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no (from 0), line."""
    return texts.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def links(pages: DataFrame, suffix: str = ".pdf", url: str = "url", html: str = "html") -> DataFrame:
    """The pages' columns but html, href, target and file_name of every link whose reference ends with suffix; empty references
    are none."""
    rest = [c for c in pages.columns if c != html]
    found = linked(pages, {"a": "href"}, url, html).where(F.col("href").endswith(suffix))
    return found.select(*rest, "href", "target", last_part(F.col("href")).alias("file_name"))


#: What refers to something else, by its tag.
REFERENCES = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "source": "src"}


def linked(pages: DataFrame, kinds: dict[str, str] = REFERENCES, url: str = "url", html: str = "html") -> DataFrame:
    """The pages' columns but html, kind (the tag), href and target of everything that a page refers to."""
    rest = [c for c in pages.columns if c != html]
    wanted = F.filter(start_tags(F.col(html)), lambda t: t["tag"].isin(list(kinds)))
    value = F.coalesce(*(F.when(F.col("_t.tag") == tag, attribute(F.col("_t"), name)) for tag, name in kinds.items()))
    found = pages.select(*rest, F.explode(wanted).alias("_t")).select(*rest, F.col("_t.tag").alias("kind"), value.alias("href")).where("href <> ''")
    return found.select(*rest, "kind", "href", resolve_url(F.col(url), F.col("href")).alias("target"))


def pdf_pages(spark: SparkSession, folder: str, extract: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """path, pages: extract turns a file's bytes into page texts; by default PyMuPDF's, imported where it runs.  A file that
    can't be read has no pages."""

    def default(content: bytes) -> list[str]:
        import fitz

        with fitz.open(stream=content, filetype="pdf") as doc:
            return [page.get_text() for page in doc]

    read = extract or default

    def pages(content: pd.Series) -> pd.Series:
        def one(blob):
            try:
                return list(read(bytes(blob)))
            except ImportError:
                raise
            except Exception:
                return []

        return content.map(one)

    pages.__annotations__ = {"content": pd.Series, "return": pd.Series}
    files = spark.read.format("binaryFile").load(require(spark, folder))
    return files.select("path", F.pandas_udf(pages, "array<string>")("content").alias("pages")).orderBy("path")


def readable(documents: DataFrame) -> DataFrame:
    """path, first_page, full_text of documents with text whose first page is printable by half or more."""
    first = F.coalesce(F.try_element_at("pages", F.lit(1)), F.lit(""))
    found = documents.select("path", first.alias("first_page"), F.array_join("pages", "\n").alias("full_text"))
    return found.where((printable_ratio(F.col("first_page")) >= 0.5) & (F.length(strip(F.col("full_text"))) > 0))


def parsed_meetings(records: DataFrame) -> DataFrame:
    return records.select(F.from_json("record", MEETING).alias("m")).select("m.*")


def meeting_by_id(base: str) -> Callable[[str], dict | None]:
    """A lookup for full_meetings."""

    def fetch(issue: str) -> dict | None:
        found = get_json(f"{base.rstrip('/')}/meeting", {"issueID": issue, "recordPacking": "json"}).get("meetingRecord", [])
        return found[0] if found else None

    return fetch


def full_meetings(targets: DataFrame, fetch: Callable[[str], dict | None], pause: float = 0.5, tasks: int = 1) -> DataFrame:
    """The full records of the targets' issueID, one lookup each, with a pause after each; failures have no row.

    The pause holds for the service as a whole: each of several tasks waits as many times longer, so that more of them shorten
    slow answers and not the pauses."""

    def looked_up(batches):
        for batch in batches:
            found = []
            for issue in batch.issueID:
                try:
                    record = fetch(issue)
                except (OSError, ValueError):
                    record = None
                if record:
                    found.append((issue, json.dumps(record, ensure_ascii=False)))
                time.sleep(pause * tasks)
            yield pd.DataFrame(found, columns=["issueID", "record"])

    return parsed_meetings(targets.select("issueID").repartition(tasks).mapInPandas(looked_up, "issueID string, record string"))


#: Tried in this order where a page names no character set.
CHARSETS = ("utf-8", "cp932", "euc_jp")


def decoded(content: bytes, charset: str | None) -> str:
    """The text of a page: by the answer's character set, the one that the page names, or the first that fits."""
    named = re.search(rb"""<meta[^>]{0,200}?charset\s{0,9}=\s{0,9}["']?([\w\-]{1,40})""", content[:4096], re.I)
    for name in (charset, named and named[1].decode("ascii"), *CHARSETS):
        try:
            if name:
                return content.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return content.decode("utf-8", "replace")


def fetched_pages(urls: DataFrame, url: str = "url", fetch: Callable[[str], tuple[bytes, str | None]] = get_bytes, pause: float = 1.0, tasks: int = 1) -> DataFrame:
    """url, html of every address that answers; pause and tasks as in full_meetings."""

    def got(batches):
        for batch in batches:
            for address in batch[url]:
                try:
                    yield pd.DataFrame([(address, decoded(*fetch(address)))], columns=["url", "html"])
                except (OSError, ValueError):
                    continue
                time.sleep(pause * tasks)

    return urls.select(url).repartition(tasks).mapInPandas(got, "url string, html string")


def downloaded(found: DataFrame, fetch: Callable[[str], tuple[bytes, str | None]] = get_bytes, pause: float = 1.0, tasks: int = 1) -> DataFrame:
    """file_name, target, content of links whose target answers, one file at a time; sinks.save_files keeps them.  pause and tasks as
    in full_meetings."""

    def got(batches):
        for batch in batches:
            for name, target in zip(batch.file_name, batch.target, strict=True):
                try:
                    yield pd.DataFrame([(name, target, fetch(target)[0])], columns=["file_name", "target", "content"])
                except (OSError, ValueError):
                    continue
                time.sleep(pause * tasks)

    return found.select("file_name", "target").repartition(tasks).mapInPandas(got, "file_name string, target string, content binary")


def session_texts(spark: SparkSession, folder: str) -> DataFrame:
    """path, file_name, text of the session files, by path."""
    files = spark.read.text(require(spark, folder), wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text")).orderBy("path")
