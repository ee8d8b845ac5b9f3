"""The library in SQL: its tables as views and its text functions as SQL functions.

The functions' bodies are the SQL of the same column expressions that the DataFrame operators use, so Catalyst sees through
them and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..sources.readers import sort_key

TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "events")
#: Name: what it returns and its body over the argument s.
FUNCTIONS = {
    "strip_text": ("STRING", text.strip),
    "safe_filename": ("STRING", text.safe_filename),
    "parse_marker": ("STRUCT<role: STRING, name: STRING>", text.parse_marker),
    "parse_date": ("STRING", dates.parse_date),
    "sort_key": ("STRUCT<day: STRING, number: DECIMAL(38, 0)>", sort_key),
    "last_part": ("STRING", text.last_part),
}


def register_functions(spark: SparkSession) -> None:
    """Makes FUNCTIONS known to the session, as temporary functions of one string."""
    for name, (returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS {returns} RETURN {spark._jsparkSession.expression(body(F.col("s"))._jc).sql()}")


def register(spark: SparkSession, folder: str, tables: tuple[str, ...] = TABLES) -> None:
    """The functions, and a view of each of a folder's tables (name.parquet)."""
    register_functions(spark)
    for name in tables:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)


#: One query for each function.
QUERIES = {
    "sql_strip_text": "SELECT doc_id, length(strip_text(concat('　', text, ' \n'))) AS n_chars FROM documents",
    "sql_safe_filename": "SELECT page_id, safe_filename(url) AS file_name FROM pages",
    "sql_parse_marker": "SELECT conv_id, turn, m.role AS title, m.name AS name FROM (SELECT conv_id, turn, parse_marker(concat(if(turn % 2 = 0, '議長（', ' '), role, conv_id, if(turn % 2 = 0, '君） ', if(turn % 3 = 0, '君', '')))) AS m FROM conversations)",
    "sql_parse_date": "SELECT doc_id, parse_date(concat('自 昭和', if(doc_id % 3 = 0, '元', translate(CAST(doc_id % 60 + 1 AS STRING), '0123456789', '０１２３４５６７８９')), '年 ', doc_id % 12 + 1, '月', doc_id % 28 + 1, if(doc_id % 5 = 0, '', '日'))) AS day FROM documents",
    "sql_sort_key": "SELECT doc_id, k.day AS day, CAST(k.number AS BIGINT) AS number FROM (SELECT doc_id, sort_key(concat(20240101 + doc_id % 28, '_', lang, '_', doc_id, '.json')) AS k FROM documents)",
    "sql_last_part": "SELECT last_part(url) AS name, count(*) AS n FROM pages GROUP BY last_part(url)",
}
ORACLES = {
    "sql_strip_text": r"SELECT doc_id, length(regexp_replace(regexp_replace(text, '^[\s\x0B\x1C-\x1F\x{85}\p{Z}]+', ''), '[\s\x0B\x1C-\x1F\x{85}\p{Z}]+$', ''))::INT AS n_chars FROM documents",
    "sql_safe_filename": r"""SELECT page_id, trim(regexp_replace(url, '[\\/:*?"<>|]', '_', 'g')) AS file_name FROM pages""",
    "sql_parse_marker": "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '議長' END AS title, role || conv_id AS name FROM conversations",
    "sql_parse_date": "SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN printf('%04d-%02d-%02d', 1926 + CASE WHEN doc_id % 3 = 0 THEN 0 ELSE doc_id % 60 END, doc_id % 12 + 1, doc_id % 28 + 1) END AS day FROM documents",
    "sql_sort_key": "SELECT doc_id, (20240101 + doc_id % 28)::VARCHAR AS day, doc_id AS number FROM documents",
    "sql_last_part": "SELECT list_last(string_split(url, '/')) AS name, count(*) AS n FROM pages GROUP BY 1",
}


def query(name: str):
    """A query of QUERIES as a function of the session and the folder of the tables."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        register(spark, folder)
        return spark.sql(QUERIES[name])

    return run
