"""Problem 3 on the project's tables: the page rows of ``wiki_text``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import jsonx
from millrace.llm import boilerplate
from millrace.sources.tables import spread, table


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = jsonx.fields(F.col("info"), "format", "url", "title")
    rows = table(spark, sf_dir, "wiki_text").select("pos", "data", info.alias("i")).where("i is not null")
    fmt = F.lower(F.trim(F.col("i.format")))
    site = F.lower(F.regexp_extract("i.url", r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\s]+)", 1))
    return spread(rows.where(fmt.isin("html", "txt")).select("pos", site.alias("site"), F.col("i.title").alias("title"), (fmt == "html").alias("is_html"), "data"))


def _columns():
    return [F.col(c) for c in ("pos", "site", "title", "is_html", "data")]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.furniture(_pages(spark, sf_dir), *_columns(), table(spark, sf_dir, "wiki_text").count())


def p3_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_text(_pages(spark, sf_dir), *_columns(), table(spark, sf_dir, "wiki_text").count())


QUERIES = {"p3_found": p3_found, "p3_text": p3_text}
SQL: dict[str, str] = {}
