"""Problem 4 on the project's tables: the body rows of ``wiki_text``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import jsonx
from millrace.llm import markup
from millrace.sources.tables import spread, table


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = jsonx.fields(F.col("info"), "format", "url")
    rows = table(spark, sf_dir, "wiki_text").select("pos", "data", info.alias("i")).where("i is not null")
    fmt = F.lower(F.trim(F.coalesce("i.format", F.lit(""))))
    host = F.lower(F.regexp_extract("i.url", r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\s]+)", 1))
    return spread(rows.where(~fmt.isin("html", "txt")).select("pos", host.alias("host"), "data"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bodies(spark, sf_dir)
    return markup.markup_cases(b, F.col("pos"), F.col("host"), F.col("data"))


def p4_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bodies(spark, sf_dir)
    return markup.clean_text(b, F.col("pos"), F.col("host"), F.col("data"))


QUERIES = {"p4_found": p4_found, "p4_text": p4_text}
SQL: dict[str, str] = {}
