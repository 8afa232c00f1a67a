"""Problem 8 on the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import spam
from millrace.sources.tables import materialize, spread, table


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return spam.spam_scores(materialize(spam.vectors(docs, F.col("doc_id"), F.col("lang"), F.col("text")), "spam-vectors"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).where("spam").select("doc_id")


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("doc_id", "lang", F.round("d2", 3).alias("d2"), F.round("s2", 3).alias("s2"), "spam")


QUERIES = {"p8_found": p8_found, "p8_scores": p8_scores}
SQL: dict[str, str] = {}
