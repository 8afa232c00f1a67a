"""Problem 5 on the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import lookalikes
from millrace.sources.tables import materialize, spread, table


def _text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "wiki_text").select("pos", "data"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = materialize(lookalikes.looks(_text(spark, sf_dir), "pos", "data"), "looks")
    return lookalikes.same_look_pairs(keys)


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.look_classes(materialize(lookalikes.looks(_text(spark, sf_dir), "pos", "data"), "looks"))


def p5_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.consistent_form(_text(spark, sf_dir), "pos", "data")


QUERIES = {"p5_found": p5_found, "p5_classes": p5_classes, "p5_form": p5_form}
SQL: dict[str, str] = {}
