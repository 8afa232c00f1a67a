"""Problems 6 and 7 on the project's tables: ``documents`` measured in tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import mixing, packing, tokens
from millrace.sources.tables import materialize, spread, table


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return materialize(tokens.token_counts(docs, F.col("text"), F.col("doc_id"), F.col("source")), "token-sizes")


def _shapes(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """Three rows, the same at every scale."""
    return [(r["shape_id"], r["capacity_tokens"]) for r in table(spark, sf_dir, "pack_shapes").collect()]


def p6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_sizes(spark, sf_dir), _shapes(spark, sf_dir))


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per shape: containers, the least number that could do, and the room left over."""
    shapes = _shapes(spark, sf_dir)
    placed = packing.pack(_sizes(spark, sf_dir), shapes)
    bins = placed.groupBy("shape_id", "container_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("k"))
    cap = spark.createDataFrame(shapes, "shape_id int, capacity_tokens long")
    return (
        bins.groupBy("shape_id")
        .agg(F.count(F.lit(1)).alias("n_containers"), F.sum("t").alias("n_tokens"), F.sum("k").alias("n_items"), F.max("t").alias("fullest"))
        .join(cap, "shape_id")
        .withColumn("least_containers", F.ceil(F.col("n_tokens") / F.col("capacity_tokens")))
        .withColumn("fill", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6))
    )


def _targets(spark: SparkSession, sf_dir: str) -> list[tuple[str, float, int]]:
    """Nine rows, the same at every scale."""
    return [(r["source"], r["target_share"], r["max_repeats"]) for r in table(spark, sf_dir, "mix_targets").orderBy("source").collect()]


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sizes(spark, sf_dir), _targets(spark, sf_dir), seed=7)[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: target and reached share, tokens, documents and the most repeats."""
    targets = _targets(spark, sf_dir)
    used, draws = mixing.mix(_sizes(spark, sf_dir), targets, seed=7)
    by = used.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("n_documents"), F.max("repeats").alias("most_repeats")
    )
    want = spark.createDataFrame([(s, w, m, d.budget) for (s, w, m), d in zip(targets, draws)], "source string, target_share double, max_repeats int, budget_tokens long")
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # over a row per source
    return (
        want.join(by, "source", "left")
        .select(
            "source", "target_share", "max_repeats", "budget_tokens",
            F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
            F.round(F.coalesce("tokens", F.lit(0)) / whole, 6).alias("reached_share"),
        )
    )


QUERIES = {"p6_pack": p6_pack, "p6_fill": p6_fill, "p7_mix": p7_mix, "p7_shares": p7_shares}
SQL: dict[str, str] = {}
