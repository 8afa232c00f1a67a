"""Numbers within groups, without any task holding a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[str], part: Column, *order: str) -> DataFrame:
    """``df`` with ``rank``, 0, 1, 2 ... within each group of ``keys``, in the order of (part, order).

    Parts of a group are numbered apart and shifted by the sizes of the parts before them, so a hot
    group is shared by as many tasks as it has parts. How finely ``part`` cuts changes no number as
    long as it follows the order. ``order`` has to tell the rows of a group apart.
    """
    cut = df.withColumn("_part", part.cast("long"))
    sizes = cut.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row per part
    shift = sizes.select(*keys, "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys] + [F.col("a._part") == F.col("b._part")]
    on = same[0]
    for c in same[1:]:
        on = on & c
    rows = cut.withColumn("_own", own).alias("a").join(shift.alias("b"), on)
    return rows.select(*[F.col(f"a.{c}") for c in df.columns], (F.col("b._before") + F.col("a._own") - 1).alias("rank"))


def drawn(df: DataFrame, keys: list[str], spread: Column, tie: list[str], bits: int = 6) -> DataFrame:
    """``df`` with ``rank`` within each group of ``keys`` in the order of ``spread``, a hash, then of ``tie``.

    Cut by the highest ``bits`` bits of the hash: any number of them gives the same order, so the
    numbers depend on the rows of the group alone.
    """
    rows = df.withColumn("_spread", spread)
    return ranked(rows, keys, F.shiftright("_spread", 64 - bits), "_spread", *tie).drop("_spread")


def bits_for(rows: int, per_task: int = 1_000_000) -> int:
    """Bits enough for a group that holds all rows to come in pieces of about ``per_task``."""
    return max(3, (max(rows, 1) // per_task).bit_length())
