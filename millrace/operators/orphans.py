"""References to records that do not exist (yet, or any more) when the referring row is loaded.

The work is on *keys*: the distinct (reference, load time) pairs are held against the stretches of
time in which each parent key lives, by a left anti-join, and only the orphan keys are joined back
to the rows. A key that a third of all rows refers to is one pair per load time after map-side
aggregation; in the join back it is the split side of an adaptive skew join, since the orphan keys
are unique. The references are given by the caller as narrow rows, so texts are never shuffled.

Defined results: null or id-less references are no references; an empty parent table makes every
reference an orphan; an empty source gives an empty result; rows repeated in a source count once
each through their position, references repeated inside a row count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REFERENCE = ("src_table", "src_pos", "ref_table", "ref_id", "at")


def references(df: DataFrame, src_table: str, ref_table: str, pos: Column, ids: Column, at: Column) -> DataFrame:
    """Distinct references of one table: one row per source row and id of the array ``ids``."""
    return (
        df.select(
            F.lit(src_table).alias("src_table"),
            pos.cast("long").alias("src_pos"),
            F.lit(ref_table).alias("ref_table"),
            F.explode(F.array_distinct(ids)).alias("ref_id"),
            at.alias("at"),
        )
        .where(F.col("ref_id").isNotNull())
    )


def lifetimes(ref_table: str, loads: DataFrame, removals: DataFrame | None = None) -> DataFrame:
    """(ref_table, ref_id, since, until) stretches in which each key is live; ``until`` is exclusive.

    ``loads`` and ``removals`` hold (ref_id, at). A load starts life at its time, a later removal
    ends it at its own; at the same time the removal comes first, so the load wins.
    """
    if removals is None:
        born = loads.where("ref_id is not null and at is not null").groupBy("ref_id").agg(F.min("at").alias("since"))
        return born.select(F.lit(ref_table).alias("ref_table"), "ref_id", "since", F.lit(None).cast("timestamp").alias("until"))
    events = (
        loads.select("ref_id", "at", F.lit(1).alias("up"))
        .unionByName(removals.select("ref_id", "at", F.lit(0).alias("up")))
        .where("ref_id is not null and at is not null")
        .distinct()  # repeated rows of a hot key fold before the sort
    )
    w = Window.partitionBy("ref_id").orderBy("at", "up")
    turns = events.withColumn("was", F.lag("up", 1, 0).over(w)).where("up <> was")
    return (
        turns.withColumn("until", F.lead("at").over(w))
        .where("up = 1")
        .select(F.lit(ref_table).alias("ref_table"), "ref_id", F.col("at").alias("since"), "until")
    )


def orphan_references(refs: DataFrame, lives: DataFrame) -> DataFrame:
    """The rows of ``refs`` whose key is not live at the time the referring row was loaded.

    A reference whose own load time is null can't be placed in time and counts as an orphan only
    if its key never lives.
    """
    keys = refs.select("ref_table", "ref_id", "at").distinct()
    k, v = keys.alias("k"), lives.alias("v")
    live = (
        (F.col("k.ref_table") == F.col("v.ref_table"))
        & (F.col("k.ref_id") == F.col("v.ref_id"))
        & (F.col("k.at").isNull() | ((F.col("v.since") <= F.col("k.at")) & (F.col("v.until").isNull() | (F.col("k.at") < F.col("v.until")))))
    )
    orphans = k.join(v, live, "left_anti")
    r, o = refs.alias("r"), orphans.alias("o")
    back = (
        (F.col("r.ref_id") == F.col("o.ref_id"))
        & (F.col("r.ref_table") == F.col("o.ref_table"))
        & F.col("r.at").eqNullSafe(F.col("o.at"))
    )
    return r.join(o, back, "left_semi")


def orphan_report(refs: DataFrame, orphans: DataFrame, period: str = "month") -> DataFrame:
    """References and orphans per source table, referenced table and period of the load time.

    ``period`` is a unit of ``date_trunc`` of a day or longer. References without a load time are
    counted under a null period.
    """
    utc = F.to_utc_timestamp("at", F.current_timezone())  # periods are UTC, whatever zone the session shows
    shape = {"year": "yyyy", "month": "yyyy-MM"}.get(period, "yyyy-MM-dd")
    names = ("src_table", "ref_table", F.date_format(F.date_trunc(period, utc), shape).alias("period"))
    both = refs.select(*names, F.lit(0).alias("o")).unionByName(orphans.select(*names, F.lit(1).alias("o")))
    return both.groupBy("src_table", "ref_table", "period").agg(
        F.sum(1 - F.col("o")).cast("long").alias("n_references"), F.sum("o").cast("long").alias("n_orphans")
    )
