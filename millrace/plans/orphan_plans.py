"""Problem 1 on the project's tables: image references of texts and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import jsonx
from millrace.operators import orphans
from millrace.sources.tables import table


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    text, labels = table(spark, sf_dir, "wiki_text"), table(spark, sf_dir, "image_labels")
    images, removals = table(spark, sf_dir, "images"), table(spark, sf_dir, "image_removals")
    ids = jsonx.image_ids(jsonx.fields(F.col("info"), "image_ids")["image_ids"])
    one = F.array_compact(F.array(jsonx.image_id(F.col("id"))))
    pos, at = F.col("pos"), F.col("ingested_at")
    # The id lists are parsed once and pointed at both parents
    from_text = orphans.references(text, "wiki_text", "images", pos, ids, at)
    both = from_text.withColumn("ref_table", F.explode(F.array(F.lit("images"), F.lit("image_labels"))))
    refs = both.unionByName(orphans.references(labels, "image_labels", "images", pos, one, at))
    key = lambda t, when: t.select(jsonx.image_id(F.col("id")).alias("ref_id"), F.col(when).alias("at"))
    lives = orphans.lifetimes("images", key(images, "ingested_at"), key(removals, "removed_at")).unionByName(
        orphans.lifetimes("image_labels", key(labels, "ingested_at"))
    )
    return refs, lives


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, lives = _inputs(spark, sf_dir)
    return orphans.orphan_references(refs, lives).select("src_table", "src_pos", "ref_table", "ref_id")


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, lives = _inputs(spark, sf_dir)
    return orphans.orphan_report(refs, orphans.orphan_references(refs, lives))


_REFS = r"""
with parents as (
  select 'images' as ref_table, nullif(regexp_extract(lower(id), '[0-9a-f]{64}'), '') as ref_id, ingested_at as seen from images
  union select 'image_labels', nullif(regexp_extract(lower(id), '[0-9a-f]{64}'), ''), ingested_at from image_labels),
gone as (select nullif(regexp_extract(lower(id), '[0-9a-f]{64}'), '') as ref_id, removed_at from image_removals),
named as (
  select distinct pos, ingested_at, unnest(regexp_extract_all(lower(ids), '[0-9a-f]{64}')) as ref_id
  from (select pos, ingested_at, cast(case when json_valid(info) and json_type(info) = 'OBJECT' then json_extract(info, '$.image_ids') end as varchar) as ids from wiki_text)),
refs as (
  select 'wiki_text' as src_table, pos as src_pos, 'images' as ref_table, ref_id, ingested_at as seen from named
  union all select 'wiki_text', pos, 'image_labels', ref_id, ingested_at from named
  union all select 'image_labels', pos, 'images', regexp_extract(lower(id), '[0-9a-f]{64}'), ingested_at from image_labels
    where regexp_extract(lower(id), '[0-9a-f]{64}') <> ''),
keys as (select distinct ref_table, ref_id, seen from refs),
latest as (select k.ref_table, k.ref_id, k.seen, max(p.seen) as loaded from keys k join parents p
  on p.ref_table = k.ref_table and p.ref_id = k.ref_id and p.seen <= k.seen group by 1, 2, 3),
live as (select * from latest l where not (l.ref_table = 'images' and exists (
  select 1 from gone g where g.ref_id = l.ref_id and g.removed_at > l.loaded and g.removed_at <= l.seen))),
orphans as (select r.* from refs r left join live l on l.ref_table = r.ref_table and l.ref_id = r.ref_id and l.seen = r.seen where l.seen is null)
"""

SQL = {
    "p1_found": _REFS + "select src_table, src_pos, ref_table, ref_id from orphans",
    "p1_report": _REFS
    + """select src_table, ref_table, period, count(*) filter (where o = 0) as n_references, count(*) filter (where o = 1) as n_orphans
from (select src_table, ref_table, strftime(seen at time zone 'UTC', '%Y-%m') as period, 0 as o from refs
      union all select src_table, ref_table, strftime(seen at time zone 'UTC', '%Y-%m'), 1 from orphans) group by 1, 2, 3""",
}
QUERIES = {"p1_found": p1_found, "p1_report": p1_report}
