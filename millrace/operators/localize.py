"""Image references of pages rewritten to dataset-local ids. O043-O050.

Pages are read once for what they show and name, as narrow rows, and these are stored. What a page
shows meets the labels on (image id, normalized url): each url beside each id the page names, so a
pair of page and label that can't match never meets, however many images share a url. Labels are
folded to one row per image id and url first, which makes them the unique side, so an image with a
tenth of all label rows, or a logo on a third of all pages, is split by adaptive execution. Page text
moves in one join only, the last, with the map of its own references.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import jsonx, pages, urls
from millrace.sources.tables import materialize


def distinct_in_order(values: Column) -> Column:
    """Non-empty values, first occurrence kept (O043, O044)."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def candidate_urls(info: Column) -> Column:
    """Urls a label names its image by: the original one before the current one (O046)."""
    f = jsonx.fields(info, "image_url_ori", "image_url")
    return F.coalesce(distinct_in_order(F.array(f["image_url_ori"], f["image_url"])), F.array().cast("array<string>"))


def label_urls(labels: DataFrame) -> DataFrame:
    """(image_id, url, raw_url, rank) per image id and distinct normalized url; rank is the first place it is named at."""
    rows = labels.select(jsonx.image_id(F.col("id")).alias("image_id"), "pos", F.posexplode(candidate_urls(F.col("info"))).alias("k", "raw_url"))
    rows = rows.withColumn("url", urls.normalize(F.col("raw_url"))).where("image_id is not null and url <> ''")
    first = F.min(F.struct("pos", "k", "raw_url"))
    return rows.groupBy("image_id", "url").agg(first.alias("f")).select("image_id", "url", F.col("f.raw_url").alias("raw_url"), F.struct("f.pos", "f.k").alias("rank"))


@dataclass
class Localized:
    """Lazy results of one rewrite.

    ``text``: pos, id, info ids and rewritten data. ``missing``: image urls of pages no label of the
    page's images names, one row per occurrence. ``unmatched``: image ids of pages without any url
    (``image_id_no_candidate_urls``) or with none that the page shows
    (``image_id_not_matched_to_html_url``). ``url_map``: the image each page's url leads to.
    """

    text: DataFrame
    missing: DataFrame
    unmatched: DataFrame
    url_map: DataFrame

    def counters(self) -> DataFrame:
        """rows, rewritten_rows, rewritten_images, missing_urls, unmatched_image_ids in one row."""
        t = self.text.agg(
            F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("rewritten").cast("long")), F.lit(0)).alias("rewritten_rows"), F.coalesce(F.sum("n_used"), F.lit(0)).alias("rewritten_images")
        )
        m = self.missing.agg(F.count(F.lit(1)).alias("missing_urls"))
        u = self.unmatched.agg(F.count(F.lit(1)).alias("unmatched_image_ids"))
        one = lambda d: d.withColumn("_one", F.lit(1))
        return one(t).join(one(m), "_one").join(one(u), "_one").drop("_one")  # three single rows


def localize(text: DataFrame, labels: DataFrame) -> Localized:
    """Rewrite the image tags of ``text`` (pos, id, info, data) to the images its ``info`` names.

    A page names images in ``info.image_ids``; a label names urls. The first image (order of the
    page's list, then of the label rows, then original before current url) wins a url. Pages with
    broken info name no image; null data stays null.
    """
    f = jsonx.fields(F.col("info"), "image_ids", "url", "final_url")
    rows = text.select("pos", F.col("id").alias("text_id"), "data", f.alias("f")).select(
        "pos", "text_id", "data",
        F.array_distinct(jsonx.image_ids(F.col("f.image_ids"))).alias("ids"),
        F.coalesce(F.nullif("f.url", F.lit("")), F.nullif("f.final_url", F.lit("")), F.lit("")).alias("html_url"),
        F.coalesce(pages.img_sources(F.col("data")), F.array().cast("array<string>")).alias("sources"),
    )
    narrow = materialize(rows.drop("data"), "page-images")
    shown = narrow.select("pos", "text_id", "html_url", "ids", F.posexplode("sources").alias("k", "raw_url")).withColumn("url", urls.normalize(F.col("raw_url")))
    named = materialize(label_urls(labels), "label-urls")
    asks = shown.select("pos", "url", "raw_url", "ids").distinct().select("pos", "url", "raw_url", F.posexplode("ids").alias("id_pos", "image_id"))
    met = materialize(
        asks.join(named.select("url", "image_id", "rank"), ["image_id", "url"]).select("pos", "url", "raw_url", "image_id", F.struct("id_pos", "rank").alias("place")), "pages-met"
    )
    url_map = met.groupBy("pos", "url").agg(F.min_by("image_id", "place").alias("image_id"), F.collect_set("raw_url").alias("raws"))
    missing = shown.join(url_map.select("pos", "url"), ["pos", "url"], "left_anti").select("pos", "text_id", "html_url", F.col("raw_url").alias("image_url_raw"), F.col("url").alias("image_url_normalized"), "k")
    asked = narrow.select("pos", "text_id", "html_url", F.explode("ids").alias("image_id"))
    alone = asked.join(met.select("pos", "image_id").distinct(), ["pos", "image_id"], "left_anti")
    known = named.select("image_id").distinct().withColumn("known", F.lit(True))
    unmatched = alone.join(known, "image_id", "left").select(
        F.when(F.col("known"), "image_id_not_matched_to_html_url").otherwise("image_id_no_candidate_urls").alias("type"), "pos", "text_id", "html_url", "image_id"
    )
    pairs = url_map.select("pos", F.explode("raws").alias("raw"), "image_id")
    refs = pairs.groupBy("pos").agg(F.map_from_entries(F.collect_list(F.struct("raw", urls.image_ref(F.col("image_id"))))).alias("refs"))
    used = F.size(F.filter("sources", lambda s: F.coalesce(F.map_contains_key(F.col("refs"), s), F.lit(False))))
    page = narrow.select("pos", "text_id", "ids", "sources").join(refs, "pos", "left")
    page = page.select("pos", "text_id", "ids", "refs", F.when(F.col("refs").isNull(), 0).otherwise(used).cast("long").alias("n_used"))
    done = text.select("pos", "data").join(page, "pos").withColumn("new", pages.rewrite_images(F.col("data"), F.col("refs")))
    out = done.select("pos", "text_id", F.col("ids").alias("image_ids"), F.col("new").alias("data"), (F.coalesce(F.col("new") != F.col("data"), F.lit(False))).alias("rewritten"), "n_used")
    return Localized(out, missing, unmatched, url_map.drop("raws"))
