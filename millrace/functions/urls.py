"""URL and image-reference expressions. O032, O040, O041, O046, O083, O095-O103, O122, O197."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.fixed import IMAGE_ENDINGS, SOCIAL_HOSTS, THUMB

def unquote(text: Column) -> Column:
    """Percent-decoding where a plus stays a plus and a stray percent sign stays as it is."""
    guarded = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(F.contains(text, F.lit("%")), F.url_decode(guarded)).otherwise(text)


def normalize(url: Column) -> Column:
    """Scheme and leading slashes off, decoded, a thumbnail path replaced by that of its original."""
    plain = unquote(F.ltrim(F.regexp_replace(url, "(?i-i)^https?:", ""), F.lit("/")))
    return F.regexp_replace(plain, THUMB, "/$1")


def image_ref(image_id: Column) -> Column:
    """The dataset-local reference of an image."""
    return F.concat(F.lit("images/"), image_id)


def local_image_id(href: Column) -> Column:
    """Image id of a dataset-local reference; null for anything else."""
    s = F.regexp_replace(F.regexp_replace(href, r"(?U)^\s+|\s+$", ""), r"^\./", "")
    rest = F.split_part(F.split_part(F.substring(s, 8, 1 << 30), F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    return F.when(F.startswith(s, F.lit("images/")), F.nullif(F.trim(rest, F.lit("/")), F.lit("")))


def is_relative(url: Column) -> Column:
    """Neither a fragment nor with a scheme or host of its own."""
    return ~F.coalesce(url.rlike(r"^(?:#|data:|mailto:|tel:|javascript:|https?://|//)"), F.lit(True)) & (url != "")


def is_social(href: Column) -> Column:
    """One of the social hosts stands anywhere in the link."""
    hit = F.lit(False)
    for d in SOCIAL_HOSTS:
        hit = hit | F.contains(href, F.lit(d))
    return F.coalesce(hit, F.lit(False))


def is_print(href: Column, title: Column) -> Column:
    return F.coalesce(F.contains(F.lower(href), F.lit("print")), F.lit(False)) | F.coalesce(F.contains(F.lower(title), F.lit("print")), F.lit(False))


def is_image_file(href: Column) -> Column:
    return F.coalesce(F.lower(F.split_part(href, F.lit("?"), F.lit(1))).rlike(rf"\.(?:{'|'.join(IMAGE_ENDINGS)})$"), F.lit(False))


def best_of_srcset(srcset: Column) -> Column:
    """Url of the widest entry; the first entry where no widths are given (O124)."""
    entries = F.transform(F.filter(F.split(srcset, ","), lambda e: F.trim(e) != ""), lambda e: F.split(F.trim(e), r"\s+"))
    ranked = F.transform(
        entries,
        lambda e, i: F.struct(F.coalesce(F.regexp_extract(F.try_element_at(e, F.lit(2)), r"^(\d+)w$", 1).try_cast("int"), F.lit(0)).alias("w"), (-i).alias("i"), e[0].alias("u")),
    )
    return F.array_max(ranked)["u"]
