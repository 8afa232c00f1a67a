"""Expressions over raw page HTML. O033, O038, O039, O042, O086, O093, O167, O174, O196."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.functions.fixed import CANONICAL, CATEGORY, CJK, FRONT_MATTER, IMG, INVISIBLE, SITE_IN_TITLE, SKIPPED_CATEGORIES, SRC, STUBS, TITLE, WIKI_HOSTS


def img_sources(html: Column) -> Column:
    """``src`` of every image tag that has one, in document order, repeats kept."""
    tags = F.regexp_extract_all(html, F.lit(IMG), F.lit(0))
    return F.filter(F.transform(tags, lambda t: F.regexp_extract(t, SRC, 1)), lambda s: s != "")


def title(html: Column) -> Column:
    raw = F.regexp_replace(F.regexp_extract(html, TITLE, 1), r"(?U)^\s+|\s+$", "")
    return F.nullif(F.regexp_replace(raw, SITE_IN_TITLE, ""), F.lit(""))


def canonical_url(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, CANONICAL, 1), F.lit(""))


def categories(html: Column) -> Column:
    """Category links as tags, maintenance categories left out, in order, repeats kept."""
    found = F.regexp_extract_all(html, F.lit(CATEGORY), F.lit(1))
    names = F.transform(found, lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))

    def wanted(c: Column) -> Column:
        skip = F.lit(False)
        for p in SKIPPED_CATEGORIES:
            skip = skip | F.startswith(c, F.lit(p))
        return ~skip

    return F.transform(F.filter(names, wanted), lambda c: F.replace(c, F.lit("&amp;"), F.lit("&")))


def rewrite_images(html: Column, refs: Column) -> Column:
    """Image tags whose raw ``src`` is a key of the map ``refs`` point to its value and lose ``srcset``.

    Equal sources have equal targets, so the map does what a queue per source would. Only the first
    ``src`` of a tag changes; all else stays as it is, byte for byte.
    """
    between = F.split(html, IMG, -1)
    tags = F.regexp_extract_all(html, F.lit(IMG), F.lit(0))

    def changed(tag: Column) -> Column:
        bare = F.regexp_replace(tag, r"(?i)\s*\bsrcset=[\"'][^\"']*[\"']", "")
        ref = F.try_element_at(refs, F.regexp_extract(tag, SRC, 1))
        cut = r"(?is)^(.*?\bsrc=[\"'])[^\"']+([\"'].*)$"
        return F.when(ref.isNull(), tag).otherwise(F.concat(F.regexp_extract(bare, cut, 1), ref, F.regexp_extract(bare, cut, 2)))

    new = F.concat(F.transform(tags, changed), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(between, new, lambda a, b: F.concat(a, b)), "")
    return F.when((F.size(tags) == 0) | F.coalesce(F.size(refs) <= 0, F.lit(True)), html).otherwise(whole)


def host_refs(html: Column, ids_by_url: Column, host: str = r"upload\.wikimedia\.org") -> Column:
    """Map for ``rewrite_images`` of the sources on one host whose normalized url has an image id (O036, O037)."""
    known = F.filter(F.array_distinct(img_sources(html)), lambda s: s.rlike(f"(?i){host}") & F.map_contains_key(ids_by_url, urls.normalize(s)))
    return F.map_from_arrays(known, F.transform(known, lambda s: urls.image_ref(F.try_element_at(ids_by_url, urls.normalize(s)))))


def is_wiki_url(url: Column) -> Column:
    return F.coalesce(url.rlike(WIKI_HOSTS), F.lit(False))


def is_stub_category(name: Column) -> Column:
    return F.coalesce(name.rlike(STUBS), F.lit(False))


def is_cjk(text: Column) -> Column:
    """More than half as many Chinese, Japanese or Korean characters as letters."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.coalesce((letters > 0) & (F.regexp_count(text, F.lit(CJK)) > letters * 0.5), F.lit(False))


def without_invisible(text: Column) -> Column:
    """Zero-width and directional characters and byte order marks removed."""
    return F.regexp_replace(text, INVISIBLE, "")


def without_front_matter(markdown: Column) -> Column:
    """A leading block between ``---`` lines removed; later ones are text."""
    return F.regexp_replace(markdown, FRONT_MATTER, "")


def normal_whitespace(markdown: Column) -> Column:
    """Blank lines emptied, runs of them cut to one, common entities and line-break tags resolved (O158)."""
    t = F.regexp_replace(markdown, r"(?m)^[ \t ]+$", "")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.regexp_replace(t, r"(?i)<br\s*/?>", "")
    return F.regexp_replace(t, r"^\n+", "")
