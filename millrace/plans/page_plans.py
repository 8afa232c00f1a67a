"""Page parsing on the project's tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from millrace.functions import jsonx
from millrace.html import kernel
from millrace.sources import dataset, jsonl_tar
from millrace.sources.tables import shared_dir, spread, table


def _html(s, d):
    rows = table(s, d, "wiki_text")
    return spread(rows.where(jsonx.fields(F.col("info"), "format")["format"] == "html").select("pos", "id", "info", "data"))


def page_markdown(s, d):
    return kernel.parse_pages(_html(s, d), strict_info=False).select("pos", "data", F.col("_error").alias("error"))


def page_simple_html(s, d):
    return kernel.parse_pages(_html(s, d), out_format="html", strict_info=False).select("pos", "data", F.col("_error").alias("error"))


def page_meta(s, d):
    return kernel.page_metadata(_html(s, d))


def page_titles(s, d):
    """Title and canonical url of the kernel's metadata, which expressions can say too."""
    return kernel.page_metadata(_html(s, d).where("data is not null")).select("pos", "title", "url")


def page_captions(s, d):
    """Figures made of the label rows: their image, their caption as it is, and a blank caption where there is none."""
    f = jsonx.fields(F.col("info"), "caption", "image_url")
    escaped = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    page = F.concat(F.lit('<p>x<figure><a><img alt="picture" src="'), escaped(f["image_url"]), F.lit('"></a><figcaption>\n <i>'), escaped(f["caption"]), F.lit("</i> </figcaption></figure>"))
    return kernel.image_captions(table(s, d, "image_labels").select("pos", page.alias("data")))


#: A wiki page that every wiki rule has something to do on; @ and %% stand for a number and a name.
_WIKI = (
    '<html><head><title>N@ - Wikipedia</title></head><body><div class="mw-body-content"><table class="ambox"><tr><td>This needs sources @</td></tr></table>'
    '<table class="infobox"><tr><th>Name</th><td class="infobox-data">%%</td></tr><tr><td colspan="2"></td></tr><tr><th>Parts</th><td class="infobox-data"><ul><li>a@</li><li>b@</li></ul></td></tr>'
    '<tr><th>Box</th><td class="infobox-data"><table class="infobox-subbox"><tr><th>Inner</th><td>i@</td></tr></table></td></tr></table>'
    '<h2>Story<span class="mw-editsection">[edit]</span></h2><p>The record of %% has the number @, and it is kept in the archive of the harbour.<sup class="reference">[1]</sup></p>'
    '<p style="display:none">hidden @</p><p>It grows as <span class="mwe-math-element"><math><annotation encoding="application/x-tex">{\\displaystyle x_{@}}</annotation></math></span>.</p>'
    '<p><img src="//u.example/thumb/My_pic_@.jpg/250px-My_pic_@.jpg"></p><h3>Nothing</h3><h2>Places</h2><ul><li>one @</li><li> </li><li>two</li></ul>'
    '<div class="mw-heading mw-heading2"><h2>References</h2></div><ol><li>gone @</li></ol><h3>Below</h3><p>gone</p><h2>Legacy</h2><p>End of @.</p><h2>Notes</h2><p>gone</p></div></body></html>'
)


def _wiki_pages(s, d):
    says = {"@": F.col("doc_id").cast("string"), "%%": F.coalesce(F.col("source"), F.lit("nobody"))}
    cols = [says.get(piece, F.lit(piece)) for piece in re.split("(@|%%)", _WIKI)]
    info = F.lit('{"url": "https://en.wikipedia.org/wiki/N"}')
    return spread(table(s, d, "documents").select(F.col("doc_id").alias("pos"), info.alias("info"), F.concat(*cols).alias("data")))


def wiki_markdown(s, d):
    """Wiki rules of cleaner and converter, reference sections removed."""
    return kernel.parse_pages(_wiki_pages(s, d), remove_ref=True).select("pos", "data")


def _dump(s, d):
    """A dump written from the pages and images of the tables and read back."""
    pages = table(s, d, "wiki_text").select(F.col("data").alias("html"), F.lit(None).cast("string").alias("image_file"), F.lit(None).cast("binary").alias("image_bytes"))
    images = table(s, d, "images").select(F.lit(None).cast("string").alias("html"), F.concat(F.col("pos"), F.lit(".jpg")).alias("image_file"), "image_bytes")
    path = f"{shared_dir(s)}/dump-{uuid.uuid4().hex}"
    jsonl_tar.write_dump(pages.unionByName(images), path)
    return dataset.from_dump(s, path)


def ingest_pages(s, d):
    """Stage 0: pages of a dump under their content hash, with title and url; null data is an empty page."""
    f = jsonx.fields(F.col("info"), "title", "url")
    return _dump(s, d).text.where("data <> ''").select("id", f["title"].alias("title"), f["url"].alias("url"), F.array_join("tags", "|").alias("tags"))


def ingest_images(s, d):
    """Stage 0: images of a dump under their content hash, each with a label row."""
    ds = _dump(s, d)
    images = ds.images.groupBy("id").agg(F.count(F.lit(1)).alias("n_images"), F.max(F.length("image_bytes")).alias("n_bytes"))
    labels = ds.image_labels.groupBy("id").agg(F.count(F.lit(1)).alias("n_labels"))
    return images.join(labels, "id")


QUERIES = {f.__name__: f for f in (page_markdown, page_simple_html, page_meta, page_titles, page_captions, wiki_markdown, ingest_pages, ingest_images)}
_OBJ = "case when json_valid(info) and json_type(info) = 'OBJECT' then info end"
SQL = {
    "page_captions": rf"""select pos, coalesce(u, '') as url, 'picture' as alt, trim(regexp_replace(c, '\s+', ' ', 'g')) as caption
      from (select pos, json_extract_string(j, '$.caption') as c, json_extract_string(j, '$.image_url') as u from (select pos, {_OBJ} as j from image_labels)) where regexp_matches(c, '\S')""",
    "wiki_markdown": r"""select doc_id as pos, replace(replace('---
title: N@
url: "https://en.wikipedia.org/wiki/N"
remove_ref: true
---

| Name | %% |
| --- | --- |
| Parts | a@, b@ |
| Inner | i@ |

## Story

The record of %% has the number @, and it is kept in the archive of the harbour.

It grows as $x_{@}$.

![My pic @](//u.example/thumb/My_pic_@.jpg/250px-My_pic_@.jpg)

## Places

- one @
- two

## Legacy

End of @.', '@', doc_id::varchar), '%%', coalesce(source, 'nobody')) as data from documents""",
    "ingest_pages": r"""select sha256(data) as id, regexp_replace(trim(regexp_extract(data, '(?i)<title>([^<]+)</title>', 1)), '\s*[-–—]\s*Wikipedia\s*$', '') as title,
      regexp_extract(data, '(?i)<link[^>]*rel=["'']canonical["''][^>]*href=["'']([^"'']+)["'']', 1) as url, '' as tags from wiki_text where data <> ''""",
    "ingest_images": "select sha256(image_bytes) as id, count(*) as n_images, max(octet_length(image_bytes)) as n_bytes, count(*) as n_labels from images where image_bytes is not null group by 1",
    "page_titles": r"""select pos, nullif(trim(regexp_extract(data, '(?s)<title>([^<]*?)\s*[|–—―−-]\s+', 1)), '') as title, nullif(regexp_extract(data, '<link rel="canonical" href="([^"]+)"', 1), '') as url
      from (select *, case when json_valid(info) and json_type(info) = 'OBJECT' then info end as j from wiki_text) where json_extract_string(j, '$.format') = 'html' and data is not null""",
}
