"""The curation stages on the project's tables, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import jsonx, pages, urls
from millrace.operators import chat, dedup, localize, size_filter
from millrace.sources.tables import table


def _text(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "wiki_text")


def _labels(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "image_labels")


def _html(s: SparkSession, d: str) -> DataFrame:
    return _text(s, d).where(jsonx.fields(F.col("info"), "format")["format"] == "html")


def url_normalize(s, d):
    u = jsonx.fields(F.col("info"), "image_url")["image_url"]
    return _labels(s, d).select("pos", urls.normalize(u).alias("url")).where("url is not null")


def content_sha256(s, d):
    return _text(s, d).where("data is not null").select("pos", F.sha2("data", 256).alias("content_id"))


def html_meta(s, d):
    x = F.col("data")
    return _html(s, d).where("data is not null").select("pos", pages.title(x).alias("title"), pages.canonical_url(x).alias("url"), F.array_join(pages.categories(x), "|").alias("tags"))


def img_sources(s, d):
    return _html(s, d).select("pos", F.posexplode(pages.img_sources(F.col("data"))).alias("k", "src"))


def candidate_urls(s, d):
    return _labels(s, d).select("pos", F.array_join(localize.candidate_urls(F.col("info")), "|").alias("urls"))


def label_urls(s, d):
    return localize.label_urls(_labels(s, d)).select("image_id", "url", "raw_url", F.col("rank.pos").alias("pos"))


def _localized(s, d):
    return localize.localize(_text(s, d), _labels(s, d))


def localize_url_map(s, d):
    return _localized(s, d).url_map


def localize_missing(s, d):
    return _localized(s, d).missing.select("pos", "text_id", "html_url", "image_url_raw", "image_url_normalized")


def localize_unmatched(s, d):
    return _localized(s, d).unmatched


def localize_text(s, d):
    return _localized(s, d).text.select("pos", F.sha2("data", 256).alias("data_hash"), "rewritten", "n_used", F.array_join("image_ids", ",").alias("image_ids"))


def localize_counters(s, d):
    return _localized(s, d).counters()


def images_keep_first(s, d):
    return dedup.keep_first(table(s, d, "images")).select("pos", "id", "sha256", F.length("image_bytes").alias("n_bytes"))


def images_hash_conflicts(s, d):
    return dedup.hash_conflicts(table(s, d, "images"))


def images_first_seen(s, d):
    return dedup.first_seen_order(table(s, d, "images"))


def labels_row_positions(s, d):
    return dedup.row_positions(_labels(s, d).where("id is not null"))


def labels_merged_tags(s, d):
    return dedup.merged_tags(_labels(s, d).where("id is not null")).select("id", F.array_join("tags", "|").alias("tags"))


def labels_data_conflicts(s, d):
    return dedup.data_conflicts(_labels(s, d).where("id is not null"))


def labels_info_variants(s, d):
    return dedup.info_variants(_labels(s, d).where("id is not null"))


def labels_merge(s, d):
    m = dedup.merge_labels(_labels(s, d), strict=False)
    return m.select("pos", "id", "part", "info", "data", F.array_join("tags", "|").alias("tags"), "n_rows", "n_variants")


def front_matter_strip(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.sha2(pages.without_front_matter(F.col("text")), 256).alias("text_hash"))


def whitespace_normal(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.sha2(pages.normal_whitespace(F.col("text")), 256).alias("text_hash"))


def invisible_strip(s, d):
    return _text(s, d).where("data is not null").select("pos", F.sha2(pages.without_invisible(F.col("data")), 256).alias("data_hash"))


def cjk_texts(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", pages.is_cjk(F.col("text")).alias("is_cjk"))


def link_kinds(s, d):
    u = jsonx.fields(F.col("info"), "image_url")["image_url"]
    rows = _labels(s, d).select("pos", u.alias("u")).where("u is not null")
    c = F.col("u")
    return rows.select("pos", urls.is_relative(c).alias("is_relative"), urls.is_social(c).alias("is_social"), urls.is_print(c, F.lit(None).cast("string")).alias("is_print"), urls.is_image_file(c).alias("is_image_file"))


def _markdown(s, d):
    """Curated documents as Markdown rows of the curation tables."""
    t = table(s, d, "documents")
    return t.select(F.col("doc_id").alias("pos"), F.concat(F.lit("doc-"), F.col("doc_id")).alias("id"), F.to_json(F.struct(F.lit("md").alias("format"), "source")).alias("info"), F.col("text").alias("data"))


def md_parts(s, d):
    return chat.content_parts(_markdown(s, d)).select("pos", "nth", "type", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"), "image_id")


def chat_messages(s, d):
    return chat.to_chat(_markdown(s, d)).select("pos", "info", "data")


def md_image_ids(s, d):
    return chat.content_parts(_markdown(s, d)).where("image_id is not null").select("pos", "image_id")


def chat_image_ids(s, d):
    """Images and dropped images as the info beside a payload has them."""
    i = F.col("info")
    ids = F.array_join(F.from_json(F.get_json_object(i, "$.image_ids"), "array<string>"), ",")
    n = F.coalesce(F.get_json_object(i, "$.dropped_nonlocal_images").cast("int"), F.lit(0))
    return chat.to_chat(_markdown(s, d)).select("pos", F.coalesce(ids, F.lit("")).alias("image_ids"), n.alias("n_dropped"), F.get_json_object(i, "$.format").alias("format"))


def local_image_ids(s, d):
    f = jsonx.fields(F.col("info"), "image_ids")["image_ids"]
    ids = F.explode(F.filter(F.split(F.regexp_replace(f, r'[\[\]"]', ""), r","), lambda x: x != ""))
    return _text(s, d).where(f.isNotNull()).select("pos", ids.alias("ref")).select("pos", urls.local_image_id(F.col("ref")).alias("image_id")).where("image_id is not null")


def size_index(s, d):
    return size_filter.size_index(_labels(s, d).where("id is not null"))


def _payloads(s, d):
    """Pages as payloads: their images as blocks around their title."""
    f = jsonx.fields(F.col("info"), "image_ids", "title")
    rows = _text(s, d).select("pos", "id", "info", F.array_distinct(jsonx.image_ids(f["image_ids"])).alias("ids"), F.coalesce(f["title"], F.lit("")).alias("title"))
    md = F.concat(F.regexp_replace("title", r"[\[\]!]", ""), F.array_join(F.transform("ids", lambda i: F.concat(F.lit("\n![x](images/"), i, F.lit(")"))), ""))
    return chat.to_chat(rows.select("pos", "id", "info", md.alias("data")))


def small_image_filter(s, d):
    out = size_filter.filter_small_images(_payloads(s, d), _labels(s, d).where("id is not null"), 200, 200)
    return out.select("pos", "data", F.coalesce(F.get_json_object("info", "$.filtered_small_images").cast("int"), F.lit(0)).alias("n_dropped"))


def small_image_counts(s, d):
    return small_image_filter(s, d).groupBy("n_dropped").agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {
    f.__name__: f
    for f in (
        url_normalize, content_sha256, html_meta, img_sources, candidate_urls, label_urls, localize_url_map, localize_missing, localize_unmatched, localize_text,
        localize_counters, images_keep_first, images_hash_conflicts, images_first_seen, labels_row_positions, labels_merged_tags, labels_data_conflicts,
        labels_info_variants, labels_merge, front_matter_strip, whitespace_normal, invisible_strip, cjk_texts, link_kinds, md_parts, md_image_ids, chat_messages, chat_image_ids,
        local_image_ids, size_index, small_image_filter, small_image_counts,
    )
}

_OBJ = "case when json_valid(info) and json_type(info) = 'OBJECT' then info end"
_STR = lambda k, j="j": f"case when json_type({j}, '$.{k}') = 'VARCHAR' then json_extract_string({j}, '$.{k}') end"
_NORM = lambda c: rf"regexp_replace(url_decode(ltrim(regexp_replace({c}, '^https?:', ''), '/')), '/thumb/(.*)/\d+px-[^/]+$', '/\1')"
_HTML = f"html as (select * from (select *, {_OBJ} as j from wiki_text) where json_extract_string(j, '$.format') = 'html')"
_CAND = f"""
cand as (select pos, nullif(regexp_extract(lower(id), '[0-9a-f]{{64}}'), '') as image_id, unnest([0, 1]) as k, unnest([{_STR("image_url_ori")}, {_STR("image_url")}]) as raw_url
  from (select pos, id, {_OBJ} as j from image_labels)),
named as (select image_id, url, arg_min(raw_url, pos * 2 + k) as raw_url, min(pos * 2 + k) as rank
  from (select *, {_NORM("raw_url")} as url from cand where raw_url <> '' and image_id is not null) where url <> '' group by 1, 2)"""
_LOCAL = f"""with {_CAND},
rows_ as (select pos, id as text_id, data, coalesce(nullif(json_extract_string(j, '$.url'), ''), nullif(json_extract_string(j, '$.final_url'), ''), '') as html_url,
    regexp_extract_all(lower(cast(json_extract(j, '$.image_ids') as varchar)), '[0-9a-f]{{64}}') as all_ids,
    list_filter(list_transform(regexp_extract_all(data, '(?i)<img\\b[^>]*>'), lambda t: regexp_extract(t, '(?i)\\bsrc=["'']([^"'']+)["'']', 1)), lambda s: s <> '') as sources
  from (select *, {_OBJ} as j from wiki_text)),
ids as (select pos, text_id, html_url, image_id, min(k) as id_pos from (select pos, text_id, html_url, unnest(all_ids) as image_id, generate_subscripts(all_ids, 1) as k from rows_) group by all),
shown as (select pos, text_id, html_url, raw_url, {_NORM("raw_url")} as url from (select pos, text_id, html_url, unnest(sources) as raw_url from rows_)),
met as (select distinct s.pos, s.url, n.image_id, i.id_pos, n.rank from shown s join named n using (url) join ids i on i.pos = s.pos and i.image_id = n.image_id),
url_map as (select pos, url, image_id from met qualify row_number() over (partition by pos, url order by id_pos, rank) = 1),
missing as (select s.* from shown s left join url_map m on m.pos = s.pos and m.url = s.url where m.pos is null),
unmatched as (select case when i.image_id in (select image_id from named) then 'image_id_not_matched_to_html_url' else 'image_id_no_candidate_urls' end as type, i.pos, text_id, html_url, i.image_id
  from ids i left join (select distinct pos, image_id from met) m on m.pos = i.pos and m.image_id = i.image_id where m.pos is null)
"""
_IMG_SIZE = """sizes as (select image_id, s.width as width, s.height as height from (select id as image_id, arg_max({'width': w, 'height': h}, pos) as s from (
  select id, pos, %s as w, %s as h from (select id, pos, case when json_valid(info) and json_type(info) = 'OBJECT' then info end as j from image_labels where id <> ''))
  where w > 0 and h > 0 group by id))"""
_WHOLE = lambda k: f"case json_type(j, '$.{k}') when 'VARCHAR' then case when regexp_matches(json_extract_string(j, '$.{k}'), '^\\s*[+-]?\\d+\\s*$') then try_cast(trim(json_extract_string(j, '$.{k}')) as bigint) end when 'NULL' then null else cast(trunc(try_cast(json_extract_string(j, '$.{k}') as double)) as bigint) end"
_IMG_SIZE = _IMG_SIZE % (_WHOLE("width"), _WHOLE("height"))
_FRONT = r"regexp_replace(text, '\A---[ \t]*\r?\n[\s\S]*?\r?\n---[ \t]*(\r?\n+)?', '')"

SQL = {
    "url_normalize": f"select pos, {_NORM('u')} as url from (select pos, json_extract_string(j, '$.image_url') as u from (select pos, {_OBJ} as j from image_labels)) where u is not null",
    "content_sha256": "select pos, sha256(data) as content_id from wiki_text where data is not null",
    "html_meta": rf"""with {_HTML} select pos, nullif(regexp_replace(trim(regexp_extract(data, '(?i)<title>([^<]+)</title>', 1)), '\s*[-–—]\s*Wikipedia\s*$', ''), '') as title,
      nullif(regexp_extract(data, '(?i)<link[^>]*rel=["'']canonical["''][^>]*href=["'']([^"'']+)["'']', 1), '') as url,
      coalesce(array_to_string(regexp_extract_all(data, '(?i)<a[^>]*href=["''](?:https?://[^/]*)*/wiki/Category:[^"'']+["''][^>]*>([^<]+)</a>', 1), '|'), '') as tags from html where data is not null""",
    "img_sources": rf"""with {_HTML}, t as (select pos, list_filter(list_transform(regexp_extract_all(data, '(?i)<img\b[^>]*>'), lambda t: regexp_extract(t, '(?i)\bsrc=["'']([^"'']+)["'']', 1)), lambda s: s <> '') as s from html)
      select pos, generate_subscripts(s, 1) - 1 as k, unnest(s) as src from t""",
    "candidate_urls": f"""with l as (select pos, {_STR('image_url_ori')} as a, {_STR('image_url')} as b from (select pos, {_OBJ} as j from image_labels))
      select pos, case when nullif(a, '') is null then coalesce(b, '') when nullif(b, '') is null or a = b then a else a || '|' || b end as urls from l""",
    "label_urls": f"with {_CAND} select image_id, url, raw_url, rank // 2 as pos from named",
    "localize_url_map": _LOCAL + "select pos, url, image_id from url_map",
    "localize_missing": _LOCAL + "select pos, text_id, html_url, raw_url as image_url_raw, url as image_url_normalized from missing",
    "localize_unmatched": _LOCAL + "select type, pos, text_id, html_url, image_id from unmatched",
    "localize_counters": _LOCAL
    + """, used as (select s.pos, count(*) as n from shown s join url_map m on m.pos = s.pos and m.url = s.url group by 1)
      select (select count(*) from wiki_text) as rows, (select count(*) from used) as rewritten_rows, (select cast(sum(n) as bigint) from used) as rewritten_images,
        (select count(*) from missing) as missing_urls, (select count(*) from unmatched) as unmatched_image_ids""",
    "images_keep_first": "select pos, id, sha256, octet_length(image_bytes) as n_bytes from images qualify row_number() over (partition by id order by pos) = 1",
    "images_hash_conflicts": """select 'images_sha256_conflict' as type, id as image_id, f as first_sha256, sha as duplicate_sha256, pos from (
      select id, pos, coalesce(sha256, '') as sha, first_value(coalesce(sha256, '')) over (partition by id order by pos) as f, row_number() over (partition by id order by pos) as rn from images) where rn > 1 and sha <> f""",
    "images_first_seen": "select id, first_pos, n_rows, row_number() over (order by first_pos) - 1 as ordinal from (select id, min(pos) as first_pos, count(*) as n_rows from images group by id)",
    "labels_row_positions": "select id, pos, row_number() over (partition by id order by pos) as nth from image_labels where id is not null",
    "labels_merged_tags": """select id, string_agg(tag, '|' order by p, k) as tags from (select id, tag, min(pos * 1000 + k) as p, 0 as k from (
      select id, pos, unnest(tags) as tag, generate_subscripts(tags, 1) as k from image_labels where id is not null) where tag <> '' group by 1, 2) group by id""",
    "labels_data_conflicts": """select 'image_labels_data_conflict' as type, id as image_id, f as first_data, data as duplicate_data, pos from (
      select id, pos, coalesce(data, '') as data, first_value(coalesce(data, '')) over (partition by id order by pos) as f, row_number() over (partition by id order by pos) as rn from image_labels where id is not null)
      where rn > 1 and f <> '' and data <> '' and data <> f""",
    "front_matter_strip": f"select doc_id, sha256({_FRONT}) as text_hash from documents where text is not null",
    "invisible_strip": f"select pos, sha256(regexp_replace(data, '{pages.INVISIBLE}', '', 'g')) as data_hash from wiki_text where data is not null",
    "cjk_texts": f"""select doc_id, n > 0 and len(regexp_extract_all(text, '{pages.CJK}')) > n * 0.5 as is_cjk
      from (select doc_id, text, len(regexp_extract_all(text, '\\p{{L}}')) as n from documents where text is not null)""",
    "link_kinds": rf"""select pos, u <> '' and not regexp_matches(u, '^(#|data:|mailto:|tel:|javascript:|https?://|//)') as is_relative,
      regexp_matches(u, '{'|'.join(x.replace('.', '[.]') for x in urls.SOCIAL_HOSTS)}') as is_social, contains(lower(u), 'print') as is_print, regexp_matches(lower(split_part(u, '?', 1)), '\.({'|'.join(urls.IMAGE_ENDINGS)})$') as is_image_file
      from (select pos, json_extract_string(j, '$.image_url') as u from (select pos, {_OBJ} as j from image_labels)) where u is not null""",
    "whitespace_normal": r"""select doc_id, sha256(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(text, '(?m)^[ \t\x{a0}]+$', '', 'g'),
      '\n{3,}', chr(10) || chr(10), 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '(?i)<br\s*/?>', '', 'g'), '^\n+', '')) as text_hash from documents where text is not null""",
    "md_image_ids": f"""with t as (select doc_id as pos, unnest(regexp_extract_all({_FRONT}, '!\\[[^\\]]*\\]\\(([^()]*)\\)', 1)) as href from documents)
      select pos, regexp_extract(href, '^(?:\\./)?images/+([^?#]+)', 1) as image_id from t where regexp_matches(href, '^(\\./)?images/')""",
    "chat_image_ids": f"""with t as (select doc_id as pos, coalesce(regexp_extract_all({_FRONT}, '!\\[[^\\]]*\\]\\(([^()]*)\\)', 1), []) as hrefs from documents)
      select pos, array_to_string(list_transform(list_filter(hrefs, lambda h: regexp_matches(h, '^(\\./)?images/')), lambda h: regexp_extract(h, '^(?:\\./)?images/+([^?#]+)', 1)), ',') as image_ids,
        cast(len(list_filter(hrefs, lambda h: not regexp_matches(h, '^(\\./)?images/'))) as integer) as n_dropped, 'openai' as format from t""",
    "local_image_ids": rf"""with t as (select pos, cast(json_extract(j, '$.image_ids') as varchar) as v from (select pos, {_OBJ} as j from wiki_text)),
      r as (select pos, unnest(string_split(regexp_replace(replace(v, '\', ''), '[\[\]"]', '', 'g'), ',')) as ref from t)
      select pos, regexp_extract(ref, 'images/+([^?#]+)', 1) as image_id from r where starts_with(trim(ref), 'images/')""",
    "size_index": f"with {_IMG_SIZE} select image_id, width, height from sizes",
    "small_image_counts": f"""with {_IMG_SIZE}, t as (select pos, coalesce(cast(json_extract(j, '$.image_ids') as varchar), '') as v from (select pos, {_OBJ} as j from wiki_text)),
      ids as (select distinct pos, unnest(regexp_extract_all(lower(v), '[0-9a-f]{{64}}')) as image_id from t),
      n as (select t.pos, count(s.image_id) as n_dropped from t left join ids i on i.pos = t.pos left join sizes s on s.image_id = i.image_id and (s.width < 200 or s.height < 200) group by 1)
      select cast(n_dropped as integer) as n_dropped, count(*) as n_rows from n group by 1""",
}

# JSON texts as Python writes them: members and items apart by a comma and a space
_MORE: dict[str, str] = {}


def _value(v: str) -> str:
    return f"case json_type({v}) when 'DOUBLE' then cast(cast({v} as double) as varchar) when 'ARRAY' then '[' || array_to_string(list_transform(cast({v} as json[]), lambda x: cast(x as varchar)), ', ') || ']' else cast({v} as varchar) end"


_MEMBER = f"to_json(k) || ': ' || {_value('json_extract(j, chr(36) || chr(46) || to_json(k))')}"
_CANON = f"""canon as (select id, pos, coalesce('{{' || array_to_string(list_transform(list_sort(list_filter(list_distinct(json_keys(j)), lambda k: k <> 'info_addtional')), lambda k: {_MEMBER}), ', ') || '}}', '{{}}') as variant
  from (select *, {_OBJ} as j from image_labels where id is not null)),
variants as (select id, variant, min(pos) as first_pos from canon group by 1, 2)"""
_MORE["labels_info_variants"] = f"with {_CANON} select * from variants"
_TAGS = """select id, string_agg(tag, '|' order by p) as tags from (select id, tag, min(pos * 1000 + k) as p from (
    select id, pos, unnest(tags) as tag, generate_subscripts(tags, 1) as k from image_labels where id is not null) where tag <> '' group by 1, 2) group by id"""
_MORE["labels_merge"] = f"""with {_CANON},
nth as (select *, row_number() over (partition by id order by first_pos) - 1 as rank from variants),
lists as (select id, cast((rank - 1) // 500 as integer) as part, min(first_pos) as at, '[' || string_agg(to_json(variant), ', ' order by rank) || ']' as more from nth where rank > 0 group by 1, 2),
first as (select id, arg_min(coalesce({_OBJ}, '{{}}'), pos) as j, coalesce(arg_min(struct_pack(d := data), pos).d, '') as data, min(pos) as pos, count(*) as n_rows from image_labels where id is not null group by id),
head as (select id, pos, data, n_rows, 0 as part, list_filter(json_keys(j), lambda k: k <> 'info_addtional') as keys, j from first),
tags as ({_TAGS}), counts as (select id, cast(count(*) as integer) as n_variants from variants group by id)
select coalesce(h.pos, l.at) as pos, coalesce(h.id, l.id) as id, coalesce(h.part, l.part) as part,
  '{{' || coalesce(array_to_string(list_transform(h.keys, lambda k: {_MEMBER.replace('json_extract(j','json_extract(h.j')}), ', ') || case when len(h.keys) > 0 then ', ' else '' end, '') || '"info_addtional": ' || coalesce(l.more, '[]') || '}}' as info,
  coalesce(h.data, '') as data, case when h.id is null then '' else coalesce(t.tags, '') end as tags, h.n_rows, case when h.id is not null then c.n_variants end as n_variants
from head h full join lists l on l.id = h.id and l.part = h.part left join tags t on t.id = h.id left join counts c on c.id = h.id"""
_PARTS = rf"""cut as (select doc_id as pos, source, string_split(regexp_replace(regexp_replace(coalesce(case when starts_with(text, '---') then {_FRONT} else text end, ''), '!\[[^\]]*\]\((?:\./)?images/+([^()?#]+)[^()]*\)', chr(1) || '\1' || chr(1), 'g'), '!\[[^\]]*\]\([^()]*\)', '', 'g'), chr(1)) as xs,
  len(regexp_extract_all({_FRONT}, '!\[[^\]]*\]\(([^()]*)\)')) as n_images from documents),
items as (select pos, source, n_images, unnest(xs) as x, generate_subscripts(xs, 1) as i, len(xs) as n from cut),
parts as (select pos, source, n_images, cast(row_number() over (partition by pos order by i) - 1 as integer) as nth, case when i % 2 = 0 then 'image_url' else 'text' end as type, x from items where x <> '' or n = 1)"""
_MORE["md_parts"] = f"with {_PARTS} select pos, nth, type, case when type = 'text' then sha256(x) else sha256('') end as text_hash, case when type = 'image_url' then x end as image_id from parts"
_BLOCK = """case when type = 'text' then '{"type": "text", "text": ' || to_json(x) || '}' else '{"type": "image_url", "image_url": {"url": ' || to_json('images/' || x) || '}}' end"""
_MORE["chat_messages"] = f"""with {_PARTS}, m as (select pos, any_value(source) as source, any_value(n_images) as n_images, string_agg({_BLOCK}, ', ' order by nth) as content, string_agg(case when type = 'image_url' then to_json(x) end, ', ' order by nth) as ids, count(*) filter (where type = 'image_url') as n_local from parts group by pos)
select pos, '{{"format": "openai"' || coalesce(', "source": ' || to_json(source), '') || coalesce(', "image_ids": [' || ids || ']', '') || case when n_images > n_local then ', "dropped_nonlocal_images": ' || (n_images - n_local) else '' end || '}}' as info,
  '[{{"role": "user", "content": [' || content || ']}}]' as data from m"""
_MORE["small_image_filter"] = f"""with {_IMG_SIZE}, t as (select pos, regexp_replace(coalesce(json_extract_string(j, '$.title'), ''), '[\\[\\]!]', '', 'g') as title, regexp_extract_all(lower(coalesce(cast(json_extract(j, '$.image_ids') as varchar), '')), '[0-9a-f]{{64}}') as all_ids from (select pos, {_OBJ} as j from wiki_text)),
ids as (select pos, title, image_id, min(k) as k from (select pos, title, unnest(all_ids) as image_id, generate_subscripts(all_ids, 1) as k from t) group by all),
shown as (select i.*, row_number() over (partition by i.pos order by k) as n, s.image_id is not null as small from ids i left join sizes s on s.image_id = i.image_id and (s.width < 200 or s.height < 200)),
b as (select pos, string_agg('{{"type": "text", "text": ' || to_json(case when n = 1 then title else '' end || chr(10)) || '}}' || case when small then '' else ', {{"type": "image_url", "image_url": {{"url": "images/' || image_id || '"}}}}' end, ', ' order by n) as content, cast(count(*) filter (where small) as integer) as n_dropped from shown group by pos)
select t.pos, '[{{"role": "user", "content": [' || coalesce(b.content, '{{"type": "text", "text": ' || to_json(t.title) || '}}') || ']}}]' as data, coalesce(b.n_dropped, 0) as n_dropped from t left join b using (pos)"""
_MORE["localize_text"] = _LOCAL + rf""", tags as (select distinct pos, unnest(regexp_extract_all(data, '(?i)<img\b[^>]*>')) as tag from rows_),
swaps as (select t.pos, tag, regexp_replace(regexp_replace(tag, '(?i)\s*\bsrcset=["''][^"'']*["'']', ''), '(?i)(\bsrc=["''])[^"'']+(["''])', '\1images/' || m.image_id || '\2') as new
  from (select *, regexp_extract(tag, '(?i)\bsrc=["'']([^"'']+)["'']', 1) as raw_url from tags) t join (select distinct pos, raw_url, url from shown) s on s.pos = t.pos and s.raw_url = t.raw_url join url_map m on m.pos = s.pos and m.url = s.url),
sets as (select pos, list(struct_pack(a := tag, b := new) order by tag) as sw from swaps group by pos),
used as (select s.pos, count(*) as n from shown s join url_map m on m.pos = s.pos and m.url = s.url group by 1),
text_ids as (select pos, string_agg(image_id, ',' order by id_pos) as image_ids from ids group by pos),
new as (select r.pos, r.data, case when sw is null then r.data else list_reduce(list_prepend(struct_pack(a := r.data, b := ''), sw), lambda x, y: struct_pack(a := replace(x.a, y.a, y.b), b := '')).a end as new from rows_ r left join sets using (pos))
select n.pos, sha256(new) as data_hash, coalesce(new <> data, false) as rewritten, coalesce(u.n, 0) as n_used, coalesce(i.image_ids, '') as image_ids from new n left join used u using (pos) left join text_ids i using (pos)"""
SQL |= _MORE
