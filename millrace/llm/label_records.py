"""Problem 2 on the project's tables: one surviving label record per image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import jsonx
from millrace.llm import representative
from millrace.sources.tables import materialize, table

#: Words standing for "nothing known", compared after dropping case, outer blanks and punctuation.
STAND_INS = (
    "none", "null", "nil", "nan", "na", "n/a", "n.a", "n a", "undefined", "unknown", "unnamed", "untitled", "no title", "no caption", "no description",
    "no data", "no text", "no alt", "not available", "not known", "missing", "empty", "blank", "tbd", "tba", "tbc", "todo", "placeholder", "default",
    "image", "images", "img", "bild", "imagen", "изображение", "图片", "图像", "圖片",
    "ohne titel", "kein titel", "unbekannt", "unbenannt", "keine", "keine angabe", "keine beschreibung", "nicht bekannt", "k. a", "k.a", "fehlt",
    "sin título", "sin titulo", "sin nombre", "sin descripción", "sin descripcion", "desconocido", "desconocida", "ninguno", "ninguna", "no disponible", "s/t", "vacío",
    "без названия", "без имени", "без подписи", "нет", "нет данных", "неизвестно", "не указано", "нет описания", "отсутствует",
    "无", "無", "未知", "暂无", "无标题", "無標題", "无题", "不详", "不明", "没有", "无说明", "未命名", "空",
    "sans titre", "inconnu", "aucun", "senza titolo", "sconosciuto", "sem título", "desconhecido",
)
FILE_NAME = r"(?i)^\s*(?:(?:file|image|datei|bild|archivo|imagen|файл|文件)\s*:\s*[^/\\]*|[^\s]*)\.(?:jpe?g|png|gif|webp|svg|tiff?|bmp|avif|heic|pdf|djvu|ogg|ogv|webm|mp4)\s*$"
CAMERA_NAME = r"(?i)^\s*(?:img|dsc[nf]?|pict?|image|dcim|p)[_-]?\d{3,}\s*$"


def says_something(text: Column) -> Column:
    """Not null, has a letter or digit, no word for "nothing known", no bare file name."""
    bare = F.lower(F.regexp_replace(text, r"(?U)^[\s\p{P}\p{S}]+|[\s\p{P}\p{S}]+$", ""))
    bare = F.regexp_replace(bare, r"(?U)\s+", " ")
    return F.coalesce((bare != "") & ~bare.isin(*STAND_INS) & ~text.rlike(FILE_NAME) & ~text.rlike(CAMERA_NAME), F.lit(False))


def whole_number(text: Column) -> Column:
    """A positive whole number, however written (302, "302px", 885.0, "1,210"), else null."""
    digits = F.regexp_replace(F.regexp_extract(text, r"(?i)^\s*\+?(\d+|\d{1,3}(?:[, ]\d{3})+)(?:\.0*)?\s*(?:px|pixels?)?\s*$", 1), "[, ]", "")
    n = F.when(F.length(digits).between(1, 18), digits.cast("long"))
    return F.when(n > 0, n)


def leads_to_host(url: Column) -> Column:
    """A host stands in the url, with or without a scheme before it."""
    host = r"[\p{L}\p{N}](?:[\p{L}\p{N}_-]*[\p{L}\p{N}])?(?:\.[\p{L}\p{N}](?:[\p{L}\p{N}_-]*[\p{L}\p{N}])?)*\.?(?::\d+)?(?:[/?#].*)?"
    dotted = r"[\p{L}\p{N}](?:[\p{L}\p{N}_-]*[\p{L}\p{N}])?(?:\.[\p{L}\p{N}](?:[\p{L}\p{N}_-]*[\p{L}\p{N}])?)+(?::\d+)?"
    whole = url.rlike(rf"(?is)^\s*(?:(?:https?|ftp)://|//)(?:[^/@\s]*@)?{host}\s*$")
    plain = url.rlike(rf"(?is)^\s*{dotted}(?:[/?#].*)?\s*$") & ~url.rlike(FILE_NAME) | url.rlike(rf"(?is)^\s*{dotted}/.*$")
    return F.coalesce(whole | plain, F.lit(False))


def instant(text: Column) -> Column:
    """Microseconds of a time written as seconds or milliseconds since 1970 or in ISO 8601; else null."""
    t = F.trim(text)
    n = F.when(t.rlike(r"^-?\d{1,15}(\.\d+)?$"), t.cast("double"))
    micros = F.when(F.abs(n) >= 1e11, n * 1e3).otherwise(n * 1e6)
    iso = F.when(t.rlike(r"^\d{4}-"), F.unix_micros(t.try_cast("timestamp")))
    return F.coalesce(F.round(micros).cast("long"), iso)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "image_labels")
    info = jsonx.fields(F.col("info"), "caption_text", "caption", "width", "height", "image_url", "crawl_time", "label_source")
    rows = labels.select(jsonx.image_id(F.col("id")).alias("image_id"), "pos", "data", "tags", info.alias("i")).select("image_id", "pos", "data", "tags", "i.*")
    rows = rows.withColumn("source_key", F.lower(F.regexp_replace("label_source", r"(?U)^\s+|\s+$", "")))
    trust = table(spark, sf_dir, "label_sources").groupBy(F.lower(F.regexp_replace("label_source", r"(?U)^\s+|\s+$", "")).alias("source_key")).agg(F.max("trust").alias("trust"))
    return rows.join(trust, "source_key", "left").select(
        "image_id", "pos", "trust",
        instant(F.col("crawl_time")).alias("at"),
        F.when(says_something(F.col("caption_text")), F.col("caption_text")).otherwise(F.when(says_something(F.col("caption")), F.col("caption"))).alias("caption"),
        whole_number(F.col("width")).alias("width"), whole_number(F.col("height")).alias("height"),
        F.when(leads_to_host(F.col("image_url")), F.col("image_url")).alias("url"),
        F.when(says_something(F.col("data")), F.col("data")).alias("data"),
        F.when(F.exists("tags", lambda x: F.coalesce(x.rlike(r"(?U)[^\s\p{Cf}]"), F.lit(False))), F.col("tags")).alias("tags"),
    )


def _usable() -> dict[str, Column]:
    return {n: F.col(n).isNotNull() for n in ("caption", "url", "data", "tags")}


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and height are bundles of their own, usable together; the width determines the height."""
    f = features(spark, sf_dir)
    both = F.col("width").isNotNull() & F.col("height").isNotNull()
    usable = _usable() | {"size": both, "height": both}
    won = representative.choose(f, F.col("image_id"), F.col("pos"), F.col("trust"), F.col("at"), usable, deps=[("size", "height")], values={"size": F.col("width")}, least=2)
    return won.where("field_name <> 'height'").select(F.col("key").alias("image_id"), "field_name", "pos")


def p2_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of every image. Its size and its caption are ones seen beside its url, where
    any was seen beside a usable url, else the best usable ones."""
    f = materialize(features(spark, sf_dir), "label-features")
    usable = _usable() | {"size": F.col("width").isNotNull() & F.col("height").isNotNull()}
    carry = {n: F.col(n) for n in ("caption", "url", "data")} | {"tags": F.array_join("tags", "|", ""), "size": F.concat_ws("x", "width", "height")}
    won = representative.choose(
        f, F.col("image_id"), F.col("pos"), F.col("trust"), F.col("at"), usable, deps=[("url", "size"), ("url", "caption")], values={"url": F.col("url")}, carry=carry
    )
    pick = lambda n: F.max(F.when(F.col("field_name") == n, F.col("value")))
    size = lambda i: F.split(pick("size"), "x")[i].cast("long")
    return won.groupBy(F.col("key").alias("image_id")).agg(
        pick("caption").alias("caption"), size(0).alias("width"), size(1).alias("height"), pick("url").alias("url"), pick("data").alias("data"), pick("tags").alias("tags"),
        F.count(F.lit(1)).alias("n_fields"),
    )


QUERIES = {"p2_found": p2_found, "p2_survivors": p2_survivors}
#: Words for "nothing known" as the SQL has them, written apart from the operator's list.
_STANDS = """none null nil nan na n/a n.a undefined unknown unnamed untitled missing empty blank tbd tba placeholder default image images bild imagen img
unbekannt unbenannt keine fehlt desconocido desconocida ninguno ninguna s/t vacío нет неизвестно отсутствует изображение 无 無 未知 暂无 不详 不明 没有 空 图片 图像""".split() + [
    "no title", "no caption", "no description", "not available", "ohne titel", "kein titel", "keine beschreibung", "keine angabe", "k. a", "sin título", "sin titulo", "sin descripción", "no disponible",
    "без названия", "без подписи", "нет данных", "нет описания", "无标题", "无题", "无说明",
]


def _sql_says(c: str) -> str:
    bare = rf"regexp_replace(lower(regexp_replace({c}, '^[\s\p{{P}}\p{{S}}]+|[\s\p{{P}}\p{{S}}]+$', '', 'g')), '\s+', ' ', 'g')"
    words = ", ".join(f"'{w}'" for w in _STANDS)
    return rf"coalesce({bare} <> '' and {bare} not in ({words}) and not regexp_matches({c}, '(?i)^\s*(file:)?\S*\.(jpe?g|png|gif|webp|svg)\s*$'), false)"


_NUMBER = r"^\s*\+?0*[1-9]\d*(\.0*)?\s*(px)?\s*$"
_F = rf"""with src as (
  select nullif(regexp_extract(lower(id), '[0-9a-f]{{64}}'), '') as image_id, pos, data, tags,
    case when json_valid(info) and json_type(info) = 'OBJECT' then info end as j from image_labels),
f as (select image_id, pos, data, tags, json_extract_string(j, '$.caption_text') as c1, json_extract_string(j, '$.caption') as c2,
    json_extract_string(j, '$.width') as w, json_extract_string(j, '$.height') as h, json_extract_string(j, '$.image_url') as u,
    trim(json_extract_string(j, '$.crawl_time')) as t, lower(trim(json_extract_string(j, '$.label_source'))) as s
  from src where image_id is not null),
ok as (select f.*, coalesce(l.trust, {representative.NO_TRUST}) as trust,
    coalesce(case when regexp_matches(t, '^\d+(\.\d+)?$') then cast(case when cast(t as double) >= 1e11 then cast(t as double) * 1000 else cast(t as double) * 1e6 end as bigint)
      else epoch_us(try_cast(t as timestamptz)) end, {representative.NO_TIME}) as seen
  from f left join label_sources l on lower(trim(l.label_source)) = f.s),
says as (select *, {_sql_says("c1")} as u1, u1 or {_sql_says("c2")} as u_caption, {_sql_says("data")} as u_data,
    coalesce(regexp_matches(w, '(?i){_NUMBER}') and regexp_matches(h, '(?i){_NUMBER}'), false) as u_size,
    coalesce(regexp_matches(u, '^\s*(https?:)?//[^/\s]'), false) as u_url,
    coalesce(len(list_filter(tags, lambda x: regexp_matches(x, '\S'))) > 0, false) as u_tags, count(*) over (partition by image_id) as n from ok)
"""
SQL = {
    "p2_found": _F
    + """, long as (unpivot (select image_id, pos, trust, seen, u_caption as caption, u_data as data, u_size as size, u_url as url, u_tags as tags from says where n >= 2)
  on caption, data, size, url, tags into name field_name value usable)
select image_id, field_name, pos from long where usable
qualify row_number() over (partition by image_id, field_name order by trust desc, seen desc, pos) = 1""",
    # every url of an image with the best size and caption beside it, all combinations ranked, without any bound
    "p2_survivors": _F
    + r""", v as (select image_id, pos, trust, seen, u_url, u as url, u_size, cast(regexp_extract(w, '\d+') as bigint) as width, cast(regexp_extract(h, '\d+') as bigint) as height,
    u_caption, case when u1 then c1 else c2 end as caption, u_data, data, u_tags, array_to_string(list_transform(tags, lambda x: coalesce(x, '')), '|') as tags from says),
urls as (select * from v where u_url qualify row_number() over (partition by image_id, url order by trust desc, seen desc, pos) = 1),
us as (select * from v where u_url and u_size qualify row_number() over (partition by image_id, url order by trust desc, seen desc, pos) = 1),
uc as (select * from v where u_url and u_caption qualify row_number() over (partition by image_id, url order by trust desc, seen desc, pos) = 1),
combos as (select a.image_id, a.url, s.width, s.height, c.caption, 1 + (s.pos is not null)::int + (c.pos is not null)::int as k, a.trust + coalesce(s.trust, 0) + coalesce(c.trust, 0) as t,
    a.seen + coalesce(s.seen, 0) + coalesce(c.seen, 0) as e, a.pos + coalesce(s.pos, 0) + coalesce(c.pos, 0) as p
  from urls a left join us s on s.image_id = a.image_id and s.url = a.url left join uc c on c.image_id = a.image_id and c.url = a.url),
won as (select * from combos qualify row_number() over (partition by image_id order by k desc, t desc, e desc, p) = 1),
free_size as (select * from v where u_size and image_id not in (select image_id from us) qualify row_number() over (partition by image_id order by trust desc, seen desc, pos) = 1),
free_caption as (select * from v where u_caption and image_id not in (select image_id from uc) qualify row_number() over (partition by image_id order by trust desc, seen desc, pos) = 1),
best_data as (select * from v where u_data qualify row_number() over (partition by image_id order by trust desc, seen desc, pos) = 1),
best_tags as (select * from v where u_tags qualify row_number() over (partition by image_id order by trust desc, seen desc, pos) = 1)
select *, (caption is not null)::bigint + (width is not null)::bigint + (url is not null)::bigint + (data is not null)::bigint + (tags is not null)::bigint as n_fields
from (select i.image_id, coalesce(w.caption, fc.caption) as caption, coalesce(w.width, fs.width) as width, coalesce(w.height, fs.height) as height, w.url, d.data, g.tags
  from (select distinct image_id from v) i left join won w using (image_id) left join free_size fs using (image_id) left join free_caption fc using (image_id)
  left join best_data d using (image_id) left join best_tags g using (image_id)) where coalesce(caption, url, data, tags) is not null or width is not null""",
}
