"""Image blocks of chat payloads dropped by the size their labels give. O211-O213."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import jsonx
from millrace.operators import chat


def size_index(labels: DataFrame) -> DataFrame:
    """(image_id, width, height): the last row of each id with two positive whole sizes (O211)."""
    v = F.expr("try_parse_json(info)")
    whole = lambda k: F.try_variant_get(v, f"$.{k}", "bigint")
    rows = labels.where(jsonx.is_object(F.col("info")) & (F.col("id") != "")).select("id", "pos", whole("width").alias("width"), whole("height").alias("height"))
    last = rows.where("width > 0 and height > 0").groupBy(F.col("id").alias("image_id")).agg(F.max_by(F.struct("width", "height"), "pos").alias("s"))
    return last.select("image_id", "s.*")


def _drop(at: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, infos = [], []
            for raw, info, small in zip(b.column(at["data"]).to_pylist(), b.column(at["info"]).to_pylist(), b.column(at["_small"]).to_pylist()):
                blocks, role = chat.payload(raw)
                out = set(small or ())
                kept = [x for x in blocks if chat.block_image_id(x) not in out] if out else blocks
                data.append(json.dumps([{"role": role, "content": kept}], ensure_ascii=False))
                infos.append(chat.with_images(chat.info_object(info), chat.image_ids(kept), filtered_small_images=len(blocks) - len(kept)))
            cols = [data if n == "data" else infos if n == "info" else None for n in b.schema.names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) if c is not None else b.column(i) for i, c in enumerate(cols) if i != at["_small"]], names=[n for n in b.schema.names if n != "_small"]
            )

    return run


def block_ids(text: DataFrame) -> DataFrame:
    """(pos, image_id): distinct local images of payload rows."""
    found = F.regexp_extract_all("data", F.lit(r'"url":\s*"\s*(?:\./)?images/+([^"?#\\]+)'), F.lit(1))
    ids = F.filter(F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+$", ""), F.lit("/"))), lambda x: x != "")
    return text.select("pos", F.explode(F.array_distinct(ids)).alias("image_id"))


def filter_small_images(text: DataFrame, labels: DataFrame, min_width: int = 0, min_height: int = 0) -> DataFrame:
    """Drop image blocks known to be narrower or lower than asked; unknown sizes stay (O212, O213).

    Only ids that are too small take part in the join; each payload row meets its own few. A payload
    that isn't one message fails the job. Negative thresholds count as 0, 0 drops nothing.
    """
    w, h = max(0, int(min_width)), max(0, int(min_height))
    small = size_index(labels).where((F.col("width") < w) | (F.col("height") < h)).select("image_id")
    per_row = block_ids(text).join(small, "image_id").groupBy("pos").agg(F.collect_list("image_id").alias("_small"))
    rows = text.join(per_row, "pos", "left").select(*text.columns, "_small")
    return rows.mapInArrow(_drop({n: i for i, n in enumerate(rows.columns)}), text.schema)
