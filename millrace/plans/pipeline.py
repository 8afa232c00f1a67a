"""The curation run: dump -> dataset -> localised and deduplicated -> Markdown -> chat -> size filter.

Each stage is a function of datasets; ``main`` runs stages by name over folders. O005, O059-O065, O214-O252.
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import time
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.html import kernel
from millrace.operators import chat, dedup, localize, size_filter
from millrace.sources import dataset
from millrace.sources.dataset import Dataset


def load_callable(spec: str) -> Callable:
    """``module:function`` (O024)."""
    module, sep, name = spec.partition(":")
    if not sep or not module or not name:
        raise ValueError(f"not module:function: {spec}")
    f = getattr(importlib.import_module(module), name)
    if not callable(f):
        raise TypeError(f"{spec} is not callable")
    return f


def rewrite_with(text: DataFrame, url_map: DataFrame, extract: Callable, normalize: Callable, form: Callable, rewrite: Callable) -> DataFrame:
    """Custom rewriting: plugins get each page with its own (url -> image id) map, as the default rule has it in columns.

    ``rewrite`` receives the raw urls with a queue of targets each, None where there is none (O042, O048).
    """
    maps = url_map.groupBy("pos").agg(F.map_from_entries(F.collect_list(F.struct("url", "image_id"))).alias("_map"))
    rows = text.join(maps, "pos", "left")
    at = {n: i for i, n in enumerate(rows.columns)}

    def run(batches):
        for b in batches:
            data = []
            for page, known in zip(b.column(at["data"]).to_pylist(), b.column(at["_map"]).to_pylist()):
                known = dict(known or {})
                queues: dict[str, list[str | None]] = {}
                for raw in extract(page or ""):
                    image = known.get(normalize(raw))
                    queues.setdefault(raw, []).append(form(image) if image else None)
                data.append(rewrite(page or "", queues))
            cols = list(b.columns)
            cols[at["data"]] = pa.array(data, pa.string())
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(cols) if i != at["_map"]], names=[n for n in b.schema.names if n != "_map"])

    return rows.mapInArrow(run, text.schema)


def localized(ds: Dataset, strict: bool = True) -> tuple[Dataset, dict[str, DataFrame], localize.Localized]:
    """Stage 1: pages point to local images, images and labels have one row per id; diagnostics beside."""
    got = localize.localize(ds.text, ds.image_labels)
    new_info = F.pandas_udf(_set_ids, "string")
    text = ds.text.select("pos", "id", "info", "tags").join(got.text.select("pos", "data", "image_ids"), "pos")
    text = text.select("pos", "id", new_info("info", "image_ids").alias("info"), "data", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))
    labels = dedup.merge_labels(ds.image_labels, strict).select("pos", "id", "part", "info", "data", "tags", "n_variants")
    side = {
        "image_url_missing": got.missing,
        "image_id_unmatched_warning": got.unmatched,
        "images_sha256_conflict": dedup.hash_conflicts(ds.images),
        "image_labels_data_conflict": dedup.data_conflicts(ds.image_labels),
    }
    return Dataset(text, dedup.keep_first(ds.images), labels), side, got


def _set_ids(info: pd.Series, ids: pd.Series) -> pd.Series:
    rows = [chat.info_object(i) | {"image_ids": [] if x is None else list(x)} for i, x in zip(info, ids)]
    return pd.Series([json.dumps(r, ensure_ascii=False) for r in rows])


def parsed(ds: Dataset, out_format: str = "md", remove_ref: bool = False, timeout: int = 30) -> tuple[Dataset, DataFrame]:
    """Stage 2, and the rows that failed."""
    rows = kernel.parse_pages(ds.text, out_format, remove_ref, timeout)
    return Dataset(rows.drop("_error"), ds.images, ds.image_labels), rows.where("_error is not null").select("pos", "id", F.col("_error").alias("error"))


def chatted(ds: Dataset, role: str = "user") -> Dataset:
    """Stage 3; tags are not kept beside payloads."""
    return Dataset(chat.to_chat(ds.text.drop("tags"), role), ds.images, ds.image_labels)


def size_filtered(ds: Dataset, min_width: int = 0, min_height: int = 0) -> Dataset:
    """Stage 4."""
    return Dataset(size_filter.filter_small_images(ds.text, ds.image_labels, min_width, min_height), ds.images, ds.image_labels)


def run_localize(spark: SparkSession, source: str, target: str, overwrite: bool = False, strict: bool = True) -> dict:
    """Stage 1 over folders, with diagnostics as JSON lines and both manifests.

    Rows and image references that pass are counted while the text is written; every step is timed.
    """
    timings: dict[str, float] = {}
    began = time.time()

    def took(step: str) -> None:
        timings[step] = time.time() - began - sum(timings.values())

    ds = dataset.read(spark, source)
    new, side, _ = localized(ds, strict)
    took("plan_and_map_seconds")
    seen = Observation("progress")
    text = new.text.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.size(F.col("tags"))).alias("tags"))
    written = dataset.write(Dataset(text, new.images, new.image_labels), target, overwrite)
    took("write_tables_seconds")
    for name, rows in side.items():
        rows.write.mode("overwrite").json(f"{target}/{name}.jsonl")
        took(f"{name}_seconds")
    steps = {"step": "localize", "user": dataset.user(), **dataset.revision(os.path.dirname(__file__))}
    description = dataset.manifest(written, os.path.basename(target), source, target, steps, [f"{n}.jsonl" for n in side])
    took("count_tables_seconds")
    timings["seconds"] = time.time() - began
    dataset.write_yaml(f"{target}/dataset.yaml", description)
    dataset.write_yaml(f"{target}/run_info.yaml", {"source": {"dataset_root": source}, "target": {"output_dir": target}, "pipeline": steps, "progress": seen.get, "timings": timings})
    return timings


def main(argv: list[str] | None = None) -> int:
    """``python -m millrace.plans.pipeline STAGE SOURCE TARGET [options]``."""
    p = argparse.ArgumentParser()
    p.add_argument("stage", choices=["ingest", "localize", "parse", "chat", "filter", "optimize"])
    p.add_argument("source")
    p.add_argument("target", nargs="?")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--out-format", default="md", choices=["md", "html"])
    p.add_argument("--remove-ref", action="store_true")
    p.add_argument("--timeout", type=int, default=30)
    p.add_argument("--role", default="user")
    p.add_argument("--min-width", type=int, default=0)
    p.add_argument("--min-height", type=int, default=0)
    p.add_argument("--tables")
    p.add_argument("--host", help="pattern of the host whose images pages of a dump are pointed to")
    a = p.parse_args(argv)
    if a.stage != "optimize" and not a.target:
        p.error("this stage needs a target")
    spark = SparkSession.builder.appName(f"millrace {a.stage}").getOrCreate()
    if a.stage == "ingest":
        dataset.write(dataset.from_dump(spark, a.source, a.host), a.target, a.overwrite)
    elif a.stage == "localize":
        run_localize(spark, a.source, a.target, a.overwrite)
    elif a.stage == "optimize":
        dataset.optimize(spark, a.source, a.tables)
    else:
        ds = dataset.read(spark, a.source)
        same = dict.fromkeys(("images", "image_labels"), a.source)
        if a.stage == "parse":
            out, errors = parsed(ds, a.out_format, a.remove_ref, a.timeout)
            new = dataset.write(out, a.target, a.overwrite, unchanged=same)
            errors.write.mode("overwrite").json(os.path.join(a.target, "errors.jsonl"))
        else:
            out = chatted(ds, a.role) if a.stage == "chat" else size_filtered(ds, a.min_width, a.min_height)
            new = dataset.write(out, a.target, a.overwrite, unchanged=same)
        dataset.verify_order(ds.text, new.text)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
