"""A dataset: text, images and image labels in one folder, with its manifests. O010, O014-O022, O070-O076."""

from __future__ import annotations

import getpass
import json
import os
import subprocess
import uuid
from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import jsonx, pages, urls
from millrace.sources.jsonl_tar import read_dump
from millrace.sources.tables import file_system

TABLES = ("text", "image_labels", "images")


@dataclass(frozen=True)
class Dataset:
    text: DataFrame
    images: DataFrame
    image_labels: DataFrame

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


def from_dump(spark: SparkSession, path: str, host: str | None = None) -> Dataset:
    """The three tables of a page dump; with ``host``, a pattern, sources on it lead to the page's own images (O036, O037)."""
    rows = read_dump(spark, path)
    of = lambda kind, *cols: rows.where(F.col("kind") == kind).select("pos", *cols)
    ds = Dataset(of("text", "id", "info", "data", "tags"), of("image", "id", "image_bytes", "sha256"), of("label", "id", "info", "data", "tags"))
    return replace(ds, text=host_local(ds, host)) if host else ds


def host_local(ds: Dataset, host: str) -> DataFrame:
    """``ds.text`` with the sources on ``host`` pointed to images whose label names page and url; the first label wins.

    Each page meets the map of its own images only.
    """
    f = jsonx.fields(F.col("info"), "image_url", "text_ids")
    named = ds.image_labels.select("pos", "id", urls.normalize(f["image_url"]).alias("url"), F.explode(F.from_json(f["text_ids"], "array<string>")).alias("text_id"))
    first = named.where("url <> ''").groupBy("text_id", "url").agg(F.min_by("id", "pos").alias("image_id"))
    maps = first.groupBy(F.col("text_id").alias("_page")).agg(F.map_from_entries(F.collect_list(F.struct("url", "image_id"))).alias("_map"))
    rows = ds.text.join(maps, F.col("id") == F.col("_page"), "left")
    new = F.when(F.col("_map").isNull(), F.col("data")).otherwise(pages.rewrite_images(F.col("data"), pages.host_refs(F.col("data"), F.col("_map"), host)))
    return rows.withColumn("data", new).select(*ds.text.columns)


def wanted_tables(names: str | list[str] | None) -> list[str]:
    """Names as a list in fixed order; none or blank is all, an unknown one an error (O021, O061)."""
    if isinstance(names, str):
        names = [n.strip() for n in names.split(",") if n.strip()]
    if not names:
        return list(TABLES)
    if bad := set(names) - set(TABLES):
        raise ValueError(f"unknown tables: {sorted(bad)}")
    return [t for t in TABLES if t in names]


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a local or remote path."""
    return file_system(spark.sparkContext, path), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _link(spark: SparkSession, path: str, table: str) -> str:
    """Where a table is: behind the link file of its name, else in the folder itself."""
    fs, at = _fs(spark, f"{path}/{table}.link")
    if not fs.exists(at):
        return f"{path}/{table}.parquet"
    stream = fs.open(at)
    try:
        return bytes(b & 255 for b in stream.readAllBytes()).decode()
    finally:
        stream.close()


def _set_link(spark: SparkSession, path: str, table: str, to: str) -> None:
    fs, at = _fs(spark, f"{path}/{table}.link")
    out = fs.create(at, True)
    try:
        out.write(bytearray(to.encode()))
    finally:
        out.close()


def write(ds: Dataset, path: str, overwrite: bool = False, rows_per_file: int = 1_000_000, unchanged: dict[str, str] | None = None) -> Dataset:
    """Write the tables as Parquet and read them back. An existing folder is an error unless overwritten.

    Files are bounded by rows; the image table, whose rows are large, by a hundredth of that.
    ``unchanged``: dataset folders of tables that are as they were; they are linked, not copied, by a
    file ``<table>.link`` that says where they are, so that no image byte moves (O223, O233, O242).
    """
    spark = ds.text.sparkSession
    mode = "overwrite" if overwrite else "errorifexists"
    for t in TABLES:
        fs, at = _fs(spark, f"{path}/{t}.link")
        own = fs.makeQualified(_fs(spark, f"{path}/{t}.parquet")[1])
        if not overwrite and (fs.exists(at) or fs.exists(own)):
            raise FileExistsError(f"{path} has a table {t} already: it exists")
        if t in (unchanged or {}):
            to = _link(spark, unchanged[t], t)
            to = str(_fs(spark, to)[0].makeQualified(_fs(spark, to)[1]).toString())
            if to != str(own.toString()):
                _set_link(spark, path, t, to)
                fs.delete(own, True)
            continue
        per = max(1, rows_per_file // 100) if t == "images" else rows_per_file
        ds.table(t).write.mode(mode).option("maxRecordsPerFile", per).parquet(f"{path}/{t}.parquet")
        fs.delete(at, False)
    return read(spark, path)


def read(spark: SparkSession, path: str) -> Dataset:
    return Dataset(**{t: spark.read.parquet(_link(spark, path, t)) for t in TABLES})


def optimize(spark: SparkSession, path: str, tables: str | list[str] | None = None) -> None:
    """Rewrite tables sorted by id, so that row group statistics and the bloom filter find an id (O009, O020, O022).

    The new table is written beside the old one, then the link turns to it, then an old table of this
    folder is deleted: readers find a whole table at any time. Linked tables of other folders stay.
    """
    for t in wanted_tables(tables):
        old = _link(spark, path, t)
        fs, at = _fs(spark, old)
        if not fs.exists(at):
            continue
        new = f"{path}/{t}-{uuid.uuid4().hex}.parquet"
        spark.read.parquet(old).repartitionByRange("id").sortWithinPartitions("id", "pos").write.option("parquet.bloom.filter.enabled#id", "true").parquet(new)
        _set_link(spark, path, t, str(_fs(spark, new)[0].makeQualified(_fs(spark, new)[1]).toString()))
        home = str(fs.makeQualified(_fs(spark, path)[1]).toString())
        if str(fs.makeQualified(at).toString()).startswith(f"{home}/"):
            fs.delete(at, True)


def verify_order(before: DataFrame, after: DataFrame) -> None:
    """Same ids at the same positions, or an error (O227, O237, O249)."""
    a, b = before.select("pos", "id"), after.select("pos", F.col("id").alias("id_after"))
    bad = a.join(b, "pos", "full").where(~F.col("id").eqNullSafe(F.col("id_after"))).limit(1).count()
    if bad:
        raise RuntimeError("rows changed their order or ids")


# --- manifests -----------------------------------------------------------------------------------


def quoted(value: object) -> str:
    return json.dumps(str(value), ensure_ascii=False)


def now() -> str:
    return datetime.now(UTC).replace(microsecond=0).isoformat().replace("+00:00", "Z")


def _git(folder: str, *args: str) -> str:
    got = subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True)
    return got.stdout.strip() if got.returncode == 0 else ""


def revision(folder: str) -> dict[str, str]:
    """Commit, branch and remote of a folder, empty where it is in no repository (O073, O074)."""
    return {"commit": _git(folder, "rev-parse", "HEAD"), "branch": _git(folder, "rev-parse", "--abbrev-ref", "HEAD"), "remote": _git(folder, "remote", "get-url", "origin")}


def user() -> str:
    """Who runs this (O072)."""
    try:
        return getpass.getuser()
    except (KeyError, OSError):
        return ""


def _yaml(node: object, depth: int = 0) -> list[str]:
    pad = "  " * depth
    out: list[str] = []
    for k, v in node.items() if isinstance(node, dict) else ():
        if isinstance(v, dict):
            out += [f"{pad}{k}:", *_yaml(v, depth + 1)]
        elif isinstance(v, list):
            out += [f"{pad}{k}:", *(f"{pad}  - {quoted(x)}" for x in v)]
        elif isinstance(v, float):
            out.append(f"{pad}{k}: {v:.3f}")
        elif isinstance(v, bool | int):
            out.append(f"{pad}{k}: {str(v).lower() if isinstance(v, bool) else v}")
        else:
            out.append(f"{pad}{k}: {quoted(v)}")
    return out


def write_yaml(path: str, content: dict) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([*_yaml(content), ""]))


def manifest(ds: Dataset, name: str, source: str, target: str, steps: dict, artifacts: list[str] = ()) -> dict:
    """Lineage, rows and fields of a written dataset (O076)."""
    tables = {t: {"rows": ds.table(t).count(), "fields": ds.table(t).columns} for t in TABLES}
    return {"dataset": {"name": name, "created": now()}, "source": {"root": source}, "target": {"root": target}, "tables": tables, "artifacts": list(artifacts), "pipeline": steps}
