"""First row wins, and ordered merging of label rows. O051-O057.

Winners are found on (id, pos) alone. The rows to drop are then written as one short list of row
numbers per file of the wide table, and the wide table is filtered where it is read, each task with
the list of its own file. So image bytes are read once and never shuffled, and nothing reaches the
driver, however many rows are repeated.
"""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ranking import ranked
from millrace.sources.tables import materialize, shared_dir

BUCKET = 1_000_000


def first_rows(df: DataFrame, key: str = "id") -> DataFrame:
    """(key, first_pos, n_rows) of each key (O051)."""
    return df.groupBy(key).agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n_rows"))


def first_seen_order(df: DataFrame, key: str = "id") -> DataFrame:
    """(key, first_pos, n_rows, ordinal): keys numbered by their first position (O051, O054).

    Numbered within ranges of positions and shifted by the ranges before, so no task orders all keys.
    """
    first = first_rows(df, key).withColumn("_b", F.floor(F.col("first_pos") / BUCKET))
    sizes = first.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))  # a row per million positions
    shift = sizes.select("_b", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_b").orderBy("first_pos"))
    return first.withColumn("_own", own).join(shift, "_b").select(key, "first_pos", "n_rows", (F.col("_before") + F.col("_own") - 1).alias("ordinal"))


def row_positions(df: DataFrame, key: str = "id") -> DataFrame:
    """(key, pos, nth): every row's number within its key (O052), as rows, not as lists.

    A hot key is numbered in ranges of positions, each in a task of its own.
    """
    rows = ranked(df.select(key, "pos"), [key], F.floor(F.col("pos") / BUCKET), "pos")
    return rows.select(key, "pos", (F.col("rank") + 1).cast("int").alias("nth"))


def repeated_rows(df: DataFrame, key: str = "id") -> DataFrame:
    """(pos) of the rows that are not the first of their key."""
    again = first_rows(df.select(key, "pos"), key).where("n_rows > 1")
    return df.select(key, "pos").join(again, key).where("pos > first_pos").select("pos")


def keep_first(df: DataFrame, key: str = "id") -> DataFrame:
    """``df`` without repeated rows (O055).

    A table read from files is filtered in its scan, by row numbers; the lists are in the shared
    folder, which the Python workers read with pyarrow. Any other frame meets the list in a join on
    ``pos``, which shuffles it.
    """
    try:
        rows = df.select(key, "pos", F.md5(F.col("_metadata.file_path").cast("binary")).alias("f"), F.col("_metadata.row_index").alias("row"))
        wide = df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_row", F.col("_metadata.row_index"))
    except AnalysisException:
        return df.join(repeated_rows(df, key), "pos", "left_anti").select(*df.columns)
    again = first_rows(df.select(key, "pos"), key).where("n_rows > 1").select(F.col(key).alias("k"), "first_pos")
    drop = rows.join(again, (F.col(key) == F.col("k")) & (F.col("pos") > F.col("first_pos"))).select("f", "row")
    store = f"{shared_dir(df.sparkSession)}/repeats-{uuid.uuid4().hex}"
    drop.repartition("f").write.partitionBy("f").parquet(store)

    @F.pandas_udf(T.BooleanType())
    def first(file: pd.Series, row: pd.Series) -> pd.Series:
        out = np.ones(len(row), dtype=bool)
        for f in file.unique():
            lost = _repeats(store, hashlib.md5(f.encode()).hexdigest())
            out &= ~((file == f).to_numpy() & np.isin(row.to_numpy(), lost))
        return pd.Series(out)

    return wide.where(first("_file", "_row")).select(*df.columns)


@functools.lru_cache(4)
def _repeats(store: str, file: str) -> np.ndarray:
    """Row numbers of a file that are repeated rows; as many as the file has rows at most."""
    fs, path = pyarrow.fs.FileSystem.from_uri(store) if "://" in store else (pyarrow.fs.LocalFileSystem(), store.removeprefix("file:"))
    found = fs.get_file_info(pyarrow.fs.FileSelector(f"{path}/f={file}", allow_not_found=True))
    parts = [pq.read_table(x.path, columns=["row"], filesystem=fs).column("row").to_numpy() for x in found if x.path.endswith(".parquet")]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.int64)


def hash_conflicts(images: DataFrame) -> DataFrame:
    """Later rows of an image whose hash differs from its first row's; a null hash is an empty one (O055)."""
    rows = images.select("id", "pos", F.coalesce("sha256", F.lit("")).alias("sha"))
    first = rows.groupBy("id").agg(F.min("pos").alias("first_pos"), F.min_by("sha", "pos").alias("first_sha256"), F.count(F.lit(1)).alias("n"))
    return (
        rows.join(first.where("n > 1"), "id")
        .where("pos > first_pos and sha <> first_sha256")
        .select(F.lit("images_sha256_conflict").alias("type"), F.col("id").alias("image_id"), "first_sha256", F.col("sha").alias("duplicate_sha256"), "pos")
    )


def data_conflicts(labels: DataFrame) -> DataFrame:
    """Later rows of a label whose data differs from the first row's, where both say something (O057)."""
    rows = labels.select("id", "pos", F.coalesce("data", F.lit("")).alias("data"))
    first = rows.groupBy("id").agg(F.min("pos").alias("first_pos"), F.min_by("data", "pos").alias("first_data"), F.count(F.lit(1)).alias("n"))
    return (
        rows.join(first.where("n > 1 and first_data <> ''"), "id")
        .where("pos > first_pos and data <> '' and data <> first_data")
        .select(F.lit("image_labels_data_conflict").alias("type"), F.col("id").alias("image_id"), "first_data", F.col("data").alias("duplicate_data"), "pos")
    )


def merged_tags(labels: DataFrame) -> DataFrame:
    """(id, tags): the distinct non-empty tags of all rows, in the order they are first seen."""
    rows = labels.select("id", "pos", F.posexplode("tags").alias("k", "tag")).where("tag is not null and tag <> ''")
    first = rows.groupBy("id", "tag").agg(F.min(F.struct("pos", "k")).alias("at"))
    return first.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "tag"))).alias("t")).select("id", F.col("t.tag").alias("tags"))


def _canonical(info: str | None) -> str:
    try:
        o = json.loads(info) if info else {}
    except ValueError:
        o = {}
    o = dict(o) if isinstance(o, dict) else {}
    o.pop("info_addtional", None)
    return json.dumps(o, ensure_ascii=False, sort_keys=True)


@F.pandas_udf(T.StringType())
def canonical_info(info: pd.Series) -> pd.Series:
    """The object with sorted keys and without its earlier variants; ``{}`` for anything else (O056)."""
    return info.map(_canonical)


def info_variants(labels: DataFrame) -> DataFrame:
    """(id, variant, first_pos) of each distinct info of an id: one row per variant, so hot ids stay spread."""
    return labels.select("id", "pos", canonical_info("info").alias("variant")).groupBy("id", "variant").agg(F.min("pos").alias("first_pos"))


#: Other variants of an info in one row of merged labels.
PART = 500


def _with_variants(info: str | None, more: list[str], strict: bool) -> str:
    """``info`` with a list of variants. A broken one is an error where ``strict``, as its variants can't be told."""
    try:
        o = json.loads(info) if info else {}
    except ValueError:
        if strict:
            raise
        o = {}
    o = o if isinstance(o, dict) else {}
    o["info_addtional"] = more
    return json.dumps(o, ensure_ascii=False)


_MERGED = "pos long, id string, part int, info string, data string, tags array<string>, n_rows string, n_variants string"


def _merge_few(strict: bool):
    """Whole groups: (id, rows by position, tags)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, rows, tags in zip(b["id"], b["rows"], b["tags"]):
                first = rows[0]
                variants = list(dict.fromkeys(_canonical(r["info"]) for r in rows))
                info = _with_variants(first["info"], variants[1:], strict)
                out.append((first["pos"], i, 0, info, first["data"] or "", [] if tags is None else list(tags), str(len(rows)), str(len(variants))))
            yield pd.DataFrame(out, columns=["pos", "id", "part", "info", "data", "tags", "n_rows", "n_variants"])

    return run


def _merge_parts(strict: bool):
    """Parts of groups: the record with its first variants, or further variants alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            info = [_with_variants(i, [] if m is None else list(m), strict) for i, m in zip(b["info"], b["more"])]
            yield b.assign(info=info).drop(columns="more")

    return run


def merge_labels(labels: DataFrame, strict: bool = True, per_part: int = PART) -> DataFrame:
    """One record per id: first data, tags in order, the first info with all other variants under
    ``info_addtional`` as JSON strings (O057).

    ``pos`` is the first position; rows without an id belong to no group. With ``strict`` a first row
    with broken info fails the job; without it counts as an empty object. The list holds the variants
    in the order they are first met. What is beyond ``per_part`` of them follows in rows of the same
    id with ``part`` 1, 2 ...: each has the next ``per_part`` variants as its only content and the
    position of the first of them. So the record of any id with up to ``per_part`` other variants is
    the row with part 0, the lists of an id in the order of ``part`` are the whole list, and no cell,
    task or reducer holds more than ``per_part`` variants, however often an id comes. ``n_rows`` and
    ``n_variants`` (the first one included) are the id's, and null in later parts.

    An id of up to ``per_part`` rows is merged where its rows meet, after one shuffle. The few ids of
    more rows are found by counting first; their variants are numbered in ranges of positions.
    """
    labels = labels.where("id is not null")
    often = materialize(labels.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > per_part).select("id"), "often")
    few, many = labels.join(often, "id", "left_anti"), labels.join(often, "id", "left_semi")
    groups = few.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "info", "data"))).alias("rows"))
    whole = groups.join(merged_tags(few), "id", "left").select("id", "rows", "tags").mapInPandas(_merge_few(strict), _MERGED)

    variants = materialize(info_variants(many), "variants")
    head = many.groupBy("id").agg(F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n_rows"), F.min_by(F.struct("info", "data"), "pos").alias("first"))
    counts = variants.groupBy("id").agg(F.count(F.lit(1)).alias("n_variants"))
    nth = ranked(variants, ["id"], F.floor(F.col("first_pos") / BUCKET), "first_pos", "variant").where("rank > 0")
    lists = nth.groupBy("id", F.floor((F.col("rank") - 1) / per_part).cast("int").alias("part")).agg(
        F.min("first_pos").alias("at"), F.array_sort(F.collect_list(F.struct("rank", "variant"))).alias("v")
    )
    lists = lists.select("id", "part", "at", F.col("v.variant").alias("more"))
    rows = head.join(counts, "id").join(merged_tags(many), "id", "left").withColumn("part", F.lit(0)).join(lists, ["id", "part"], "full")
    rows = rows.select(
        F.coalesce("pos", "at").alias("pos"), "id", "part", F.col("first.info").alias("info"), "more", F.coalesce("first.data", F.lit("")).alias("data"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), F.col("n_rows").cast("string"), F.col("n_variants").cast("string"),
    )
    # nullable whole numbers would reach pandas as floats, so they travel as text
    done = whole.unionByName(rows.mapInPandas(_merge_parts(strict), _MERGED))
    return done.withColumn("n_rows", F.col("n_rows").cast("long")).withColumn("n_variants", F.col("n_variants").cast("int"))
