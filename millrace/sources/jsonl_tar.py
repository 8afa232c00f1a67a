"""Dumps of page parts: ``<part>.jsonl`` beside ``<part>.tar``. O001-O006, O034, O035.

A batch data source with one partition per part. Tar members are indexed by name and offset and read
when a page names them, so no part has to fit into memory. Rows of all three tables come from one
pass; ``pos`` orders them as the dump does (part number * 2^40 + running number).
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import tarfile
from collections.abc import Iterator

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.functions import fixed

SCHEMA = "kind string, pos long, id string, info string, data string, tags array<string>, image_bytes binary, sha256 string"
STEP = 1 << 40
_TITLE, _CANONICAL, _CATEGORY = (re.compile(x) for x in (fixed.TITLE, fixed.CANONICAL, fixed.CATEGORY))


def located(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path in it: local, or any that pyarrow knows by its scheme."""
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path.removeprefix("file:"))


def pairs(path: str) -> list[tuple[str, str]]:
    """Parts by name that have both files; a folder without any is an error (O001)."""
    fs, folder = located(path)
    files = {f.base_name for f in fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True)) if f.is_file}
    found = [n[:-6] for n in sorted(files) if n.endswith(".jsonl") and n[:-6] + ".tar" in files]
    if not found:
        raise FileNotFoundError(f"no pairs of .jsonl and .tar under {path}")
    return [(f"{path.rstrip('/')}/{n}.jsonl", f"{path.rstrip('/')}/{n}.tar") for n in found]


def said(o: dict, skip: tuple[str, ...] = ()) -> dict:
    """Members with a value: neither null nor an empty string."""
    return {k: v for k, v in o.items() if k not in skip and v is not None and v != ""}


def text_info(entry: dict, url: str, title: str, image_ids: list[str]) -> dict:
    """Derived members first, then all raw ones, which may overwrite them (O034)."""
    raw = said(entry, ("html", "images"))
    info = {"format": "html", "url": url, "title": title} | ({"image_ids": image_ids} if image_ids else {})
    info |= {k: raw[s] for k, s in (("original_url", "url"), ("final_url", "final_url")) if s in raw}
    return info | {k: v for k, v in raw.items() if k not in ("url", "final_url")}


def image_info(meta: dict, text_id: str) -> dict:
    """Raw members, the page, and short names for url and caption (O035)."""
    info = {"text_ids": [text_id]} | said(meta)
    return info | {k: meta[s] for k, s in (("url", "image_url"), ("caption", "caption_text")) if meta.get(s) not in (None, "")}


def page_meta(page: str) -> tuple[str | None, str, list[str]]:
    """Canonical url, title and category tags of raw HTML (O033)."""
    url, title = _CANONICAL.search(page), _TITLE.search(page)
    names = [c.strip() for c in _CATEGORY.findall(page)]
    return (
        url.group(1) if url else None,
        re.sub(fixed.SITE_IN_TITLE, "", title.group(1).strip()) if title else "",
        [n.replace("&amp;", "&") for n in names if not n.startswith(fixed.SKIPPED_CATEGORIES)],
    )


class Members:
    """Regular tar members by name, with and without their folder; a later one of a name wins (O003, O004)."""

    def __init__(self, path: str):
        self.part = os.path.basename(path)[:-4]
        fs, at = located(path)
        self.file = fs.open_input_file(at)
        self.at: dict[str, tuple[int, int]] = {}
        with tarfile.open(fileobj=self.file) as tar:
            for m in tar:
                if m.isfile():
                    name = m.name.removeprefix("images/")
                    self.at[f"{self.part}/{name}"] = self.at[name] = (m.offset_data, m.size)

    def read(self, name: str) -> bytes | None:
        bare = name.removeprefix("images/")
        place = self.at.get(name) or self.at.get(bare) or self.at.get(f"{self.part}/{bare}")
        if place is None:
            return None
        self.file.seek(place[0])
        return self.file.read(place[1])

    def close(self) -> None:
        self.file.close()


class Part(InputPartition):
    def __init__(self, nth: int, jsonl: str, tar: str):
        self.nth, self.jsonl, self.tar = nth, jsonl, tar


class Reader(DataSourceReader):
    def __init__(self, path: str):
        if not path or not path.strip():
            raise ValueError("the source needs a path")
        self.path = path

    def partitions(self) -> list[Part]:
        return [Part(i, j, t) for i, (j, t) in enumerate(pairs(self.path))]

    def read(self, part: Part) -> Iterator[tuple]:
        members = Members(part.tar)
        n_image = 0
        try:
            fs, at = located(part.jsonl)
            with fs.open_input_stream(at) as raw_lines:
                for no, line in enumerate(io.TextIOWrapper(io.BufferedReader(raw_lines), encoding="utf-8")):
                    if not line.strip():
                        continue
                    entry = json.loads(line)
                    page = str(entry.get("html", ""))
                    canonical, title, tags = page_meta(page)
                    text_id = hashlib.sha256(page.encode("utf-8")).hexdigest()
                    ids = []
                    for meta in entry.get("images") or []:
                        name = str(meta.get("image_file", ""))
                        raw = members.read(name) if name else None
                        if raw is None:
                            continue
                        image_id = hashlib.sha256(raw).hexdigest()
                        ids.append(image_id)
                        pos = part.nth * STEP + n_image
                        n_image += 1
                        yield ("image", pos, image_id, None, None, None, raw, image_id)
                        yield ("label", pos, image_id, json.dumps(image_info(meta, text_id), ensure_ascii=False), "{}", [], None, None)
                    url = str(entry.get("final_url", canonical or ""))
                    yield ("text", part.nth * STEP + no, text_id, json.dumps(text_info(entry, url, title, ids), ensure_ascii=False), page, tags, None, None)
        finally:
            members.close()


class JsonlTar(DataSource):
    """``spark.read.format("jsonl_tar").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "jsonl_tar"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options.get("path", ""))


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a dump; repeats are kept, blank lines and images that can't be found are not rows."""
    spark.dataSource.register(JsonlTar)
    return spark.read.format("jsonl_tar").load(path)


def write_dump(entries: DataFrame, path: str) -> None:
    """A dump from (html, image_file, image_bytes) rows, a part per partition: pages, and pages of one image each.

    ``image_file`` and ``image_bytes`` may be null. Every task writes its own part, one row at a time.
    """

    def run(batches):
        import uuid

        fs, folder = located(path)
        fs.create_dir(folder, recursive=True)
        name = f"{folder}/part-{uuid.uuid4().hex}"
        n = 0
        with fs.open_output_stream(f"{name}.jsonl") as lines, fs.open_output_stream(f"{name}.tar") as out, tarfile.open(fileobj=out, mode="w|") as tar:
            for b in batches:
                for page, file, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                    entry = {"html": page or ""}
                    if file is not None and raw is not None:
                        entry["images"] = [{"image_file": file}]
                        member = tarfile.TarInfo(f"images/{file}")
                        member.size = len(raw)
                        tar.addfile(member, io.BytesIO(raw))
                    lines.write((json.dumps(entry, ensure_ascii=False) + "\n").encode())
                    n += 1
        yield pyarrow.RecordBatch.from_arrays([pyarrow.array([n])], names=["n"])

    entries.select("html", "image_file", F.col("image_bytes").cast("binary")).mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
