"""Pages to Markdown or simple HTML, one document at a time inside Arrow batches. O077-O083.

Errors are data: a page that fails or takes too long gets empty data and a message in ``_error``.
"""

from __future__ import annotations

import html
import json
import signal
import threading
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.html import rules
from millrace.html.clean import clean, local_media
from millrace.html.dom import parse
from millrace.html.markdown import to_markdown
from millrace.html.meta import extract, front_matter, is_wiki
from millrace.html.simple import simplify


def convert(source: str, url: str = "", out_format: str = "md", remove_ref: bool = False, more: dict[str, str] | None = None, media: dict[str, str] | None = None) -> tuple[str, dict[str, str]]:
    """(text, metadata) of a page (O078). Only the asked form is made. ``media``: file names of media urls kept beside the page (O125)."""
    root = parse(source)
    meta = extract(root)
    if url:
        meta["url"] = html.unescape(url)
    wiki = is_wiki(meta.get("url", ""))
    content = clean(root, wiki, remove_ref)
    if media:
        local_media(content, media)
    if remove_ref:
        meta["remove_ref"] = "true"
    base = meta.get("url", "")
    if out_format == "html":
        return simplify(content, base), meta
    return front_matter(meta, more) + to_markdown(content, base, wiki), meta


def restore_local(text: str, url: str) -> str:
    """Undo the resolution of dataset-local references (O083)."""
    for p in rules.LOCAL_PREFIXES if url else ():
        full = urljoin(url, p)
        if full != p:
            text = text.replace(full, p)
    return text


class _Late(Exception):
    pass


def with_limit(seconds: int, f, *args):
    """Run ``f``; raises TimeoutError after that many seconds (O079-O081). No limit outside a main thread."""
    if seconds <= 0 or threading.current_thread() is not threading.main_thread():
        return f(*args)

    def late(*_):
        raise _Late

    old = signal.signal(signal.SIGALRM, late)
    signal.alarm(seconds)
    try:
        return f(*args)
    except _Late:
        raise TimeoutError from None
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, old)


def parse_pages(df: DataFrame, out_format: str = "md", remove_ref: bool = False, timeout: int = 30, strict_info: bool = True) -> DataFrame:
    """``data`` and ``info`` of HTML rows replaced, and ``_error`` beside them (O077).

    Null or empty data passes through unchanged and without a format. Broken info fails the job, as
    it can't be written back; with ``strict_info`` off it is an error of its row. Other columns stay.
    """
    if out_format not in ("md", "html"):
        raise ValueError("out_format is md or html")
    at = {n: i for i, n in enumerate(df.columns)}

    def one(data: str | None, info: str | None) -> tuple[str | None, str | None, str | None]:
        try:
            o = json.loads(info or "{}")
            if not isinstance(o, dict):
                raise ValueError("info is no object")
        except ValueError as e:
            if strict_info:
                raise
            return "", info, f"broken info: {e}"
        if not data:
            return data or "", json.dumps(o), None
        url = o.get("url") if isinstance(o.get("url"), str) else ""
        try:
            text, _ = with_limit(timeout, convert, data, url, out_format, remove_ref)
        except TimeoutError:
            return "", json.dumps(o), f"timed out after {timeout} s"
        except Exception as e:  # noqa: BLE001 - one bad page must not stop the others
            return "", json.dumps(o), f"failed: {e}"
        o["format"] = out_format
        return restore_local(text, url), json.dumps(o), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(d, i) for d, i in zip(b.column(at["data"]).to_pylist(), b.column(at["info"]).to_pylist())]
            cols = list(b.columns)
            cols[at["data"]] = pa.array([r[0] for r in rows], pa.string())
            cols[at["info"]] = pa.array([r[1] for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array([r[2] for r in rows], pa.string())], names=[*b.schema.names, "_error"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("_error", T.StringType())]))


def page_metadata(df: DataFrame) -> DataFrame:
    """(pos, title, author, date, description, url, tags, is_wiki, n_content) of HTML rows."""
    fields = ["title", "author", "date", "description", "url", "tags"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for pos, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                root = parse(data or "")
                m = extract(root)
                wiki = is_wiki(m.get("url", ""))
                rows.append({"pos": pos, **{f: m.get(f) for f in fields}, "is_wiki": wiki, "n_content": len(clean(root, wiki).text().strip())})
            kinds = pa.schema([("pos", pa.int64()), *((f, pa.string()) for f in fields), ("is_wiki", pa.bool_()), ("n_content", pa.int64())])
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    schema = "pos long, " + ", ".join(f"{f} string" for f in fields) + ", is_wiki boolean, n_content long"
    return df.select(F.col("pos").cast("long"), "data").mapInArrow(run, schema)


def image_captions(df: DataFrame) -> DataFrame:
    """(pos, url, alt, caption) of figures with an image and a caption that says something."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for pos, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for fig in parse(data or "").find("figure"):
                    cap, img = fig.first("figcaption"), fig.first("img")
                    if cap is not None and img is not None and cap.text().strip():
                        rows.append({"pos": pos, "url": img.get("src"), "alt": img.get("alt"), "caption": " ".join(cap.text().split())})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("pos", pa.int64()), ("url", pa.string()), ("alt", pa.string()), ("caption", pa.string())]))

    return df.select(F.col("pos").cast("long"), "data").mapInArrow(run, "pos long, url string, alt string, caption string")
