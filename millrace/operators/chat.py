"""Markdown to one multimodal chat message, and back. O196-O208."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed

_FRONT = re.compile(fixed.FRONT_MATTER)
_OPEN = re.compile(r"\[?!\[")


def strip_front_matter(md: str) -> str:
    """O196."""
    return _FRONT.sub("", md, count=1) if md.startswith("---") else md


def local_image_id(href: str) -> str | None:
    """O197, O209."""
    href = href.strip().removeprefix("./")
    if not href.startswith("images/"):
        return None
    return re.split(r"[?#]", href[7:], maxsplit=1)[0].strip("/") or None


def _balanced(text: str, at: int) -> int:
    """Place after the parenthesis that closes the one at ``at``, or -1. A backslash escapes nothing (O198)."""
    depth = 0
    for m in re.compile(r"[()]").finditer(text, at):
        depth += 1 if m.group() == "(" else -1
        if not depth:
            return m.end()
    return -1


def _plain(md: str, at: int) -> tuple[int, str] | None:
    """``![alt](href)`` at ``at``: its end and href (O199)."""
    close = md.find("]", at + 2)
    if close < 0 or md[close + 1 : close + 2] != "(":
        return None
    end = _balanced(md, close + 1)
    return None if end < 0 else (end, md[close + 2 : end - 1])


def _image(md: str, at: int) -> tuple[int, str] | None:
    """A plain image, or one wrapped in a link, whose inner href counts (O200)."""
    if md[at] != "[":
        return _plain(md, at)
    inner = _plain(md, at + 1)
    if inner is None or md[inner[0] : inner[0] + 2] != "](":
        return None
    end = _balanced(md, inner[0] + 1)
    return None if end < 0 else (end, inner[1])


def images(md: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, href) of the images of a text, leftmost first; a failed wrapper is tried as a plain image (O201)."""
    at = 0
    while m := _OPEN.search(md, at):
        got = _image(md, m.start())
        if got is None:
            at = m.start() + 1
        else:
            yield m.start(), got[0], got[1]
            at = got[0]


def parts(md: str | None) -> tuple[list[dict], int]:
    """Text and local image parts in order, and the number of images dropped as not local (O202-O204)."""
    md = strip_front_matter(md or "")
    out: list[dict] = []
    dropped = at = 0

    def text(s: str) -> None:
        if s and out and out[-1]["type"] == "text":
            out[-1]["text"] += s
        elif s:
            out.append({"type": "text", "text": s})

    for start, end, href in images(md):
        text(md[at:start])
        at = end
        image_id = local_image_id(href)
        if image_id is None:
            dropped += 1
        else:
            out.append({"type": "image_url", "image_url": {"url": f"images/{image_id}"}})
    text(md[at:])
    return out or [{"type": "text", "text": ""}], dropped


def block_image_id(block: dict) -> str | None:
    """Id of a local image block; None for any other block."""
    ref = block.get("image_url") if block.get("type") == "image_url" else None
    url = ref.get("url") if isinstance(ref, dict) else None
    return local_image_id(url) if isinstance(url, str) else None


def image_ids(blocks: list[dict]) -> list[str]:
    """O205, O210."""
    return [i for i in map(block_image_id, blocks) if i]


def info_object(info: str | None) -> dict:
    try:
        o = json.loads(info) if info else {}
    except ValueError:
        o = {}
    return o if isinstance(o, dict) else {}


def with_images(info: dict, ids: list[str], **counts: int) -> str:
    """``info`` as it is kept beside a chat payload: image ids and counts set where there are any, else removed."""
    info["format"] = "openai"
    for k, v in {"image_ids": ids, **counts}.items():
        if v:
            info[k] = v
        else:
            info.pop(k, None)
    return json.dumps(info, ensure_ascii=False)


def to_chat(df: DataFrame, role: str = "user") -> DataFrame:
    """``data`` and ``info`` of Markdown rows become a one-message payload and its info (O206).

    Other columns stay. Null and empty texts give one empty text part; broken info counts as empty.
    Works on batch and streaming input.
    """
    at = {n: i for i, n in enumerate(df.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, infos = [], []
            for md, info in zip(b.column(at["data"]).to_pylist(), b.column(at["info"]).to_pylist()):
                blocks, dropped = parts(md)
                data.append(json.dumps([{"role": role, "content": blocks}], ensure_ascii=False))
                infos.append(with_images(info_object(info), image_ids(blocks), dropped_nonlocal_images=dropped, filtered_small_images=0))
            cols = list(b.columns)
            cols[at["data"]], cols[at["info"]] = pa.array(data, pa.string()), pa.array(infos, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return df.mapInArrow(run, df.schema)


def payload(data: str) -> tuple[list[dict], str]:
    """Blocks and role of a one-message payload; anything else is an error (O207)."""
    try:
        p = json.loads(data)
    except (TypeError, ValueError) as e:
        raise ValueError("not a JSON payload") from e
    if isinstance(p, dict):
        p = p.get("messages")
    if not isinstance(p, list) or len(p) != 1 or not isinstance(p[0], dict):
        raise ValueError("not a payload of one message")
    content = p[0].get("content")
    if not isinstance(content, list) or not all(isinstance(x, dict) for x in content):
        raise ValueError("the content is not a list of blocks")
    return content, str(p[0].get("role") or "user")


def content_parts(df: DataFrame) -> DataFrame:
    """(pos, nth, type, text, image_id): the parts of Markdown rows, one row each."""
    schema = "pos long, nth int, type string, text string, image_id string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [
                {"pos": pos, "nth": i, "type": p["type"], "text": p.get("text"), "image_id": block_image_id(p)}
                for pos, md in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                for i, p in enumerate(parts(md)[0])
            ]
            kinds = pa.schema([("pos", pa.int64()), ("nth", pa.int32()), ("type", pa.string()), ("text", pa.string()), ("image_id", pa.string())])
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return df.select(F.col("pos").cast("long"), "data").mapInArrow(run, schema)
