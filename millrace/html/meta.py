"""Title, author, date, description, url and tags of a page. O084-O093."""

from __future__ import annotations

import html
import json
import re

from millrace.html import rules as R
from millrace.html.dom import El

FIELDS = ("title", "author", "date", "description", "url", "tags")


def _linked_data(s: El | None) -> dict[str, str]:
    try:
        o = json.loads(s.text()) if s is not None else {}
    except ValueError:
        return {}
    o = o[0] if isinstance(o, list) and o else o
    if not isinstance(o, dict):
        return {}
    author = o.get("author")
    found = {
        "title": o.get("headline", o.get("name")), "date": o.get("datePublished"), "description": o.get("description"),
        "author": author.get("name") if isinstance(author, dict) else author,
    }
    return {k: v for k, v in found.items() if isinstance(v, str) and v}


def extract(root: El) -> dict[str, str]:
    """Non-empty fields. Linked data before Open Graph before named meta tags before visible text."""
    by_tag: dict[str, list[El]] = {}
    for e in root.find():
        by_tag.setdefault(e.tag, []).append(e)
    first = lambda tag, ok=lambda e: True: next((e for e in by_tag.get(tag, ()) if ok(e)), None)
    by_property: dict[str, str] = {}
    by_name: dict[str, str] = {}
    for m in by_tag.get("meta", ()):
        by_property.setdefault(m.get("property"), m.get("content"))
        by_name.setdefault(m.get("name"), m.get("content"))
    found = _linked_data(first("script", lambda e: e.get("type") == "application/ld+json"))
    title = found.get("title") or by_property.get("og:title", "")
    description = found.get("description") or by_property.get("og:description", "") or by_name.get("description", "")
    author = found.get("author") or by_name.get("author", "")
    date = found.get("date") or by_name.get("date", "")
    canonical = first("link", lambda e: e.get("rel") == "canonical")
    url = html.unescape((canonical.get("href") if canonical is not None else "") or by_property.get("og:url", ""))
    for tag in ("h1", "h2"):  # a classed h1 overrides; an h2 only stands in
        for c in R.TITLE_CLASSES:
            h = first(tag, lambda e, c=c: e.has(c))
            if h is not None:
                title = h.text().strip()
                break
        if title:
            break
    if not title and (t := first("title")) is not None:
        title = re.split(r"\s*[|–—―−-]\s+", t.text().strip(), maxsplit=1)[0].strip()
    if not date and (t := first("time", lambda e: "datetime" in e.attrs)) is not None:
        date = t.get("datetime")
    if not author:
        by = next((e for tag in ("p", "span", "div") if (e := first(tag, lambda x: x.has("author"))) is not None), None)
        if by is not None:
            author = (by.first(where=lambda e: e.has("username")) or by).text().strip()
    box = first("div", lambda e: e.get("id") == "mw-normal-catlinks")
    links = [a for ul in box.find("ul") for li in ul.elements() if li.tag == "li" for a in li.elements() if a.tag == "a"] if box is not None else []
    names = [n for n in (a.text().strip() for a in links) if n and not R.STUB_CATEGORY.search(n)]
    all_ = {"title": title, "author": author, "date": date, "description": description, "url": url, "tags": ", ".join(names)}
    return {k: v for k, v in all_.items() if v}


def is_wiki(url: str) -> bool:
    return bool(R.WIKI_HOST.search(url))


def front_matter(meta: dict[str, str], more: dict[str, str] | None = None) -> str:
    """YAML block of the fields in fixed order; ``more`` gives lines after them, as they are (O165)."""
    if not meta:
        return ""
    out = ["---"]
    for k in (*FIELDS, "remove_ref"):
        v = meta.get(k)
        if v is None:
            continue
        if k == "tags" and v:
            out += ["tags:", *(f"  - {t.strip()}" for t in v.split(", ") if t.strip())]
        else:
            out.append(f'{k}: "{v}"' if re.search(r"[:#{}\[\]|>&*!]", v) or v[:1] in "'\"" and v else f"{k}: {v}")
    out += [f"{k}: {v}" for k, v in (more or {}).items()]
    return "\n".join([*out, "---"]) + "\n\n"
