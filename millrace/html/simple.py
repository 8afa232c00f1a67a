"""Simple HTML: a short list of tags, few attributes, nothing empty. O188-O195."""

from __future__ import annotations

from millrace.html import rules as R
from millrace.html.clean import resolve_urls
from millrace.html.dom import El, serialize


def simplify(content: El, url: str = "") -> str:
    """Inner HTML of the content with only simple tags (others are unwrapped) and simple attributes."""
    resolve_urls(content, url)
    for e in reversed([x for x in content.find() if x.tag not in R.SIMPLE_TAGS and x.tag not in ("html", "head", "body")]):
        e.unwrap()
    for e in content.walk():
        keep_class = e.tag == "code" and e.get("class").startswith("language-")
        e.attrs = {k: v for k, v in e.attrs.items() if k in R.SIMPLE_ATTRIBUTES or k == "class" and keep_class}
    for e in reversed(list(content.find())):
        if e.tag not in R.SIMPLE_VOID and not any(isinstance(k, El) or k.strip() for k in e.kids):
            e.remove()
    return "".join(serialize(k) for k in content.kids)
