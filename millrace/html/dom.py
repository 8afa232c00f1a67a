"""A small HTML tree: elements whose children are elements and strings.

Built from any input by ``parse``, which closes what HTML lets stay open (paragraphs, list items,
table cells, options), ignores end tags without a start, keeps script and style text raw and always
yields one html element with a head and a body.
"""

from __future__ import annotations

import html as entities
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
HEAD_ONLY = frozenset("title meta link base script style noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: start tag -> open elements it closes, looked for up to a border
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_ENDS_PARAGRAPH = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "caption"}


class El:
    """An element; ``kids`` mixes elements and strings, a comment is an element with tag ``!``."""

    __slots__ = ("tag", "attrs", "kids", "up")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, kids: list | None = None):
        self.tag, self.attrs, self.kids, self.up = tag, attrs or {}, [], None
        for k in kids or ():
            self.add(k)

    def get(self, name: str, default: str = "") -> str:
        v = self.attrs.get(name)
        return default if v is None else v

    @property
    def classes(self) -> list[str]:
        return self.get("class").split()

    def has(self, name: str) -> bool:
        return name in self.classes

    def add(self, kid) -> None:
        if isinstance(kid, El):
            kid.up = self
            self.kids.append(kid)
        elif kid:
            if self.kids and isinstance(self.kids[-1], str):
                self.kids[-1] += kid
            else:
                self.kids.append(kid)

    def elements(self) -> list[El]:
        return [k for k in self.kids if isinstance(k, El)]

    def walk(self) -> Iterator[El]:
        """This element and all below it, in document order."""
        stack = [self]
        while stack:
            e = stack.pop()
            if e.tag == "!":
                continue
            yield e
            if e.kids:
                stack += [k for k in reversed(e.kids) if type(k) is El]

    def find(self, *tags: str, where: Callable[[El], bool] | None = None) -> Iterator[El]:
        """Elements below this one, by tag (none: any) and condition."""
        for e in self.walk():
            if e is not self and (not tags or e.tag in tags) and (where is None or where(e)):
                yield e

    def first(self, *tags: str, where: Callable[[El], bool] | None = None) -> El | None:
        return next(self.find(*tags, where=where), None)

    def text(self) -> str:
        out: list[str] = []
        stack: list = [self]
        while stack:
            k = stack.pop()
            if isinstance(k, str):
                out.append(k)
            elif k.tag != "!":
                stack.extend(reversed(k.kids))
        return "".join(out)

    def place(self) -> int:
        return next(i for i, k in enumerate(self.up.kids) if k is self)

    def beside(self, step: int):
        """The next (1) or previous (-1) child of the parent, string or element; None at the edge."""
        i = self.place() + step
        return self.up.kids[i] if 0 <= i < len(self.up.kids) else None

    def next_element(self) -> El | None:
        return next((k for k in self.up.kids[self.place() + 1 :] if isinstance(k, El)), None) if self.up else None

    def replace(self, *new) -> None:
        """Put nodes in this element's place; none removes it. Strings that meet become one."""
        p = self.up
        if p is None:
            return
        i = self.place()
        before, after = p.kids[:i], p.kids[i + 1 :]
        self.up = None
        p.kids = before
        for k in (*new, *after):
            p.add(k)

    def remove(self) -> None:
        self.replace()

    def unwrap(self) -> None:
        """Keep the children, drop the element."""
        self.replace(*self.kids)

    def inside(self, *tags: str) -> El | None:
        """The nearest element around this one with one of the tags."""
        e = self.up
        while e is not None and e.tag not in tags:
            e = e.up
        return e


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = El("html")
        self.head = El("head")
        self.body = El("body")
        self.root.add(self.head)
        self.root.add(self.body)
        self.open: list[El] = []
        self.in_body = False

    def _at(self) -> El:
        return self.open[-1] if self.open else self.body if self.in_body else self.head

    def _close(self, tags: set[str], border: set[str]) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            t = self.open[i].tag
            if t in border:
                return
            if t in tags:
                cut = i
                while cut and self.open[cut - 1].tag in tags:
                    cut -= 1
                del self.open[cut:]
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {}
        for k, v in attrs:
            a.setdefault(k, v or "")
        if tag in ("html", "head", "body"):
            target = {"html": self.root, "head": self.head, "body": self.body}[tag]
            for k, v in a.items():
                target.attrs.setdefault(k, v)
            if tag == "body":
                self.in_body = True
                self.open = []
            return
        if not self.in_body and not self.open and tag not in HEAD_ONLY:
            self.in_body = True
        if tag in _ENDS:
            self._close(*_ENDS[tag])
        elif tag in _ENDS_PARAGRAPH:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i].tag == "p":
                    del self.open[i:]
                    break
                if self.open[i].tag in BLOCK:
                    break
        e = El(tag, a)
        self._at().add(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1].tag == tag and tag in ("svg", "path", "use", "iframe"):
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag == "head":
            self.in_body, self.open = True, []
            return
        if tag in ("html", "body", *VOID):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if tag not in BLOCK and self.open[i].tag in ("td", "th", "table", "li"):
                return  # an inline end tag closes nothing outside its cell
        if tag == "p":
            self._at().add(El("p"))

    def handle_data(self, data: str) -> None:
        if not self.in_body and not self.open:
            if data.isspace():
                return
            self.in_body = True
        self._at().add(data)

    def handle_comment(self, data: str) -> None:
        self._at().add(El("!", {"": data}))


def parse(source: str) -> El:
    b = _Builder()
    b.feed(source)
    b.close()
    return b.root


def serialize(node, raw: bool = False) -> str:
    """HTML text of a node; attributes in order, text escaped."""
    if isinstance(node, str):
        return node if raw else entities.escape(node, quote=False).replace("\xa0", "&nbsp;")
    if node.tag == "!":
        return f"<!--{node.attrs.get('', '')}-->"
    attrs = "".join(f' {k}="{entities.escape(v, quote=False).replace(chr(34), "&quot;")}"' for k, v in node.attrs.items())
    if node.tag in VOID:
        return f"<{node.tag}{attrs}>"
    return f"<{node.tag}{attrs}>{''.join(serialize(k, node.tag in RAW) for k in node.kids)}</{node.tag}>"


def copy(e: El) -> El:
    return El(e.tag, dict(e.attrs), [copy(k) if isinstance(k, El) else k for k in e.kids])
