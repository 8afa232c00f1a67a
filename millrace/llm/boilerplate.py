"""Main text of web pages, told from page furniture by a minimum cut.

Every line that shows text is a node. The source stands for the article, the sink for furniture:

* terminal capacities come from a naive Bayes classifier, fitted on a bounded sample of pages whose
  own semantic markup (``nav``, ``footer``, ``aside``, ``role``, against ``main`` and ``article``)
  labels their lines. It has two voices of limited strength: the words and the shape of the line, and
  its surroundings: tags and class names around it, how much of it is linked, whether it stands in the
  container of the title. No name or place is known beforehand; all their weights are learned;
* adjacency edges join neighbouring lines, DOM edges join lines with the node of their innermost
  container, and that node with the container around it. A container is held to what its place, in
  the article's container or outside of it, says. So a line that says little, or that two voices
  dispute, goes where the lines around it go.

The cut of least cost separates article and furniture; maximum flow finds it exactly. Nodes whose
terminal capacity is worth more than all their edges are settled beforehand (they keep their side in
every minimum cut), which leaves small graphs.

Pages captured as text have no DOM: there neighbours joined without an empty line stand close.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import lookalikes

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|head)\b.*?(?:</\1\s*>|\Z)|<!?(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
CONTAINERS = frozenset("div section article main header footer aside nav table ul ol dl form fieldset center body details dialog".split())
_VOID = frozenset("br img hr input meta link source wbr area base col embed param track".split())
_CLOSED_BY = {"li": {"li"}, "p": {"p"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
#: Semantic markup of furniture, which labels lines in training.
_FURNITURE_TAG = frozenset("nav footer aside button select form dialog".split())
_FURNITURE_ROLE = re.compile(r"navigation|banner|contentinfo|complementary|search|dialog|menu|toolbar|tablist|alert")
#: Tags that say something about the lines in them.
_TELLING = frozenset("nav header footer aside section form button dialog select li dt dd td th caption h1 h2 h3 h4 h5 h6 p blockquote figure figcaption pre center font".split())
#: Links that act on the page instead of leading to another: edit, print, share, log in, top.
_ACTION = re.compile(r"href\s*=\s*[\"']?[^\"'>\s]*?(?:[/?&#]|action=)(?:edit|print|share|login|signup|top)(?![a-z])", re.I)
#: Elements around a line whose tags and names count.
AROUND = 4
_WORD = re.compile(r"[一-鿿]+|[^\W\d_一-鿿]+|\d+|[|/·•>©\[\]]")
_FIELD = re.compile(r"\s*[^\s:：][^:：]{0,40}[:：]\s*\S")
_HAN = re.compile(r"[一-鿿]")
_SHOWS = re.compile(r"[^\s​-‏ - ⁠-⁯﻿\xad]")

#: Documented bound of the training sample, in pages looked at, of which the ones with semantic markup are used.
TRAIN_PAGES = 40_000
#: Strength of edges in the unit of the classifier's log odds: captured lines near each other or apart; lines in one container or not, with it, and it with the next.
NEAR, APART, BESIDE, CROSS, HUB, UP = 1.5, 0.5, 0.4, 0.2, 0.5, 0.3
#: Weight from which a short line is a known heading of articles.
FAMILIAR = 2.0
#: Occurrences at which a token has half of its say.
SHRINK = 8.0
#: The most that the words and the surroundings of a line can say, and what is known of the title and before it.
LIMIT, SURROUNDINGS, BEFORE_TITLE, TITLE = 5.0, 5.0, 4.0, 9.0
#: The most that words say for the article.
PROSE = 5.0
#: Part of what its place says about lines that a container itself is held to.
BOX = 0.5


class Line:
    """``box``: innermost container; ``around``: for each of the elements around its container (-1 if it is none) and tokens; ``linked``: characters in
    links, ``acting`` those in links that act on the page; ``weak``: what semantic markup says, True for
    furniture, None for nothing."""

    __slots__ = ("no", "text", "box", "around", "linked", "acting", "weak", "gap")

    def __init__(self, no: int, box: int, around: tuple = (), weak: bool | None = None):
        self.no, self.box, self.around, self.weak, self.text, self.linked, self.acting, self.gap = no, box, around, weak, "", 0, 0, False


def html_lines(data: str) -> tuple[list[Line], list[int], int]:
    """Lines that show text, the parent of each container (-1: none), and the container of the first h1."""
    lines: dict[int, Line] = {}
    parents = [-1]
    # tag, container, semantic label, hidden, tokens of the elements around, in a link (2: one that acts)
    stack: list[tuple[str, int, bool | None, bool, tuple, int]] = [("", 0, None, False, (), 0)]
    no, at, h1 = 0, 0, -1

    def put(text: str) -> None:
        nonlocal no
        if not text:
            return
        _, box, weak, hidden, around, link = stack[-1]
        parts = text.split("\n") if "\n" in text else [text]
        for k, part in enumerate(parts):
            if k:
                no += 1
            if not hidden and part and not part.isspace():
                ln = lines.get(no)
                if ln is None:
                    lines[no] = ln = Line(no, box, around, weak)
                ln.text += part
                if link:
                    ln.linked += len(part)
                    ln.acting += len(part) if link > 1 else 0

    for m in _PIECE.finditer(data):
        put(data[at : m.start()])
        at = m.end()
        name = m.group(3)
        if name is None:
            no += m.group().count("\n")
            continue
        tag = name.lower()
        attrs = m.group(4)
        if "\n" in attrs:
            no += attrs.count("\n")
        if m.group(2):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in CONTAINERS and tag not in CONTAINERS:
                    break
            continue
        if tag in _VOID or m.group().startswith("<!"):
            continue
        if tag in _CLOSED_BY:
            shut = _CLOSED_BY[tag]
            while len(stack) > 1 and stack[-1][0] in shut:
                stack.pop()
        elif stack[-1][0] == "p" and (tag in CONTAINERS or tag in ("h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "figure", "pre")):
            stack.pop()
        _, box, weak, hidden, around, link = stack[-1]
        if tag in CONTAINERS:
            parents.append(box)
            box = len(parents) - 1
        elif tag in ("td", "th") and no in lines:
            lines[no].text += " "
        own = [f"<{tag}"] if tag in _TELLING else []
        furniture = tag in _FURNITURE_TAG or tag == "header" and weak is not False
        if attrs and not attrs.isspace():
            for a in _ATTR.finditer(attrs):
                key = a.group(1).lower()
                val = (a.group(2) or a.group(3) or a.group(4) or "").lower()
                if key == "role":
                    furniture = furniture or bool(_FURNITURE_ROLE.search(val))
                    own.append(f"role={val}")
                elif key in ("class", "id"):
                    own += [f".{w}" for w in val.split()]
                elif key == "style":
                    hidden = hidden or "display:none" in val.replace(" ", "") or "visibility:hidden" in val.replace(" ", "")
                elif key == "hidden" or val == "true":
                    hidden = hidden or key == "hidden"
        if furniture:
            weak = True
        elif tag in ("main", "article"):
            weak = False
        if own:
            around = (*around[-AROUND + 1 :], (box if tag in CONTAINERS else -1, *own))
        if tag == "h1" and h1 < 0:
            h1 = box
        stack.append((tag, box, weak, hidden, around, link if tag != "a" else 2 if _ACTION.search(attrs) else 1))
    put(data[at:])
    out = []
    for ln in lines.values():
        if "&" in ln.text:
            ln.text = html.unescape(ln.text)
        if _SHOWS.search(ln.text):
            out.append(ln)
    return out, parents, h1


def text_lines(data: str) -> list[Line]:
    """Lines of a page captured as text; ``gap`` tells that an empty line stands before."""
    out, gap = [], False
    for no, t in enumerate(data.split("\n")):
        if _SHOWS.search(t):
            ln = Line(no, 0)
            ln.text, ln.gap = t, gap
            out.append(ln)
            gap = False
        else:
            gap = True
    return out


def tokens(text: str, site: str) -> set[str]:
    """Words and shape of a line. Digits fold, words of the site's host name stand for the site."""
    s = lookalikes.classes(text).strip()
    found = set()
    for w in _WORD.findall(s.lower()):
        c = w[0]
        if c.isdigit():
            found.add("0")
        elif "一" <= c <= "鿿":
            found.update(w[i : i + 2] for i in range(len(w) - 1))
        elif len(w) > 3 and w in site:
            found.add("@site")
        else:
            found.add(w)
    words = s.count(" ") + 1 + len(_HAN.findall(s)) // 3
    last = s[-1:]
    end = "." if last in ".。!?！？”" else ":" if last in ":：" else "0" if last.isdigit() else ")" if last == ")" else "a"
    size = "1" if words == 1 else "2" if words < 4 else "4" if words < 8 else "8" if words < 14 else "14"
    found.add(f"@{size}{end}")
    first = s[:1]
    if first in "-*•·–":
        found.add("@bullet")
    if len(s) <= 60 and words <= 10:
        low = re.sub(r"\d+", "0", s.lower())
        if "@site" in found:
            low = re.sub(r"[^\W\d_一-鿿]{4,}(?: 0)?", lambda m: "@" if m.group().removesuffix(" 0") in site else m.group(), low)
        found.add("=" + low)
    if words >= 8 and (m := re.match(r"[^\s:]+(?: [^\s:]+)?: ", s)) and m.end() < 32:
        found.add("@teaser")
    return found


def _shape(text: str) -> str:
    s = text.strip()
    return "bullet" if s[:1] in "-*•·–" else "sentence" if s[-1:] in ".。!?！？”" or len(s) > 60 else "short"


def surroundings(ln: Line, inside: list[bool] | None, holds: set[int]) -> set[str]:
    """Tokens of what is around a line of an HTML page, and how it stands to the article's container.

    That container and those that hold it are around all of the article, whatever they are named, so
    their names say nothing about a line.
    """
    found = {t for box, *own in ln.around if box not in holds for t in own}
    link = "linked" if ln.linked > 0.9 * len(ln.text.strip()) else "links" if ln.linked else "plain"
    found.add(f"~{link}" if inside is None else f"~inside {link}" if inside[ln.box] else f"~outside {link}")
    return found


def _around_article(parents: list[int], main: int) -> tuple[list[bool] | None, set[int]]:
    """Which containers are the article's or in it (None where that is the whole page), and which hold it."""
    holds = set()
    b = main
    while b > 0:
        holds.add(b)
        b = parents[b]
    if main <= 0:
        return None, holds
    inside = [False] * len(parents)
    for b in range(main, len(parents)):
        inside[b] = b == main or inside[parents[b]]
    return inside, holds


class Classifier:
    """Naive Bayes log odds of furniture (positive) against article (negative), per token."""

    def __init__(self, weights: dict[str, float], prior: float = 0.0):
        self.weights, self.prior = weights, prior

    @classmethod
    def of_counts(cls, counts: dict[str, tuple[int, int]]) -> Classifier:
        """From token -> (article lines, furniture lines) that have it; ``""`` stands for all lines."""
        n = counts.get("", (0, 0))
        w = {}
        for t, (b, a) in counts.items():
            if t and a + b > 1:  # rare tokens, names above all, have little say
                odds = math.log((a + 0.3) / (n[1] + 2)) - math.log((b + 0.3) / (n[0] + 2))
                w[t] = max(-5.0, min(5.0, odds)) * (a + b) / (a + b + SHRINK)
        return cls(w)

    def known(self, toks: set[str]) -> float | None:
        """Weight of a whole short line, where it was seen in training."""
        return next((self.weights.get(t) for t in toks if t[0] == "="), None)

    def score(self, toks: set[str]) -> float:
        """What the words of a line say."""
        g = self.weights.get
        known = self.known(toks)
        if known is not None:  # it speaks for itself
            return max(-LIMIT, min(LIMIT, 1.5 * known))
        if not any(t in self.weights for t in toks if t[0] != "@"):
            return 0.0  # the shape alone has no say
        return max(-PROSE, min(LIMIT, self.prior + sum([g(t, 0.0) for t in toks])))

    def around(self, toks: set[str]) -> float:
        """What the surroundings of a line say."""
        g = self.weights.get
        return max(-SURROUNDINGS, min(SURROUNDINGS, sum([g(t, 0.0) for t in toks])))


def weak_labels(data: str, site: str) -> Iterator[tuple[set[str], bool]]:
    """Labelled lines of a page with semantic markup: what is outside its article is furniture."""
    lines, parents, h1 = html_lines(data)
    inside, holds = _around_article(parents, _main_box(lines, [-1.0] * len(lines), parents, h1))
    for ln in lines:
        yield tokens(ln.text, site) | surroundings(ln, inside, holds), ln.weak is not False or 2 * ln.acting >= len(ln.text.strip())


def min_cut(unary: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """True for the nodes on the sink side of a minimum cut.

    ``unary[i]`` > 0 is the capacity towards the sink, < 0 towards the source. Ties fall to the
    source. Settles persistent nodes first, then augments shortest paths.
    """
    n = len(unary)
    u = list(unary)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), w in edges.items():
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # persistency: a terminal worth more than all edges decides
        i = todo.popleft()
        if side[i] is not None or abs(u[i]) < sum(near[i].values()):
            continue
        s = u[i] > 0
        side[i] = s
        for j, w in near[i].items():
            u[j] += w if s else -w
            del near[j][i]
            todo.append(j)
        near[i] = {}
    left = [i for i in range(n) if side[i] is None]
    if left:
        cap: dict[int, dict[int, float]] = {i: dict(near[i]) for i in left}
        src = {i: -u[i] for i in left if u[i] < 0}
        snk = {i: u[i] for i in left if u[i] > 0}
        while True:  # breadth-first augmentation from all nodes with source capacity left
            back: dict[int, int] = {i: -1 for i, c in src.items() if c > 1e-9}
            queue = deque(back)
            hit = -1
            while queue:
                i = queue.popleft()
                if snk.get(i, 0.0) > 1e-9:
                    hit = i
                    break
                for j, c in cap[i].items():
                    if c > 1e-9 and j not in back:
                        back[j] = i
                        queue.append(j)
            if hit < 0:
                break
            path = [hit]
            while back[path[-1]] >= 0:
                path.append(back[path[-1]])
            f = min([src[path[-1]], snk[hit], *(cap[b][a] for a, b in zip(path, path[1:]))])
            src[path[-1]] -= f
            snk[hit] -= f
            for a, b in zip(path, path[1:]):
                cap[b][a] -= f
                cap[a][b] = cap[a].get(b, 0.0) + f
        # ties to the source: the sink side is what reaches a sink with capacity left
        reach = {i for i, c in snk.items() if c > 1e-9}
        queue = deque(reach)
        while queue:
            i = queue.popleft()
            for j in cap[i]:
                if j not in reach and cap[j].get(i, 0.0) > 1e-9:
                    reach.add(j)
                    queue.append(j)
        for i in left:
            side[i] = i in reach
    return [bool(x) for x in side]


def _plain(s: str) -> str:
    return re.sub(r"\W+", " ", lookalikes.classes(s).lower()).strip()


def label(data: str, is_html: bool, title: str | None, site: str, model: Classifier) -> tuple[list[Line], list[bool]]:
    """Lines of a page and whether each is furniture."""
    if is_html:
        lines, parents, h1 = html_lines(data)
    else:
        lines, parents, h1 = text_lines(data), [-1], -1
    if not lines:
        return [], []
    toks = [tokens(ln.text, site) for ln in lines]
    scores = [model.score(t) for t in toks]
    n = len(lines)
    unary = list(scores)
    kinds = [_shape(ln.text) for ln in lines] if not is_html else []
    for i, k in enumerate(kinds):
        if k == "bullet":
            unary[i] -= 0.5
        elif k == "short" and -FAMILIAR < (model.known(toks[i]) or 0.0) and not _FIELD.match(lines[i].text):
            unary[i] = max(unary[i], 0.0)  # a name alone may be a heading, a menu entry or a link: what is around it decides
    want = _plain(title) if title else ""
    at = next((i for i, ln in enumerate(lines) if want and len(ln.text) < len(title) + 40 and _plain(ln.text) == want and (h1 < 0 or ln.box == h1)), -1)
    if is_html:
        inside, holds = _around_article(parents, _main_box(lines, scores, parents, h1 if h1 >= 0 else lines[at].box if at >= 0 else -1))
        for i, ln in enumerate(lines):
            unary[i] += model.around(surroundings(ln, inside, holds))
    if at >= 0:
        unary[at] -= TITLE
        if not is_html:
            for i in range(at):
                unary[i] += BEFORE_TITLE
    edges: dict[tuple[int, int], float] = {}
    for i in range(1, n):
        a, b = lines[i - 1], lines[i]
        if is_html:
            edges[(i - 1, i)] = BESIDE if a.box == b.box else CROSS
        else:
            edges[(i - 1, i)] = APART * (0.5 if b.gap else 1) if b.gap or kinds[i - 1] != kinds[i] else NEAR
    if is_html:  # container nodes
        node: dict[int, int] = {}

        def hub(box: int) -> int:
            if box not in node:
                at = box
                while at > 0 and at not in node:
                    node[at] = len(unary)
                    place = "" if inside is None or at in holds else "~inside plain" if inside[at] else "~outside plain"
                    unary.append(BOX * model.weights.get(place, 0.0))
                    at = parents[at]
                at = box
                while (p := parents[at]) > 0 and (node[p], node[at]) not in edges:
                    edges[(node[p], node[at])] = UP
                    at = p
            return node[box]

        for i, ln in enumerate(lines):
            if ln.box > 0:
                edges[(i, hub(ln.box))] = HUB
    return lines, min_cut(unary, edges)[:n]


def _main_box(lines: list[Line], scores: list[float], parents: list[int], start: int) -> int:
    """The container of the article: the lowest around the title with a fair share of the prose, else the lowest holding most of it."""
    mass = [0.0] * len(parents)
    for ln, s in zip(lines, scores):
        if s < 0:
            w = float(len(ln.text))
            b = ln.box
            while b >= 0:
                mass[b] += w
                b = parents[b]
    if start >= 0:
        b = start
        while b > 0 and mass[b] < 0.25 * mass[0]:
            b = parents[b]
        return b
    best = 0
    for b in range(1, len(parents)):
        if mass[b] >= 0.6 * mass[0] > 0:
            best = b
    return best


# --- distributed operator ------------------------------------------------------------------------


_MARKED = re.compile(r"<(?:nav|footer)\b", re.I), re.compile(r"<(?:main|article)\b", re.I)


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, article lines, furniture lines) of the marked pages of a partition; an empty token counts all lines."""
    counts = (Counter(), Counter())
    for b in batches:
        for site, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if all(r.search(data) for r in _MARKED):
                for toks, furniture in weak_labels(data, (site or "").lower()):
                    counts[furniture].update(toks)
                    counts[furniture][""] += 1
    words = sorted(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array([counts[0][w] for w in words], pa.int64()), pa.array([counts[1][w] for w in words], pa.int64())], names=["token", "article", "furniture"]
    )


def fit(pages: DataFrame, pos: Column, site: Column, data: Column, n_rows: int, train_pages: int = TRAIN_PAGES) -> Classifier:
    """Fit on the semantically marked ones of about ``train_pages`` pages, chosen by a hash of their position.

    ``n_rows``: rows of the table behind ``pages``. Lines are labelled and counted where the pages are;
    the driver gets the counts of tokens seen at least twice, which the bound of the sample bounds,
    whatever the size of the table. A table without marked pages gives a classifier without an
    opinion, and then nothing but the title and what stands before it is told apart.
    """
    part = min(1.0, train_pages / max(n_rows, 1))
    low = F.xxhash64(pos) < int(-(2**63) + part * (2**64 - 1)) if part < 1 else F.lit(True)
    parts = pages.where(low).select(site.alias("site"), data.alias("data")).mapInArrow(_token_counts, "token string, article long, furniture long")
    sums = parts.groupBy("token").agg(F.sum("article").alias("article"), F.sum("furniture").alias("furniture")).where("article + furniture > 1")
    return Classifier.of_counts({r["token"]: (r["article"], r["furniture"]) for r in sums.collect()})


def _label(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            poss, nos = [], []
            for pos, site, title, is_html, data in zip(*(b.column(i).to_pylist() for i in range(5))):
                lines, side = label(data, is_html, title, (site or "").lower(), model)
                for ln, s in zip(lines, side):
                    if s:
                        poss.append(pos)
                        nos.append(ln.no)
            yield pa.RecordBatch.from_arrays([pa.array(poss, pa.int64()), pa.array(nos, pa.int64())], names=["pos", "line_no"])

    return run


def furniture(pages: DataFrame, pos: Column, site: Column, title: Column, is_html: Column, data: Column, n_rows: int, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(pos, line_no) of the furniture lines. Null, empty and blank pages have none; repeated rows are labelled one by one."""
    pages = pages.select(pos.cast("long").alias("pos"), site.alias("site"), title.alias("title"), is_html.alias("is_html"), data.alias("data")).where(F.col("data").rlike(r"\S"))
    model = fit(pages.where("is_html"), F.col("pos"), F.col("site"), F.col("data"), n_rows, train_pages)
    return pages.mapInArrow(_label(model), "pos long, line_no long")


def _keep(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for site, title, is_html, data in zip(*(b.column(i).to_pylist() for i in range(1, 5))):
                lines, side = label(data, is_html, title, (site or "").lower(), model)
                texts.append("\n".join(" ".join(ln.text.split()) for ln, s in zip(lines, side) if not s))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["pos", "text"])

    return run


def main_text(pages: DataFrame, pos: Column, site: Column, title: Column, is_html: Column, data: Column, n_rows: int, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(pos, text): the article's lines of every page that shows text."""
    pages = pages.select(pos.cast("long").alias("pos"), site.alias("site"), title.alias("title"), is_html.alias("is_html"), data.alias("data")).where(F.col("data").rlike(r"\S"))
    model = fit(pages.where("is_html"), F.col("pos"), F.col("site"), F.col("data"), n_rows, train_pages)
    return pages.mapInArrow(_keep(model), "pos long, text string")
