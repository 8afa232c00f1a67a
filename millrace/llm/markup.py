"""Markup residue in extracted text bodies: where it is, and clean text without it.

Bodies mix Markdown, wiki, HTML and TeX markup, whatever their declared format. The operator infers
one *wrapper* per host, a union-free regular expression over markup tokens and text slots, and reads
every body through the wrapper of its host:

* a body becomes a stream of block tokens (surface forms: a line opened by ``#``, by ``<li>``, by a
  fence ...), each with the inline tokens of its text slot;
* equal neighbouring tokens fold into a repeated token (``hash`` twice or more becomes ``hash+``),
  and the stream is cut behind its text slots, which makes it a repeated group of short segments;
* segments are aligned with the group known so far. Tokens found in order match; a token missing on
  either side is resolved into an optional; text against text stays a slot. Inline tokens of matched
  slots are aligned the same way inside the slot;
* wrappers of parts of a host merge by aligning wrapper with wrapper, so a host holding a third of
  all rows is inferred in parts and merged in a tree.

Nodes keep *evidence*, summed over all bodies of the host: how often they were met, at which levels,
and how often with each inline token. Reading a body matches its segments against the group, and the
matched nodes alone give role and inline tokens; what the wrapper doesn't know is running text.

Evidence settles what a surface form leaves open, which is ``#``: an item of a numbered wiki list or
a Markdown heading. A line by itself is a heading and a run of lines a list, unless the host uses the
form otherwise (see ``meanings``). All other forms mean the same in every host.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- lexer ---------------------------------------------------------------------------------------

_FENCE = re.compile(r"^\s*(`{3,}|~{3,})(?!.*`)")
_CODE_TAG = re.compile(r"^\s*<(pre|syntaxhighlight|source)\b[^>]*>", re.I)
_CODE_ENV = re.compile(r"^\s*\\begin\{(verbatim|lstlisting|minted|Verbatim|alltt|code)\*?\}")
_MATH_ENV = re.compile(r"^\s*\\begin\{((?:equation|align|alignat|gather|multline|eqnarray|displaymath|math|flalign)\*?)\}")
_MATH_LINE = re.compile(r"^\s*(?::+\s*)?(?:<div\b[^>]*>\s*)?<math\b", re.I)
_ATX = re.compile(r"^ {0,3}(#{1,6})[ \t]+(.*?)(?:[ \t]+#+)?[ \t]*$")
_WIKI_HEAD = re.compile(r"^\s*(={1,6})\s*([^=\s].*?)\s*\1\s*$")
_TAG_HEAD = re.compile(r"^\s*<h([1-6])\b[^>]*>", re.I)
_TEX_HEAD = re.compile(r"^\s*\\(part|chapter|section|subsection|subsubsection|paragraph|subparagraph)\*?\s*(?:\[[^\]]*\])?\{")
_UNDERLINE = re.compile(r"^ {0,3}(={3,}|-{3,})\s*$")
_BULLET = re.compile(r"^\s*([-*+•]|[*#]{2,}|\*[*#]*)[ \t]+(?=\S)")
_WIKI_ITEM = re.compile(r"^([*#]{2,}|[*#]*[*][*#]*)[ \t]*(?=\S)")
_NUMBER = re.compile(r"^\s*(\d{1,9}|[a-zA-Z])[.)][ \t]+(?=\S)")
_TAG_ITEM = re.compile(r"^\s*(?:<(?:ul|ol)\b[^>]*>\s*)*<li\b[^>]*>", re.I)
_TEX_ITEM = re.compile(r"^\s*\\item\b\s*(?:\[[^\]]*\])?")
_SHELL = re.compile(r"^\s*(?:</?(?:ul|ol|dl|div|section|article|table|tbody|tr|body|p|center|blockquote)\b[^>]*>|</li>|\\(?:begin|end)\{[a-zA-Z]+\*?\}(?:\[[^\]]*\])?|\s)+$", re.I)
_BLOCK_TAG = re.compile(r"</?(?:p|div|ul|ol|li|dl|section|article|table|tbody|thead|tr|td|th|h[1-6]|center|blockquote|body)\b[^>]*>", re.I)

#: Inline tokens: name and pattern. Math comes first and is taken out before the rest is looked for.
_MATH = (
    ("math_tag", re.compile(r"<math\b[^>]*>.*?</math>", re.I)),
    ("math_par", re.compile(r"\\\(.+?\\\)|\\\[.+?\\\]")),
    ("math_dollar2", re.compile(r"\$\$[^$]+\$\$")),
    ("math_dollar", re.compile(r"(?<![\\$\w])\$(?=[^\s$])(?:[^$\n]*?[^\s\\$(\[])?\$(?![\w$])")),
)
_INLINE = (
    ("comment", re.compile(r"<!--.*?(?:-->|$)")),
    ("ref", re.compile(r"<ref\b[^<>]*?(?:/>|>[^<]*(?:<(?!ref\b|/ref>)[^<]*)*</ref>)", re.I)),
    ("code", re.compile(r"(`+)(?=[^`]).*?(?<!`)\1(?!`)")),
    ("template", re.compile(r"\{\{.*?\}\}")),
    ("image", re.compile(r"!\[[^\]]*\]\([^)\s]*(?:\s+\"[^\"]*\")?\)")),
    ("wiki_link", re.compile(r"\[\[.*?\]\]")),
    ("link", re.compile(r"\[[^\[\]]*\]\([^()\s]*(?:\([^()\s]*\)[^()\s]*)*(?:\s+\"[^\"]*\")?\)|\[[^\[\]]+\]\[[^\[\]]*\]|\[(?:https?:)?//[^\s\]]+(?:\s[^\]]*)?\]|<https?://[^\s>]+>")),
    ("note", re.compile(r"\[\^[^\]\s]+\]:?")),
    ("quotes", re.compile(r"'''''.+?'''''|'''.+?'''|''.+?''")),
    ("strong", re.compile(r"\*\*(?=[^\s*]).*?(?<=[^\s*])\*\*|(?<!\w)__(?=\S).*?(?<=\S)__(?!\w)")),
    ("strike", re.compile(r"~~(?=\S).+?(?<=\S)~~")),
    ("emphasis", re.compile(r"(?<![*\\])\*(?=[^\s*])[^*]*?(?<=[^\s*])\*(?!\*)|(?<![\w\\])_(?=[^\s_])[^_]*?(?<=[^\s_])_(?!\w)")),
    ("command", re.compile(r"~?\\[a-zA-Z]+\*?(?:\[[^\]]*\])*\{(?:[^{}]|\{[^{}]*\})*\}|\\(?:ldots|dots|LaTeX|TeX|noindent|newline|quad|qquad|textbackslash)\b|\\[%&_#${}*`\[\]]")),
    ("tag", re.compile(r"</?[a-zA-Z][a-zA-Z0-9]*(?:\s+[^<>]*)?/?>")),
    ("entity", re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});")),
)
#: What ends a token: without it in the line there is none, and no need to search from every start.
_CLOSER = {"code": "`", "template": "}}", "image": "](", "wiki_link": "]]", "note": "[^", "quotes": "''", "strike": "~~", "entity": ";", "tag": ">"}
_HINT = re.compile(r"[<\[{`'*_~\\&$]")


def inlines(text: str) -> list[str]:
    """Names of the inline tokens in a line of running text."""
    if not _HINT.search(text):
        return []
    found = []
    for name, rx in _MATH:
        text, n = rx.subn(" ", text)
        if n:
            found.append(name)
    text = _BLOCK_TAG.sub(" ", text)
    for name, rx in _INLINE:
        if name in _CLOSER and _CLOSER[name] not in text:
            continue
        text, n = rx.subn(" x ", text)
        if n:
            found.append(name)
    return found


def lex(data: str) -> list[tuple]:
    """Block tokens: (line_no, last_line, symbol, level, body text, inline names)."""
    lines = data.split("\n")
    out: list[tuple] = []
    i, n = 0, len(lines)

    def until(test, start: int, tail: bool) -> int | None:
        for j in range(start, n):
            if test(lines[j]):
                return j
        return n - 1 if tail else None

    while i < n:
        line = lines[i]
        s = line.strip()
        if not s:
            i += 1
            continue
        c = s[0]
        end = i
        if m := _FENCE.match(line) if c in "`~" else None:
            mark = m.group(1)
            close = re.compile(rf"^\s*{re.escape(mark[0])}{{{len(mark)},}}\s*$")
            end = until(close.match, i + 1, True)
            out.append((i, end, "fence", 0, "\n".join(lines[i + 1 : end]), []))
        elif c == "<" and (m := _CODE_TAG.match(line)):
            close_tag = f"</{m.group(1).lower()}>"
            end = until(lambda x: close_tag in x.lower(), i, True)
            body = "\n".join(lines[i : end + 1])
            body = html.unescape(re.sub(r"</?(?:pre|code|syntaxhighlight|source)\b[^>]*>", "", body, flags=re.I))
            out.append((i, end, "code_tag", 0, body.strip("\n"), []))
        elif c == "\\" and (m := _CODE_ENV.match(line)):
            close_env = f"\\end{{{m.group(1)}"
            end = until(lambda x: close_env in x, i, True)
            out.append((i, end, "code_env", 0, "\n".join(lines[i + 1 : end]), []))
        elif c == "\\" and (m := _MATH_ENV.match(line)):
            close_env = f"\\end{{{m.group(1)}}}"
            end = until(lambda x: close_env in x, i, True)
            out.append((i, end, "math_env", 0, "\n".join(lines[i + 1 : end]), []))
        elif s.startswith("$$"):
            if len(s) > 4 and s.endswith("$$"):
                out.append((i, i, "math_dollars", 0, s[2:-2].strip(), []))
            elif s.count("$$") == 1 and (e := until(lambda x: "$$" in x, i + 1, False)) is not None:
                end = e
                out.append((i, end, "math_dollars", 0, "\n".join([s[2:], *lines[i + 1 : end], lines[end].split("$$")[0]]).strip(), []))
            else:
                out.append((i, i, "text", 0, s, inlines(s)))
        elif s.startswith("\\["):
            e = i if "\\]" in s else until(lambda x: "\\]" in x, i + 1, False)
            if e is None or (e == i and not s.endswith("\\]")):
                out.append((i, i, "text", 0, s, inlines(s)))
            else:
                end = e
                out.append((i, end, "math_bracket", 0, "\n".join(lines[i : end + 1]).strip()[2:].split("\\]")[0].strip(), []))
        elif c in ":<" and _MATH_LINE.match(line) and ("</math>" not in s.lower() or re.fullmatch(r"(?is):*\s*(?:<div\b[^>]*>\s*)?<math\b[^>]*>.*</math>(?:\s*</div>)?[.,;]?", s)):
            e = until(lambda x: "</math>" in x.lower(), i, False)
            end = i if e is None else e
            out.append((i, end, "math_block", 0, re.sub(r"<[^<>]*>", "", "\n".join(lines[i : end + 1])).strip(": \n"), []))
        elif c == "#" and (m := _ATX.match(line)) and m.group(2):
            out.append((i, i, "hash", len(m.group(1)), m.group(2), inlines(m.group(2))))
        elif c == "=" and (m := _WIKI_HEAD.match(line)):
            out.append((i, i, "equals", len(m.group(1)), m.group(2), []))
        elif c == "<" and (m := _TAG_HEAD.match(line)):
            e = until(lambda x: re.search(rf"</h{m.group(1)}>", x, re.I), i, False)
            end = e if e is not None and e - i < 4 else i
            out.append((i, end, "h_tag", int(m.group(1)), " ".join(lines[i : end + 1]), []))
        elif c == "\\" and (m := _TEX_HEAD.match(line)):
            level = ("part", "chapter", "section", "subsection", "subsubsection", "paragraph", "subparagraph").index(m.group(1)) or 1
            out.append((i, i, "sectioning", level, s[s.index("{") + 1 :].rstrip().removesuffix("}"), []))
        elif c == "\\" and (m := _TEX_ITEM.match(line)):
            out.append((i, i, "item", 0, line[m.end() :].strip(), inlines(line[m.end() :])))
        elif c == "<" and (m := _TAG_ITEM.match(line)):
            out.append((i, i, "li", 0, line[m.end() :].strip(), inlines(line[m.end() :])))
        elif (c == "<" or c == "\\") and _SHELL.match(line):
            pass
        elif _UNDERLINE.match(line):
            pass  # a rule: underlines are taken with their heading
        elif m := _BULLET.match(line) if c in "-*+•#" else None:
            out.append((i, i, {"-": "dash", "*": "star", "+": "plus", "•": "dot", "#": "hashes"}[c], len(m.group(1)), line[m.end() :].strip(), inlines(line[m.end() :])))
        elif m := _NUMBER.match(line) if c.isalnum() and (c.isdigit() or len(s) > 2 and s[1] == ")") else None:
            out.append((i, i, "number", 0, line[m.end() :].strip(), inlines(line[m.end() :])))
        elif (m := _WIKI_ITEM.match(line) if c == "*" else None) and "*" not in line[m.end() :]:
            out.append((i, i, "star", len(m.group(1)), line[m.end() :].strip(), inlines(line[m.end() :])))
        elif i + 1 < n and _UNDERLINE.match(lines[i + 1]):
            end = i + 1
            out.append((i, end, "underlined", 1 if lines[i + 1].strip()[0] == "=" else 2, s, []))
        else:
            out.append((i, i, "text", 0, s, inlines(s)))
        i = end + 1
    return out


# --- wrapper inference ---------------------------------------------------------------------------
# A wrapper is a list of nodes [symbol, slot], all optional, inside one repeated group; symbol ends
# with "+" where the token repeats; slot has the inline tokens of its text, all optional, inside a
# repeated group of their own, as a count by token. Beside them it counts "turns", the times the node
# was met, and the lines of each "level N" of "#".


def segments(tokens: list[tuple]) -> list[list[tuple[str, list[tuple]]]]:
    """Fold neighbouring equal tokens and cut the stream behind its text slots."""
    segs: list[list[tuple[str, list[tuple]]]] = [[]]
    i = 0
    while i < len(tokens):
        j = i + 1
        while j < len(tokens) and tokens[j][2] == tokens[i][2] and (tokens[i][2] != "hash" or tokens[j][0] == tokens[j - 1][1] + 1):
            j += 1
        deep = tokens[i][2] == "hash" and any(t[3] > 1 for t in tokens[i:j])
        segs[-1].append((tokens[i][2] + (("_deep+" if deep else "+") if j - i > 1 else ""), tokens[i:j]))
        if tokens[i][2] == "text":
            segs.append([])
        i = j
    return [s for s in segs if s]


def _align(known: list, new: list, key) -> list[tuple[int, int]]:
    """Longest common subsequence of two short lists, as index pairs."""
    n, m = len(known), len(new)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if key(known[i]) == key(new[j]) else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < n and j < m:
        if key(known[i]) == key(new[j]):
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def _merged(known: list, new: list, key, join) -> list:
    """Alignment of ``new`` into ``known``: matches joined, the rest of both sides optional."""
    out, i, j = [], 0, 0
    for a, b in [*_align(known, new, key), (len(known), len(new))]:
        out += known[i:a]
        out += new[j:b]
        if a < len(known):
            out.append(join(known[a], new[b]))
        i, j = a + 1, b + 1
    return out


def _slot(a: dict[str, int], b: dict[str, int]) -> dict[str, int]:
    """Inline tokens and evidence of both; each token is optional in a repeated group, so their order is free."""
    return a | {x: a.get(x, 0) + n for x, n in b.items()}


def align(wrapper: list, seq: list) -> list:
    """The least generalisation of the group that also reads ``seq``, with the evidence of both."""
    slots: dict[str, dict[str, int]] = {}
    for sym, slot in seq:
        slots[sym] = _slot(slots.get(sym, {}), slot)
    if not slots.keys() - {sym for sym, _ in wrapper}:  # a change of order is read by another turn of the group
        return [[sym, _slot(slot, slots[sym]) if sym in slots else slot] for sym, slot in wrapper]
    known = _merged(wrapper, seq, lambda x: x[0], lambda x, y: [x[0], _slot(x[1], y[1])])
    out, seen = [], {}
    for sym, slot in known:  # a node twice in the group is one node and another turn
        if sym in seen:
            seen[sym][1] = _slot(seen[sym][1], slot)
        else:
            seen[sym] = [sym, dict(slot)]
            out.append(seen[sym])
    return out


def _nodes(seg: list[tuple[str, list[tuple]]]) -> list:
    levels = lambda sym, toks: [f"level {t[3]}" for t in toks] if sym.startswith("hash") else []
    return [[sym, dict(Counter([x for t in toks for x in t[5]] + levels(sym, toks))) | {"turns": 1}] for sym, toks in seg]


def infer(wrapper: list, data: str) -> list:
    for seg in segments(lex(data)):
        wrapper = align(wrapper, _nodes(seg))
    return wrapper


_HEADING = {"equals", "h_tag", "sectioning", "underlined"}
_ITEM = {"dash", "star", "plus", "dot", "hashes", "number", "item", "li"}
_CODE = {"fence", "code_tag", "code_env"}
_FORMULA = {"math_env", "math_dollars", "math_bracket", "math_block"}


#: So many times as often must a host use ``#`` in the other way before it changes what the form says.
MUCH = 4


def role(symbol: str) -> str:
    """What a node means by its form alone."""
    base = _base(symbol)
    if base == "hash":
        return "list_item" if symbol.endswith("+") else "heading"
    return "heading" if base in _HEADING else "list_item" if base in _ITEM else "code_block" if base in _CODE else "formula" if base in _FORMULA else "text"


def meanings(wrapper: list) -> dict[str, str]:
    """What each node means in the host that the wrapper was made from.

    Lone ``#`` lines are list items where none is deeper than level 1, runs of such lines are much
    more frequent and headings have another form. Runs of level 1 are headings where lone lines are
    much more frequent, some deeper, and no heading has another form. Runs with deeper lines, ``#``
    above ``##``, are headings where lone deeper lines outnumber the runs of level 1.
    """
    by = dict(wrapper)
    means = {sym: role(sym) for sym in by}
    lines, runs = (by.get(sym, {}).get("turns", 0) for sym in ("hash", "hash+"))
    deep = lines - by.get("hash", {}).get("level 1", 0)
    others = any(sym.rstrip("+") in _HEADING for sym in by)
    if lines and not deep and others and runs >= MUCH * lines:
        means["hash"] = "list_item"
    if runs and deep and not others and lines >= MUCH * runs:
        means["hash+"] = "heading"
    if "hash_deep+" in by and deep > runs:
        means["hash_deep+"] = "heading"
    return means


def _base(symbol: str) -> str:
    return symbol.rstrip("+").removesuffix("_deep")


def read(wrapper: list, data: str) -> Iterator[tuple[tuple, str, list[str]]]:
    """Match a body with its wrapper: (token, role of its node, inline tokens of the slot).

    A token is read by its node; one that repeats, or doesn't, where the wrapper knows it only the
    other way, by that node, as its repetition is no new form. Slots of nodes with one meaning hold
    the same kind of text, so what one of them may have, all may. Everything else is running text.
    """
    means = meanings(wrapper)
    bases = {_base(sym) for sym in means}
    slots: dict[str, set[str]] = {}
    for sym, slot in wrapper:
        slots.setdefault(means[sym], set()).update(slot)
    for seg in segments(lex(data)):
        for sym, items in seg:
            mean = means.get(sym) or (role(sym) if _base(sym) in bases else "text")
            slot = slots.get(mean, ())
            for t in items:
                yield t, mean, [x for x in t[5] if x in slot]


def _reads(wrapper: list, seq: list) -> bool:
    by = {sym: slot for sym, slot in wrapper}
    return all(sym in by and all(x in by[sym] for x in slot) for sym, slot in seq)


def cases(wrapper: list, data: str) -> Iterator[tuple[int, str]]:
    """(line_no, kind) of every piece of markup."""
    for t, r, slot in read(wrapper, data):
        if r != "text":
            yield t[0], r
        if r in ("text", "list_item"):
            math = [x for x in slot if x.startswith("math_")]
            if math:
                yield t[0], "formula"
            if len(math) < len(slot):
                yield t[0], "inline"


# --- clean text ----------------------------------------------------------------------------------


def clean_inline(text: str) -> str:
    """Running text without its markup; formulas become ``$...$``."""
    kept: list[str] = []

    def keep(m: re.Match) -> str:
        f = re.sub(r"^<math\b[^>]*>|</math>$", "", m.group(), flags=re.I)
        f = f.removeprefix("\\(").removesuffix("\\)").strip("$").strip()
        kept.append(f"${f}$")
        return f"\x00{len(kept) - 1}\x00"

    for _, rx in _MATH:
        text = rx.sub(keep, text)
    rules = dict(_INLINE)
    text = rules["comment"].sub("", text)
    text = rules["ref"].sub("", text)
    text = rules["template"].sub("", text)
    text = rules["image"].sub(lambda m: m.group()[2:].split("]")[0], text)
    text = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", text)
    text = re.sub(r"\[\^[^\]\s]+\]:?", "", text)
    text = re.sub(r"\[([^\[\]]*)\]\([^()\s]*(?:\([^()\s]*\)[^()\s]*)*(?:\s+\"[^\"]*\")?\)", r"\1", text)
    text = re.sub(r"\[([^\[\]]+)\]\[[^\[\]]*\]", r"\1", text)
    text = re.sub(r"\[(?:https?:)?//[^\s\]]+(?:\s([^\]]*))?\]", r"\1", text)
    text = rules["code"].sub(lambda m: m.group().strip("`"), text)
    text = re.sub(r"'{2,5}(.+?)'{2,5}", r"\1", text)
    text = rules["strong"].sub(lambda m: m.group()[2:-2], text)
    text = rules["strike"].sub(lambda m: m.group()[2:-2], text)
    text = rules["emphasis"].sub(lambda m: m.group()[1:-1], text)
    text = re.sub(r"~?\\(?:cite[a-z]*|footnote|label|ref|index)\*?(?:\[[^\]]*\])*\{(?:[^{}]|\{[^{}]*\})*\}", "", text)
    for _ in range(3):
        text = re.sub(r"\\(?:href|textcolor)\{[^{}]*\}\{([^{}]*)\}|\\[a-zA-Z]+\*?(?:\[[^\]]*\])*\{([^{}]*)\}", lambda m: m.group(1) or m.group(2) or "", text)
    text = re.sub(r"<sup\b[^>]*>\s*\[?\d+\]?\s*</sup>", "", text, flags=re.I)
    text = _BLOCK_TAG.sub("", text)
    text = rules["tag"].sub("", text)
    text = html.unescape(text).replace("\xa0", " ")
    text = re.sub(r"[ \t]{2,}", " ", text).strip()
    return re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m.group(1))], text)


def clean(wrapper: list, data: str) -> str:
    """Clean text: ``#`` headings, ``-`` items, fenced code, ``$$`` formulas, plain running text."""
    out: list[str] = []
    last = ""
    for t, r, _ in read(wrapper, data):
        body = t[4]
        if r == "heading":
            new = "#" * max(1, t[3]) + " " + clean_inline(body)
        elif r == "list_item":
            new = "- " + clean_inline(body)
        elif r == "code_block":
            new = f"```\n{body}\n```"
        elif r == "formula":
            new = f"$$\n{body}\n$$"
        else:
            new = clean_inline(body)
        if not new:
            continue
        if out:
            out.append("\n" if r == last == "list_item" else "\n\n")
        out.append(new)
        last = r
    return "".join(out)


# --- distributed operator ------------------------------------------------------------------------


def _infer_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial wrapper per host and partition."""
    by: dict[str, list] = {}
    for b in batches:
        for host, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            by[host] = infer(by.get(host, []), data)
    yield pa.RecordBatch.from_arrays([pa.array(list(by), pa.string()), pa.array([json.dumps(w) for w in by.values()], pa.string())], names=["host", "wrapper"])


def _merge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        merged = []
        for parts in b.column(1).to_pylist():
            w: list = []
            for p in sorted(parts):
                w = align(w, json.loads(p))
            merged.append(json.dumps(w))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(merged, pa.string())], names=["host", "wrapper"])


def wrappers(rows: DataFrame) -> DataFrame:
    """(host, wrapper as JSON) from (host, data) rows: partial inference, then two rounds of merging.

    Partial wrappers are as small as the alphabet of tokens, one per partition and host. Equal ones
    are all kept, as each brings evidence of its own.
    """
    parts = rows.select("host", "data").mapInArrow(_infer_parts, "host string, wrapper string")
    salted = parts.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(32)).alias("salt")).agg(F.collect_list("wrapper").alias("parts"))
    once = salted.select("host", "parts").mapInArrow(_merge_parts, "host string, wrapper string")
    return once.groupBy("host").agg(F.collect_list("wrapper").alias("parts")).mapInArrow(_merge_parts, "host string, wrapper string")


def _reader(make, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list] = {}
        for b in batches:
            rows: list[tuple] = []
            for pos, data, w in zip(*(b.column(i).to_pylist() for i in range(3))):
                w = w or "[]"
                if w not in cache:
                    if len(cache) > 5000:
                        cache.clear()
                    cache[w] = json.loads(w)
                rows += make(pos, cache[w], data)
            cols = list(zip(*rows)) or [()] * len(names)
            kinds = {"pos": pa.int64(), "line_no": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, cols)], names=names)

    return run


def _with_wrapper(df: DataFrame, pos: Column, host: Column, data: Column) -> DataFrame:
    rows = df.select(pos.cast("long").alias("pos"), F.coalesce(host, F.lit("")).alias("host"), data.alias("data")).where(data.rlike(r"\S"))
    w = wrappers(rows)
    return rows.join(w, "host", "left").select("pos", "data", "wrapper")


def markup_cases(df: DataFrame, pos: Column, host: Column, data: Column) -> DataFrame:
    """(pos, line_no, kind) of all markup in ``data``. Null, empty and blank bodies have none; a null
    host is a host of its own; repeated rows are read one by one."""
    make = lambda pos, w, data: [(pos, n, k) for n, k in dict.fromkeys(cases(w, data))]
    return _with_wrapper(df, pos, host, data).mapInArrow(_reader(make, ["pos", "line_no", "kind"]), "pos long, line_no long, kind string")


def clean_text(df: DataFrame, pos: Column, host: Column, data: Column) -> DataFrame:
    """(pos, text): clean text of every body that says something."""
    make = lambda pos, w, data: [(pos, clean(w, data))]
    return _with_wrapper(df, pos, host, data).mapInArrow(_reader(make, ["pos", "text"]), "pos long, text string")
