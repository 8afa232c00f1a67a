"""One consistent form for texts that look the same but differ in their characters.

A text is read in two steps, and two texts look the same exactly if their readings are equal:

1. compatibility normalization of what only changes width or joins letters (full-width, half-width,
   ligatures, radicals, spaces of any width, hyphens), decomposition, and deletion of ignorable
   characters (zero-width, bidirectional marks, soft hyphens, variation selectors). Raised, lowered,
   circled and styled characters are kept: they look different;
2. each token spans a lattice: every letter may stand for any letter it looks like, of any script the
   text has. Viterbi picks the reading with the best character n-gram score, where a change of script
   inside a token costs more than any n-gram can win. Accents and all other characters are as they are.

Most letters look like one Latin letter; some look like several (a palochka is read as ``I`` or as
``l``), and for these the neighbours decide what the token says. The search is exact but mostly
needless: a script without a letter of its own (outside every look) anywhere in the text is no
option, so the letters of a text with Latin letters only have one reading, unless an ambiguous one
stands among them.

The n-gram counts come from all texts of the table (a first pass); they are bounded by the
alphabets, not by the data.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts that look like a Latin letter in common typefaces.
CYRILLIC = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ѕ": "S", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V",
}
GREEK = {
    "ο": "o", "ν": "v", "ρ": "p", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
}
ARMENIAN = {
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "Օ": "O", "Տ": "S", "Ս": "U", "Լ": "L",
}
CHEROKEE = {
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮢ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
}
#: Latin letters drawn like another one.
LATIN = {"ɑ": "a", "ɡ": "g", "ᴏ": "o", "ᴄ": "c", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s"}
#: Letters that look like several Latin letters; what stands around them decides.
AMBIGUOUS = {"Ӏ": "Il", "ӏ": "lI", "ǀ": "lI", "Ɩ": "lI"}
_SCRIPTS = {"c": CYRILLIC, "g": GREEK, "a": ARMENIAN, "k": CHEROKEE}
_CLASS = {ord(k): v for t in (*_SCRIPTS.values(), LATIN) for k, v in t.items()} | {ord(k): v[0] for k, v in AMBIGUOUS.items()}
_FOLDED = ("<wide>", "<narrow>", "<noBreak>", "<compat>")
_RANGES = {"c": ((0x400, 0x530),), "g": ((0x370, 0x400),), "a": ((0x531, 0x588),), "k": ((0x13A0, 0x13FE), (0xAB70, 0xABC0))}
_TOKEN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ʯ̀-ͯͰ-ϿЀ-ԯԱ-ևᎠ-ᏽᴀ-ᴢꜰꜱꭰ-ꮿ]+")
_BASE = frozenset(map(chr, _CLASS))
#: Letters that only their script has: they tell that a text has it.
_ANCHOR = {
    s: re.compile(f"[{''.join(chr(c) for a, b in r for c in range(a, b) if chr(c) not in _BASE and unicodedata.category(chr(c))[0] == 'L' and unicodedata.normalize('NFD', chr(c)) == chr(c))}]")
    for s, r in _RANGES.items()
}
_ANY_ANCHOR = re.compile("|".join(r.pattern for r in _ANCHOR.values()))
_AMBIGUOUS = re.compile(f"[{''.join(AMBIGUOUS)}]")
#: Log cost of changing the script inside a token.
SWITCH = 1000.0


def _shown(ch: str) -> str:
    """What a character shows: nothing, a space, a plainer spelling, or itself."""
    cat = unicodedata.category(ch)
    cp = ord(ch)
    if cat == "Cf" or cp in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0x180B <= cp <= 0x180F or 0xFE00 <= cp <= 0xFE0F or 0xE0000 <= cp <= 0xE0FFF:
        return ""
    if cat == "Cc":
        return ch if ch == "\n" else " " if ch == "\t" else "" if cp < 32 or 127 <= cp < 160 else ch
    if cat == "Zs":
        return " "
    if ch in "‐‑":
        return "-"
    if cp in _CLASS:
        return ch
    d = unicodedata.decomposition(ch)
    if d.startswith(_FOLDED):
        parts = [chr(int(x, 16)) for x in d.split()[1:]]
        if unicodedata.combining(parts[-1]) and parts[0] == " ":
            return ch  # spacing accents
        return "".join(_shown(p) for p in parts)
    return ch


class _Lazy(dict):
    """Translation table that works out a character when it is first met."""

    def __init__(self, rule):
        super().__init__()
        self._rule = rule

    def __missing__(self, cp: int) -> str:
        self[cp] = r = self._rule(chr(cp))
        return r


_SHOW = _Lazy(_shown)
_CLASSES = _Lazy(lambda ch: _CLASS.get(ord(ch), ch))


def decomposed(text: str) -> str:
    """Step 1: what a text shows, with accents behind their letters."""
    return unicodedata.normalize("NFD", text.translate(_SHOW))


def _classes(text: str) -> str:
    return unicodedata.normalize("NFC", decomposed(text).translate(_CLASSES))


#: Texts made of characters alone that have one reading, themselves, need no look at each.
_PLAIN = re.compile(f"[^\\n{re.escape(''.join(c for c in map(chr, [*range(32, 127), *range(0xA1, 0x180), *range(0x2013, 0x2023)]) if _classes(c) == c))}\u4e00-\u9fff]")


def classes(text: str) -> str:
    """The text with every letter replaced by the Latin one it looks like first: a form for loose comparisons."""
    return _classes(text) if _PLAIN.search(text) else text


def script(ch: str) -> str:
    """One letter per script: l, c, g, a, k, and - for what has none, such as accents."""
    cp = ord(ch)
    if cp < 0x2B0 or 0x1D00 <= cp < 0x1D80 or 0xA720 <= cp < 0xA800:
        return "l" if ch.isalpha() else "-"
    return next((s for s, r in _RANGES.items() if any(a <= cp < b for a, b in r)), "-")


#: Latin letter -> all letters that look like it, by script, itself first.
_LOOKS: dict[str, list[tuple[str, str]]] = {}
for _s, _t in _SCRIPTS.items():
    for _k, _v in _t.items():
        _LOOKS.setdefault(_v, [("l", _v)]).append((_s, _k))
_OPTIONS: dict[str, list[tuple[str, str]]] = {}


def _options(ch: str) -> list[tuple[str, str]]:
    """Letters a letter can be read as, with their scripts."""
    got = _OPTIONS.get(ch)
    if got is None:
        looks = AMBIGUOUS.get(ch) or _CLASS.get(ord(ch), ch)
        got = _OPTIONS[ch] = [o for v in looks for o in _LOOKS.get(v, [(script(v), v)])]
    return got


class Reader:
    """Step 3 with given n-gram counts; ``counts`` maps two-letter strings (" " is an edge) to counts."""

    def __init__(self, counts: dict[str, int]):
        self.pair = counts
        self.left: Counter = Counter()
        for k, n in counts.items():
            self.left[k[0]] += n
        self.memo: dict[tuple[str, str], str] = {}

    def score(self, a: str, b: str) -> float:
        return math.log((self.pair.get(a + b, 0) + 0.1) / (self.left.get(a, 0) + 30.0))

    def token(self, letters: str, scripts: str) -> str:
        """The best reading of a decomposed token in the scripts that the text has."""
        got = self.memo.get((letters, scripts))
        if got is not None:
            return got
        # per letter: (value, script so far, letter, place of the best state before)
        steps: list[list[tuple[float, str, str, int]]] = [[(0.0, "", " ", -1)]]
        for ch in letters:
            now = []
            for s, c in [o for o in _options(ch) if o[0] in scripts or o[0] == "-"] or _options(ch):
                top = (-math.inf, 0)
                for i, (v, ps, pc, _) in enumerate(steps[-1]):
                    x = v + self.score(pc, c) - (SWITCH if ps and s != "-" and s != ps else 0.0)
                    if x > top[0]:
                        top = (x, i)
                now.append((top[0], steps[-1][top[1]][1] if s == "-" else s, c, top[1]))
            steps.append(now)
        at = max(range(len(steps[-1])), key=lambda i: (steps[-1][i][0] + self.score(steps[-1][i][2], " "), steps[-1][i][2]))
        read = []
        for step in reversed(steps[1:]):
            read.append(step[at][2])
            at = step[at][3]
        end = "".join(reversed(read))
        if len(self.memo) > 300_000:
            self.memo.clear()
        self.memo[(letters, scripts)] = end
        return end

    def form(self, text: str) -> str:
        """The consistent form of a text: the readings of its tokens, composed again."""
        if not _PLAIN.search(text):
            return text
        seq = decomposed(text)
        scripts = "l" + "".join(s for s, r in _ANCHOR.items() if r.search(seq)) if _ANY_ANCHOR.search(seq) else "l"
        if scripts == "l" and not _AMBIGUOUS.search(seq):
            return unicodedata.normalize("NFC", seq.translate(_CLASSES))  # every letter has one option
        return unicodedata.normalize("NFC", _TOKEN.sub(lambda m: self.token(m.group(), scripts), seq))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letter pairs of the single-script tokens of a partition, decomposed."""
    words: Counter = Counter()
    pairs: Counter = Counter()

    def fold() -> None:
        for w, n in words.items():
            w = unicodedata.normalize("NFD", w)
            if len({script(c) for c in w} - {"-"}) == 1:
                w = f" {w} "
                for i in range(len(w) - 1):
                    pairs[w[i : i + 2]] += n
        words.clear()

    for b in batches:
        for t in b.column(0).to_pylist():
            if t:
                words.update(_TOKEN.findall(t))
        if len(words) > 500_000:
            fold()
    fold()
    yield pa.RecordBatch.from_arrays([pa.array(list(pairs.keys()), pa.string()), pa.array(list(pairs.values()), pa.int64())], names=["pair", "n"])


def pair_counts(df: DataFrame, text: str) -> dict[str, int]:
    """Letter pair counts over all texts. The result is bounded by the squared alphabets (under 10^6 pairs)."""
    got = df.select(text).mapInArrow(_count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return {r["pair"]: r["n"] for r in got}


def shows_text(form: str) -> bool:
    return not (not form or form.isspace())


def _forms(counts: dict[str, int], keys_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(counts)
        for b in batches:
            keep, form, raw = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                f = reader.form(t) if t is not None else None
                if keys_only:
                    if f is not None and shows_text(f):
                        keep.append(i)
                        form.append(hashlib.sha256(f.encode("utf-8", "surrogatepass")).digest())
                        raw.append(hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest())
                else:
                    keep.append(i)
                    form.append(f)
            pos = b.column(0).take(pa.array(keep, pa.int64()))
            if keys_only:
                yield pa.RecordBatch.from_arrays([pos, pa.array(form, pa.binary()), pa.array(raw, pa.binary())], names=["pos", "look", "raw"])
            else:
                yield pa.RecordBatch.from_arrays([pos, pa.array(form, pa.string())], names=["pos", "form"])

    return run


def consistent_form(df: DataFrame, pos: str, text: str) -> DataFrame:
    """(pos, form) of every row; a null text has a null form, an empty or blank one its spaces."""
    counts = pair_counts(df, text)
    return df.select(F.col(pos).cast("long").alias("pos"), F.col(text).alias("t")).mapInArrow(_forms(counts, False), "pos long, form string")


def looks(df: DataFrame, pos: str, text: str) -> DataFrame:
    """(pos, look, raw): SHA-256 of the consistent form and of the text; only rows that show text."""
    counts = pair_counts(df, text)
    return df.select(F.col(pos).cast("long").alias("pos"), F.col(text).alias("t")).mapInArrow(_forms(counts, True), "pos long, look binary, raw binary")


def same_look_pairs(keys: DataFrame) -> DataFrame:
    """(pos_a, pos_b), a < b: rows of equal look whose texts differ.

    Pairs are formed between the distinct texts of a look and only then spread to the rows that
    hold them: a text repeated in a third of all rows never meets its own copies.
    """
    texts = keys.select("look", "raw").distinct()
    many = texts.groupBy("look").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("look")
    some = texts.join(many, "look", "left_semi")
    a, b = some.alias("a"), some.alias("b")
    links = a.join(b, (F.col("a.look") == F.col("b.look")) & (F.col("a.raw") < F.col("b.raw"))).select(F.col("a.look").alias("look"), F.col("a.raw").alias("raw_a"), F.col("b.raw").alias("raw_b"))
    left = keys.select("look", F.col("raw").alias("raw_a"), F.col("pos").alias("p"))
    right = keys.select("look", F.col("raw").alias("raw_b"), F.col("pos").alias("q"))
    spread = links.join(left, ["look", "raw_a"]).join(right, ["look", "raw_b"])
    return spread.select(F.least("p", "q").alias("pos_a"), F.greatest("p", "q").alias("pos_b")).where("pos_a <> pos_b")


def look_classes(keys: DataFrame) -> DataFrame:
    """(pos, class_pos, n_rows, n_links) of every row that shows text: the smallest position of the rows
    that look like it, how many these are (itself included), and to how many of them it is linked,
    which are those whose text differs.

    Counts are per distinct text first, so a text on a third of all rows is one row in them; it meets
    its counts as the split side of an adaptive skew join.
    """
    texts = keys.groupBy("look", "raw").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    whole = texts.groupBy("look").agg(F.sum("n").alias("n_rows"), F.min("first").alias("class_pos"))
    per = texts.join(whole, "look").select("look", "raw", "class_pos", "n_rows", (F.col("n_rows") - F.col("n")).alias("n_links"))
    return keys.join(per, ["look", "raw"]).select("pos", "class_pos", "n_rows", "n_links")
