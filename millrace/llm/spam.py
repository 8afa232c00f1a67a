"""Keyword-stuffed pages, link lists and tag lists, told from prose by robust outlier detection.

Every document becomes a short vector of density, entropy, repetition and function-word features,
each an estimate from the words of the text, with the variance that an estimate from so many words
has. Per language, a robust centre and covariance are taken over all documents: medians and median
absolute deviations first, then reweighted by concentration steps that keep the documents near the
centre (the distances of the last step decide who counts). By the law of total variance the
covariance is that of the estimates among the kept documents plus the mean variance of an estimate,
so a feature that nearly all prose has at zero, such as links, is judged by what texts of this
length can tell about it. No width is set by hand. Spam is a minority in no direction the covariance
is drawn to. A document is spam if its Mahalanobis distance is beyond the cut-off and it lies in a
spam-directed direction: more links, repetition or tags, less entropy, fewer function words or
sentences than prose, in the metric of the covariance.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words per language.
FUNCTION_WORDS = {
    "en": "the of and to in a is that it was for on as with by at from be this which or an are not but have had were has its their his her they when who will would there been one all into more than no some what so up out if about can only other could then them these may do any my now such like our over me after also most where before between those he she you i we while during",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei ihr ihre seine unter diese dieser wenn kann gegen vom wir ich was da etwa zwischen zwei dabei",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está mi porque qué sólo han yo hay vez puede todos así nos ni parte tiene él uno donde bien tiempo mismo ese ahora cada e vida otro después te otros aunque esa eso hace otra gobierno tan durante unos según antes solo",
    "ru": "и в не на что с как по это к но из у за от о так же для бы то мы ты вы он она они его её их был была было были есть или до при если где когда уже только ещё чтобы под над после через во со об ли ни быть который которая которые этот эта эти тот там тем чем один два сейчас здесь каждое прежде около между",
}
HAN_FUNCTION = "的了在是和有与其这那为以及不也就都而被从到由于并或之所把对能会可上中下后前又很将各每该当曾已此因但"
_WORDS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_HAN_FUNCTION = frozenset(HAN_FUNCTION)
LANGUAGES = ("en", "de", "es", "ru", "zh")

_FRONT = re.compile(r"\A\s*---\n.*?\n---[ \t]*(?:\n|\Z)", re.S)
_IMAGE = re.compile(r"!\[[^\]]*\]\([^)]*\)")
_LINK = re.compile(r"\[([^\[\]]*)\]\([^()\s]*\)|<a\b[^>]*>(.*?)</a>", re.I | re.S)
_URL = re.compile(r"(?:https?://|www\.)[^\s)\]>]+", re.I)
_TAG = re.compile(r"(?<![\w&/])#\w[\w-]*")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_HAN = re.compile(r"[㐀-鿿]")
_SENTENCE_END = re.compile(r"[.!?…。！？](?=[\s\"”’)\]]|$)|[。！？]")
#: Words of a block.
BLOCK = 120
#: Words at which a text's own entropy and repetition have half of the say, and the entropy level of prose.
FEW, LEVEL = 25, 1.5
#: Words that make one trial for being linked, repeated, dominated by a word, or ending a sentence; Han signs of a word.
TRIAL, HAN_WORD = 12, 1.6
#: Variance of a word's log frequency in prose.
SURPRISE = 0.5
NAMES = ("links", "functions", "entropy", "repetition", "top", "sentences")
#: Direction of spam in each feature.
SPAM_SIGN = np.array([1.0, -1.0, -1.0, 1.0, 1.0, -1.0])


def language(words: list[str], n_han: int, n_cyrillic: int, said: str | None) -> str:
    """Language from script and function words; what the row says only where the text doesn't tell."""
    if n_han > max(4, len(words) // 4):
        return "zh"
    if n_cyrillic * 2 > len(words):
        return "ru"
    hits = {k: sum(w in _WORDS[k] for w in words) for k in ("en", "de", "es")}
    best = max(hits, key=hits.get)
    if hits[best] >= 3 and hits[best] > 0.06 * len(words):
        return best
    code = (said or "").strip().lower()[:2]
    return code if code in ("en", "de", "es") else best if hits[best] else "en"


def estimate(share: float, n: float) -> tuple[float, float]:
    """Mean and variance of a share seen in ``n`` trials (Jeffreys prior)."""
    mean = (min(max(share, 0.0), 1.0) * n + 0.5) / (n + 1)
    return mean, mean * (1 - mean) / (n + 2)


def features(text: str, said: str | None) -> tuple[str, list[float], list[float]] | None:
    """(language, feature vector, variances of its members) of a text; None where it shows no word."""
    body = _FRONT.sub("", text)
    body = _IMAGE.sub(" ", body)
    lines = [x.strip() for x in body.split("\n")]
    prose = [x for x in lines if x and not x.startswith("#") or _TAG.match(x)]  # headings are no prose
    body = "\n".join(prose)
    linked = 0
    shown = body
    if "](" in body or "<a" in body:
        anchors = [a or b for a, b in _LINK.findall(body)]
        linked = sum(len(a) for a in anchors if not _SENTENCE_END.search(a if len(a) > 11 else a[:-1]))  # a linked passage is prose
        shown = _LINK.sub(lambda m: m.group(1) or m.group(2) or " ", body)
    urls = _URL.findall(shown)
    shown = _URL.sub(" ", shown)
    tags = _TAG.findall(shown)
    chars = len(re.sub(r"\s+", "", shown)) + 12 * len(urls)
    if not chars:
        return None
    low = shown.lower()
    words = _WORD.findall(low)
    han = _HAN.findall(low)
    cyr = sum("Ѐ" <= w[0] <= "ӿ" for w in words)
    lang = language(words, len(han), cyr, said)
    units = han if lang == "zh" else words
    n = len(units)
    if not n and not urls:
        return None
    links = (linked + 12 * len(urls) + sum(map(len, tags))) / chars
    fw = _HAN_FUNCTION if lang == "zh" else _WORDS[lang]
    functions = sum(w in fw for w in units) / max(n, 1)
    # entropy and repetition by blocks that cover the text, so that they don't depend on its length
    blocks = max(1, round(n / BLOCK))
    size = -(-n // blocks) if n else 1
    entropy = repetition = top = 0.0
    for at in range(0, n, size):
        part = units[at : at + size]
        k = len(part)
        pairs = Counter(zip(part, part[1:]))
        count = Counter(part)
        h = -sum(v / k * math.log(v / k) for v in count.values())
        entropy += (h - 0.55 * math.log(k)) * k / n
        repetition += sum(v - 1 for v in pairs.values()) / max(k - 1, 1) * k / n
        content = pairs if lang == "zh" else {w: v for w, v in count.items() if w not in fw}
        total = sum(content.values())
        top += max(content.values(), default=0) / max(total, 1) * min(1.0, total / 12) * k / n
    # few words say little about both: a text of two sentences may well repeat itself
    entropy = (n * entropy + FEW * LEVEL) / (n + FEW)
    repetition = n * repetition / (n + FEW)
    ends = len(_SENTENCE_END.findall(shown))
    sentences = min(1.0, TRIAL * ends / max(n if lang != "zh" else n / HAN_WORD, 1))
    words_shown = max(n if lang != "zh" else n / HAN_WORD, 1.0)
    trials = words_shown / TRIAL
    got = [
        estimate(links, trials), estimate(functions, words_shown), (entropy, SURPRISE / (max(n, 1) + FEW)),
        estimate(repetition, trials), estimate(top, trials), estimate(sentences, trials),
    ]
    return lang, [m for m, _ in got], [v for _, v in got]


#: Squared distances: 95 % quantile (core of the reweighting) and 99.95 % quantile (cut-off) of chi-square with 6 degrees.
CORE, CUT = 12.59, 24.1
#: What trimming at the core takes from a covariance.
TRIMMED = 1.15
STEPS = 3
D = len(NAMES)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, langs, rows = [], [], []
        for i, said, text in zip(*(b.column(k).to_pylist() for k in range(3))):
            f = features(text, said)
            if f is not None:
                ids.append(i)
                langs.append(f[0])
                rows.append(f[1] + f[2])
        x = np.array(rows, dtype=np.float64).reshape(-1, 2 * D)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), *(pa.array(x[:, k]) for k in range(2 * D))], names=["doc_id", "lang", *_COLUMNS])


_COLUMNS = [f"x{k}" for k in range(D)] + [f"v{k}" for k in range(D)]


def vectors(df: DataFrame, doc_id: Column, said: Column, text: Column) -> DataFrame:
    """(doc_id, lang, x0..x5, v0..v5): the features of every document that shows a word, and their variances.

    Null, empty and blank texts, and texts of nothing but titles and front matter, have none and are
    never spam. A null or odd language is worked out from the text. Repeated rows have equal vectors.
    """
    rows = df.select(doc_id.cast("long").alias("doc_id"), said.alias("said"), text.alias("text")).where(F.col("text").rlike(r"\S"))
    return rows.mapInArrow(_vectors, "doc_id long, lang string, " + ", ".join(f"{c} double" for c in _COLUMNS))


def _distances(v: DataFrame, model: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``v`` with d2, the squared distance, and s2, the squared length of its spam-directed part."""
    spark = v.sparkSession
    rows = [(lang, *map(float, mu), *(float(p[i, j]) for i in range(D) for j in range(i, D))) for lang, (mu, p) in model.items()]
    names = [f"m{k} double" for k in range(D)] + [f"p{i}{j} double" for i in range(D) for j in range(i, D)]
    small = spark.createDataFrame(rows, "lang string, " + ", ".join(names))  # a row per language
    y = [F.col(f"x{k}") - F.col(f"m{k}") for k in range(D)]
    t = [F.greatest(y[k] * float(SPAM_SIGN[k]), F.lit(0.0)) * float(SPAM_SIGN[k]) for k in range(D)]
    form = lambda z: sum((z[i] * z[j] * F.col(f"p{i}{j}") * (1.0 if i == j else 2.0) for i in range(D) for j in range(i, D)), F.lit(0.0))
    return v.join(small, "lang").withColumn("d2", form(y)).withColumn("s2", form(t))


def robust_model(v: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per language: robust centre and inverse covariance, from aggregates over all vectors.

    What reaches the driver is a few numbers per language, whatever the size of the table.
    """
    xs, vs = _COLUMNS[:D], _COLUMNS[D:]
    first = v.groupBy("lang").agg(*[F.percentile_approx(x, 0.5, 10000).alias(x) for x in xs], *[F.avg(x).alias(x) for x in vs]).collect()
    if not first:
        return {}
    med = {r["lang"]: np.array([r[x] for x in xs]) for r in first}
    own = {r["lang"]: np.array([r[x] for x in vs]) for r in first}  # mean variance of an estimate
    flat = {lang: (m, np.eye(D)) for lang, m in med.items()}
    dev = _distances(v, flat).groupBy("lang").agg(*[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{k}")), 0.5, 10000).alias(x) for k, x in enumerate(xs)]).collect()
    model = {r["lang"]: (med[r["lang"]], np.diag(1 / ((1.4826 * np.array([r[x] for x in xs])) ** 2 + own[r["lang"]]))) for r in dev}
    for _ in range(STEPS):
        core = _distances(v, model).where(F.col("d2") <= CORE)
        sums = [F.sum(x).alias(x) for x in xs] + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"c{i}{j}") for i in range(D) for j in range(i, D)]
        for r in core.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
            n = r["n"]
            mu = np.array([r[x] for x in xs]) / n
            second = np.array([[r[f"c{min(i, j)}{max(i, j)}"] for j in range(D)] for i in range(D)]) / n
            model[r["lang"]] = (mu, np.linalg.inv(TRIMMED * (second - np.outer(mu, mu)) + np.diag(own[r["lang"]])))
    return model


def spam_scores(v: DataFrame) -> DataFrame:
    """(doc_id, lang, d2, s2, spam) of every vector. Works on any size; an empty table gives none."""
    model = robust_model(v)
    if not model:
        return v.select("doc_id", "lang", F.lit(0.0).alias("d2"), F.lit(0.0).alias("s2"), F.lit(False).alias("spam"))
    return _distances(v, model).select("doc_id", "lang", "d2", "s2", ((F.col("d2") > CUT) & (F.col("s2") > CUT)).alias("spam"))
