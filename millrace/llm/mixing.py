"""Mixing sources so that each makes up its target share of the tokens.

The total is the largest that every source can serve with its documents used at most ``max_repeats``
times, unless one is given. A source whose budget exceeds its tokens is used whole as often as it
fits; what is left of its budget is met by a choice of documents, found on the *counts per exact
length*, never on the documents themselves:

1. the same part of every length is taken, rounded down, which keeps the make-up of the source;
2. single documents of the lengths that lost most by rounding are added while the rest of the budget
   is larger than the window of the last step;
3. bounded-knapsack dynamic programming over the lengths left finds the largest sum that fits the
   rest, mostly the rest itself (sums are bits of an integer, counts go in binary parts);
4. where the budget is missed by as much as the greatest common divisor of the lengths or more, the
   window grows and the steps are taken again, at last with a window that holds the whole budget.

So the sum reached is the largest that any choice of documents has: either nothing can be nearer to
the budget, or the program has seen all documents and the whole budget. Which documents of a length
are drawn follows a seeded hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import bits_for, drawn

#: Budget left to the dynamic program at first, in tokens: a few long documents. It grows until the sum can't be better.
WINDOW = 65_536


@dataclass
class Draw:
    source: str
    budget: int
    passes: int  # times every document of the source is used
    extra: dict[int, int]  # length -> documents used once more
    got: int


def subset_sum(counts: dict[int, int], target: int) -> dict[int, int]:
    """Lengths and counts within ``counts`` whose sum is the largest possible up to ``target``."""
    mask = (1 << (target + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []  # length, number of documents, sums reachable before
    for length in sorted(counts, reverse=True):
        left = min(counts[length], target // length)
        k = 1
        while left > 0 and not reach >> target & 1:
            k_now = min(k, left)
            steps.append((length, k_now, reach))
            reach = (reach | reach << (length * k_now)) & mask
            left -= k_now
            k *= 2
        if reach >> target & 1:
            break
    at = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, k, before in reversed(steps):
        if before >> at & 1:
            continue
        at -= length * k
        chosen[length] = chosen.get(length, 0) + k
    return chosen


def draw(source: str, counts: dict[int, int], budget: int, max_repeats: int, window: int = WINDOW) -> Draw:
    """How often the documents of a source are used, from its counts per length."""
    tokens = sum(length * n for length, n in counts.items())
    if not tokens or budget <= 0 or max_repeats <= 0:
        return Draw(source, max(budget, 0), 0, {}, 0)
    passes = min(max_repeats, budget // tokens)
    goal = budget - passes * tokens
    extra, rest = {}, max(goal, 0)
    if passes < max_repeats and goal > 0:
        unit = math.gcd(*counts)
        while True:
            extra, rest = _once_more(counts, tokens, goal, window)
            if rest < unit or window >= goal:
                break
            window *= 16
    return Draw(source, budget, int(passes), extra, budget - rest)


def _once_more(counts: dict[int, int], tokens: int, goal: int, window: int) -> tuple[dict[int, int], int]:
    """Documents per length to use once more, and what is left of ``goal``."""
    extra: dict[int, int] = {}
    rest = goal
    if window < goal:
        lost = []
        for length, n in counts.items():
            whole, part = divmod(n * goal, tokens)
            if whole:
                extra[length] = whole
                rest -= whole * length
            lost.append((part, length))
        for _, length in sorted(lost, reverse=True):
            if rest <= window:
                break
            if length <= rest and extra.get(length, 0) < counts[length]:
                extra[length] = extra.get(length, 0) + 1
                rest -= length
    left = {length: n - extra.get(length, 0) for length, n in counts.items() if n > extra.get(length, 0) and length <= rest}
    for length, n in subset_sum(left, rest).items():
        extra[length] = extra.get(length, 0) + n
        rest -= n * length
    return extra, rest


def plan(counts: dict[str, dict[int, int]], targets: list[tuple[str, float, int]], total: int | None = None) -> list[Draw]:
    """A draw per target (source, share, max_repeats). A source without tokens but with a share holds
    nothing back: it gives nothing and the shares of the others are met within the total."""
    sums = {s: sum(k * n for k, n in c.items()) for s, c in counts.items()}
    live = [(s, w, m) for s, w, m in targets if w > 0 and m > 0 and sums.get(s, 0) > 0]
    if total is None:
        total = int(min((m * sums[s] / w for s, w, m in live), default=0))
    return [draw(s, counts.get(s, {}), int(w * total), m) for s, w, m in targets]


def length_counts(sizes: DataFrame, sources: list[str]) -> tuple[dict[str, dict[int, int]], int]:
    """Documents per source and exact length: as many numbers as there are lengths, not documents."""
    rows = sizes.where(F.col("source").isin(*sources) & (F.col("n_tokens") > 0)).groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[str, dict[int, int]] = {}
    for r in rows:
        counts.setdefault(r["source"], {})[r["n_tokens"]] = r["n"]
    return counts, sum(r["n"] for r in rows)


def mix(sizes: DataFrame, targets: list[tuple[str, float, int]], seed: int = 0, total: int | None = None) -> tuple[DataFrame, list[Draw]]:
    """(doc_id, source, n_tokens, repeats) of every document used, and the draws.

    ``sizes``: (doc_id, source, n_tokens) with distinct doc_id, as a stored table: it is read
    twice. Documents of null or unlisted sources and documents without tokens are never used.
    """
    counts, rows = length_counts(sizes, [s for s, _, _ in targets])
    draws = plan(counts, targets, total)
    spark = sizes.sparkSession
    table = [(d.source, length, d.passes, d.extra.get(length, 0)) for d in draws for length in counts.get(d.source, {}) if d.passes or d.extra.get(length)]
    places = spark.createDataFrame(table, "source string, n_tokens long, passes long, more long")
    docs = sizes.select("doc_id", "source", "n_tokens").join(places, ["source", "n_tokens"])
    rows_ranked = drawn(docs, ["source", "n_tokens"], F.xxhash64(F.lit(seed), "doc_id"), ["doc_id"], bits_for(rows))
    used = rows_ranked.withColumn("repeats", (F.col("passes") + (F.col("rank") < F.col("more")).cast("long")).cast("int"))
    return used.where("repeats > 0").select("doc_id", "source", "n_tokens", "repeats"), draws
