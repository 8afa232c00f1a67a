"""Filling containers of fixed capacity with texts, hardly any room left.

Texts longer than the capacity are cut into full containers and a rest; no other text is split. What
to put together is decided on the *counts per size*, at most one number per token of capacity,
however many texts there are:

1. Martello-Toth reduction: sets that dominate every alternative for their largest item are fixed
   for good. {j} alone, if nothing fits beside j; {j, k} with j + k equal to the capacity, since any
   other company of j fits into the place of k; {j, k} with the largest k that fits, if no two items
   fit beside j, or if every two that do fit into k and no three fit beside j;
2. best fit decreasing for the remainder, by groups of containers with the same room.

Both are exact for multisets: a step places all equal items at once, and each step of the reduction
uses up a size, so a plan has as many rows as the capacity allows sizes, not as there are texts. The
texts then learn their places from their number within their size, which is worked out in salted
parts, so neither a hot size nor the whole table is ever in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import bits_for, drawn


class Plan:
    """Places: items ``first <= rank < last`` of a size go to containers from ``bin`` on, ``per`` to each."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int]] = []  # size, first, last, bin, per
        self.bins = 0
        self.fixed = 0
        self._next: dict[int, int] = {}

    def open(self, count: int) -> int:
        self.bins += count
        return self.bins - count

    def place(self, size: int, count: int, bin_: int, per: int = 1) -> None:
        first = self._next.get(size, 0)
        self._next[size] = first + count
        self.rows.append((size, first, first + count, bin_, per))


def reduce(counts: dict[int, int], plan: Plan) -> None:
    """Fix dominating sets; ``counts`` is left with the shrunken instance."""
    cap = plan.capacity

    def fix(j: int, k: int | None, m: int) -> None:
        b = plan.open(m)
        plan.fixed += m
        for s in (j, k):
            if s is not None:
                plan.place(s, m, b)
                counts[s] -= m
                if not counts[s]:
                    del counts[s]

    for j in sorted(counts, reverse=True):  # exact pairs and exact fits
        if j not in counts or 2 * j < cap:
            continue
        k = cap - j
        if k == 0:
            fix(j, None, counts[j])
        elif k == j:
            m = counts[j] // 2
            if m:
                b = plan.open(m)
                plan.fixed += m
                plan.place(j, 2 * m, b, 2)
                counts[j] -= 2 * m
                if not counts[j]:
                    del counts[j]
        elif k in counts:
            fix(j, k, min(counts[j], counts[k]))
    changed = True
    while changed and counts:  # largest item against what can still be beside it
        changed = False
        sizes = sorted(counts)
        j = sizes[-1]
        room = cap - j
        small: list[int] = []
        for s in sizes:
            small += [s] * min(counts[s] - (s == j), 3)
            if len(small) >= 3:
                break
        best = next((s for s in reversed(sizes) if s <= room and counts[s] > (s == j)), None)
        if best is None:
            fix(j, None, counts[j])
            changed = True
        elif len(small) < 2 or small[0] + small[1] > room:  # at most one item beside j
            if best == j:
                m = counts[j] // 2
                b = plan.open(m)
                plan.fixed += m
                plan.place(j, 2 * m, b, 2)
                counts[j] -= 2 * m
                if not counts[j]:
                    del counts[j]
            else:
                fix(j, best, min(counts[j], counts[best]))
            changed = True
        elif (len(small) < 3 or sum(small[:3]) > room) and best != j and _best_pair(sizes, counts, room) <= best:
            # what the conditions ask only gets truer as items go, so the same holds for every next j
            fix(j, best, min(counts[j], counts[best]))
            changed = True


def _best_pair(sizes: list[int], counts: dict[int, int], room: int) -> int:
    """Largest sum of two items that is at most ``room``."""
    a, b, best = 0, len(sizes) - 1, 0
    while a <= b:
        s = sizes[a] + sizes[b]
        if s > room:
            b -= 1
        elif a == b and counts[sizes[a]] < 2:
            break
        else:
            best = max(best, s)
            a += 1
    return best


def best_fit(counts: dict[int, int], plan: Plan) -> None:
    """Best fit decreasing over groups of containers with equal room."""
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> ranges of containers
    heap: list[int] = []
    sizes = sorted(counts, reverse=True)

    def put(room: int, bin_: int, count: int) -> None:
        if count and room:
            if not rooms.get(room):
                rooms[room] = []
                heapq.heappush(heap, room)
            rooms[room].append((bin_, count))

    for s in sizes:
        n = counts[s]
        kept = []
        while n and heap:
            room = heapq.heappop(heap)
            if room < s:
                kept.append(room)  # may still serve smaller items
                continue
            per = room // s
            ranges, rooms[room] = rooms[room], []
            for i, (b, c) in enumerate(ranges):
                full = min(c, n // per)
                if full:
                    plan.place(s, full * per, b, per)
                    put(room - per * s, b, full)
                    n -= full * per
                if full < c:
                    used = full
                    if 0 < n < per:
                        plan.place(s, n, b + full, per)
                        put(room - n * s, b + full, 1)
                        n, used = 0, full + 1
                    put(room, b + used, c - used)
                if not n:
                    for rb, rc in ranges[i + 1 :]:
                        put(room, rb, rc)
                    break
        for r in kept:
            heapq.heappush(heap, r)
        if n:
            per = plan.capacity // s
            full, rest = divmod(n, per)
            b = plan.open(full + (rest > 0))
            plan.place(s, n, b, per)
            put(plan.capacity - per * s, b, full)
            if rest:
                put(plan.capacity - rest * s, b + full, 1)


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    plan = Plan(capacity)
    left = {s: n for s, n in counts.items() if n}
    reduce(left, plan)
    best_fit(left, plan)
    return plan


# --- distributed operator ------------------------------------------------------------------------


def _assign(plans: dict[int, dict[str, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shape, size, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 4))
            bins = np.zeros(b.num_rows, dtype=np.int64)
            for s, p in plans.items():
                m = shape == s
                if m.any():
                    # rows of a plan are sorted by (size, first); the last one at or before an item holds it
                    at = np.searchsorted(p["key"], _key(p["sizes"], size[m], rank[m], int(p["shift"])), side="right") - 1
                    bins[m] = p["bin"][at] + (rank[m] - p["first"][at]) // p["per"][at]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bins), b.column(1), b.column(2), b.column(3)], names=["shape_id", "container_id", "doc_id", "piece_no", "n_tokens"])

    return run


def _key(sizes: np.ndarray, size: np.ndarray, rank: np.ndarray, shift: int) -> np.ndarray:
    """One comparable number per (size, rank): the number of the size among the sizes, then the rank."""
    return (np.searchsorted(sizes, size) << shift) | rank.astype(np.int64)


def _arrays(plan: Plan) -> dict[str, np.ndarray]:
    a = np.array(sorted(plan.rows), dtype=np.int64).reshape(-1, 5)
    sizes = np.unique(a[:, 0])
    shift = 62 - len(sizes).bit_length()
    if len(a) and int(a[:, 2].max()) >> shift:
        raise OverflowError(f"{len(sizes)} sizes with up to {a[:, 2].max()} items each don't fit one 64-bit number")
    return {"key": _key(sizes, a[:, 0], a[:, 1], shift), "sizes": sizes, "shift": np.int64(shift), "first": a[:, 1], "bin": a[:, 3], "per": a[:, 4]}


def pieces(sizes: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """(shape_id, doc_id, piece_no, size): a text in one piece, or its full containers and its rest."""
    offers = F.explode(F.array(*[F.struct(F.lit(i).alias("shape_id"), F.lit(c).cast("long").alias("cap")) for i, c in shapes]))
    rows = sizes.where("n_tokens > 0").select("doc_id", "n_tokens", offers.alias("o")).select("doc_id", "n_tokens", "o.*")
    count = F.ceil(F.col("n_tokens") / F.col("cap")).cast("long")
    rows = rows.select("shape_id", "doc_id", "n_tokens", "cap", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("piece_no"))
    return rows.select("shape_id", "doc_id", "piece_no", F.least("cap", F.col("n_tokens") - F.col("piece_no") * F.col("cap")).alias("size"))


def plans_for(items: DataFrame, shapes: list[tuple[int, int]]) -> tuple[dict[int, Plan], int]:
    """A plan per shape from the counts per size (bounded by the capacities), and the number of items."""
    hist: dict[int, dict[int, int]] = {i: {} for i, _ in shapes}
    total = 0
    for r in items.groupBy("shape_id", "size").agg(F.count(F.lit(1)).alias("n")).collect():
        hist[r["shape_id"]][r["size"]] = r["n"]
        total += r["n"]
    return {i: make_plan(hist[i], c) for i, c in shapes}, total


def pack(sizes: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """(shape_id, container_id, doc_id, piece_no, n_tokens): where each text, or piece of one, goes.

    ``sizes``: (doc_id, n_tokens) with distinct doc_id, as a stored table: it is read twice. Texts
    without tokens go nowhere. Equal sizes are placed in the order of a hash of doc_id.
    """
    items = pieces(sizes, shapes)
    plans, total = plans_for(items, shapes)
    rows = drawn(items, ["shape_id", "size"], F.xxhash64("doc_id", "piece_no"), ["doc_id", "piece_no"], bits_for(total))
    arrays = {i: _arrays(p) for i, p in plans.items()}
    return rows.select("shape_id", "doc_id", "piece_no", "size", "rank").mapInArrow(_assign(arrays), "shape_id int, container_id long, doc_id long, piece_no long, n_tokens long")
