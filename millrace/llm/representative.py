"""One surviving record per group of duplicates, built bundle by bundle.

Fields that only make sense together form a *bundle* and are taken whole from one row (width with
height). Functional dependencies between bundles restrict the choice further: with ``("url", "size")``
the surviving size must have been seen beside the surviving url, if any usable size of the group was
seen beside a usable url. Where none was, the size is free and its best usable row counts. Among the
allowed combinations the one with the most filled bundles, then the highest summed trust, then the
latest times, then the smallest positions wins. The combination is found by branch and bound:

* dominance: of all rows with the same bundle and the same determining value only the best can be
  in an optimal combination. This is one map-side aggregation, so a group holding a third of all
  rows reaches a task as one row per partition (or per determining value). A bundle that no
  dependency links to another is decided by it, as the sum is best where each part is;
* for linked bundles each determining value has a bound: its own rank and the best of each bundle
  that depends on it, seen beside it. Values whose bound is below the best of the group are cut off
  by joins on aggregates, before anything is gathered, so what a task gets of a group is a handful of
  candidates, however many determining values the group has;
* these are searched depth first, best trust first, cutting off branches whose bound (value so far +
  best of each open bundle) doesn't beat the incumbent.

Dependencies form stars: a bundle may determine several, and none of these determines another.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import materialize

#: Stands for "no time" in sums of times; far below any real time in microseconds.
NO_TIME = -(10**16)
#: Trust of rows whose source is not listed.
NO_TRUST = -1000

def solve(candidates: dict[str, list[tuple]], deps: list[tuple[str, str]]) -> dict[str, int]:
    """Branch and bound for one group.

    ``candidates``: bundle -> [(trust, at, pos, sig)]; ``sig`` is the determining value the
    candidate belongs to (its own for a determining bundle). A bundle without a candidate of any
    determining value is free. Returns bundle -> pos.
    """
    parent = {b: a for a, b in deps}
    order: list[str] = []
    names = sorted(candidates)
    while len(order) < len(names):  # determining bundles first
        ready = [n for n in names if n not in order and (parent.get(n) not in candidates or parent[n] in order)]
        order += ready or [n for n in names if n not in order]
    score = lambda c: (1, c[0], c[1], -c[2])
    ranked = {n: sorted(candidates[n], key=score, reverse=True) for n in order}
    rest = [(0, 0, 0, 0)]
    for n in reversed(order):
        rest.append(tuple(map(sum, zip(rest[-1], score(ranked[n][0])))))
    rest.reverse()  # rest[i]: the most that order[i:] can add
    tied = {n for n in order if parent.get(n) in candidates and {c[3] for c in candidates[n]} & {c[3] for c in candidates[parent[n]]}}
    best: list = [None, {}]

    def walk(i: int, have: tuple, taken: dict) -> None:
        if best[0] is not None and tuple(map(sum, zip(have, rest[i]))) <= best[0]:
            return
        if i == len(order):
            best[:] = [have, dict(taken)]
            return
        n = order[i]
        p = parent.get(n)
        options = ranked[n] if n not in tied or p not in taken else [c for c in ranked[n] if c[3] == taken[p][3]]
        for c in options:
            taken[n] = c
            walk(i + 1, tuple(map(sum, zip(have, score(c)))), taken)
            del taken[n]
        if not options:
            walk(i + 1, have, taken)

    walk(0, (0, 0, 0, 0), {})
    return {n: c[2] for n, c in best[1].items()}


def _search(deps: list[tuple[str, str]], out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, fields, poss, values = [], [], [], []
            for k, cands in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by: dict[str, list[tuple]] = {}
                value = {}
                for c in cands:
                    by.setdefault(c["bundle"], []).append((c["trust"], c["at"], -c["neg_pos"], c["sig"]))
                    value[c["bundle"], -c["neg_pos"]] = c["value"]
                for name, pos in solve(by, deps).items():
                    keys.append(k)
                    fields.append(name)
                    poss.append(pos)
                    values.append(value[name, pos])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(fields, pa.string()), pa.array(poss, pa.int64()), pa.array(values, pa.string())], schema=out)

    return run


_RANKS = ("trust", "at", "neg_pos")


def _bounded(per: DataFrame, det: str, below: list[str], least: int = 1) -> DataFrame:
    """Cut off determining values that can't be in an optimal combination, without gathering them.

    ``per``: (key, sig, n_rows, and for each bundle the best row under the determining value ``sig``).
    The bound of a value is its rank and those of the best dependents seen beside it, which is tight,
    so only ties stay. A dependent bundle never seen beside a determining value is free: its best row
    is kept and adds the same to every combination. Groups of fewer than ``least`` rows are left out.
    """
    zero = F.struct(F.lit(0).alias("trust"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("neg_pos"))
    filled = sum((F.col(b).isNotNull().cast("int") for b in below), F.lit(1))
    plain = lambda c: F.struct(*[c[f].alias(f) for f in _RANKS])
    parts = [plain(F.col(det)), *[F.when(F.col(b).isNotNull(), plain(F.col(b))).otherwise(zero) for b in below]]
    bound = F.struct(filled.alias("n"), *[sum((x[f] for x in parts[1:]), parts[0][f]).alias(f) for f in _RANKS])
    per = per.withColumn("bound", F.when(F.col(det).isNotNull(), bound))
    top = per.groupBy(F.col("key").alias("k")).agg(
        F.max("bound").alias("known"), F.sum("n_rows").alias("n"), *[F.max(b).alias(f"top_{b}") for b in below], *[F.max(F.when(F.col(det).isNotNull(), F.col(b))).isNull().alias(f"free_{b}") for b in below]
    )
    best = F.col("bound") == F.col("known")
    value = {det: F.when(best, F.col(det))} | {b: F.when(best | F.col(f"free_{b}") & (F.col(b) == F.col(f"top_{b}")), F.col(b)) for b in below}
    offers = F.explode(F.array(*[F.struct(F.lit(n).alias("bundle"), v.alias("s")) for n, v in value.items()]))
    kept = per.join(top.where(F.col("n") >= least), F.col("key") == F.col("k")).select("key", "sig", offers.alias("o")).where("o.s is not null")
    return kept.select("key", "o.bundle", "sig", "o.s.*")


def choose(
    df: DataFrame, key: Column, pos: Column, trust: Column, at: Column, usable: dict[str, Column],
    deps: list[tuple[str, str]] | None = None, values: dict[str, Column] | None = None, least: int = 1, carry: dict[str, Column] | None = None,
) -> DataFrame:
    """(key, field_name, pos, value): the row each bundle of each group survives from.

    ``usable``: bundle -> condition; a bundle without a usable row gives no row. ``trust`` null
    ranks below all, ``at`` (microseconds) null is oldest. ``values``: value of each determining
    bundle, needed for ``deps``. ``carry``: what the result tells as ``value`` of a bundle, as text,
    so that nothing has to be joined back; null where not given. ``least``: smallest number of rows of
    a group (repeated rows count). Rows with a null key belong to no group; an empty table gives an
    empty result. Columns of ``df`` may have any names.
    """
    deps = deps or []
    det = {b: a for a, b in deps}
    if set(det) & set(det.values()):
        raise ValueError("dependencies have to form stars: a bundle that depends on another determines none")
    t, a = F.coalesce(trust, F.lit(NO_TRUST)), F.coalesce(at, F.lit(NO_TIME))
    rank = F.struct(t.cast("int").alias("trust"), a.cast("long").alias("at"), (-pos.cast("long")).alias("neg_pos"))
    linked = [n for n in usable if n in det or n in det.values()]
    free = [n for n in usable if n not in linked]
    told = {n: (carry or {}).get(n, F.lit(None)).cast("string") for n in usable}
    stars = {d: [b for b, x in det.items() if x == d] for d in sorted(set(det.values()))}
    rows = df.select(
        key.alias("key"), rank.alias("rank"), *[F.coalesce(u, F.lit(False)).alias(f"u_{n}") for n, u in usable.items()],
        *[F.when(usable[d], F.xxhash64(values[d])).alias(f"s_{d}") for d in stars], *[v.alias(f"v_{n}") for n, v in told.items()],
    ).where("key is not null")
    # Sums over bundles are best where each component of linked bundles is, so components are searched apart
    best_of = lambda n: F.max(F.when(F.col(f"u_{n}"), F.struct("rank.*", F.col(f"v_{n}").alias("value")))).alias(n)  # noqa: E731 - the value is behind the position, so it never decides
    won = None
    if free:
        best = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *[best_of(n) for n in free]).where(F.col("n") >= least)
        offers = F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(n).alias("s")) for n in free]))
        won = best.select("key", offers.alias("o")).where("o.s is not null").select("key", "o.field_name", (-F.col("o.s.neg_pos")).alias("pos"), "o.s.value")
    for d, below in stars.items():
        per = rows.groupBy("key", F.col(f"s_{d}").alias("sig")).agg(F.count(F.lit(1)).alias("n_rows"), *[best_of(n) for n in (d, *below)])
        few = _bounded(materialize(per, "candidates"), d, below, least)
        groups = few.groupBy("key").agg(F.collect_list(F.struct("bundle", "sig", *_RANKS, "value")).alias("c"))
        out = pa.schema([("key", pa.string()), ("field_name", pa.string()), ("pos", pa.int64()), ("value", pa.string())])
        more = groups.mapInArrow(_search([(d, b) for b in below], out), "key string, field_name string, pos long, value string")
        won = more if won is None else won.unionByName(more)
    return won
