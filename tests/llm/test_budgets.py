import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing, packing, tokens


def bins_of(plan):
    out = {}
    for size, first, last, b, per in plan.rows:
        for r in range(first, last):
            out.setdefault(b + (r - first) // per, []).append(size)
    return out


@pytest.mark.parametrize("seed", range(25))
def test_plans_hold_all_and_fit(seed):
    rng = random.Random(seed)
    cap = rng.choice([7, 16, 50])
    counts = Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 300)))
    plan = packing.make_plan(dict(counts), cap)
    bins = bins_of(plan)
    assert all(sum(b) <= cap for b in bins.values()) and len(bins) == plan.bins
    assert Counter(s for b in bins.values() for s in b) == counts
    total = sum(s * n for s, n in counts.items())
    assert plan.bins <= 1 + 1.25 * -(-total // cap) + sum(n for s, n in counts.items() if 2 * s > cap)


def least(items, cap):
    """Least number of containers, by full search."""
    best = [len(items)]

    def walk(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k, r in enumerate(rooms):
            if r >= items[i] and r not in rooms[:k]:
                walk(i + 1, rooms[:k] + [r - items[i]] + rooms[k + 1 :])
        walk(i + 1, rooms + [cap - items[i]])

    walk(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_an_optimum(seed):
    rng = random.Random(seed)
    cap = rng.randint(6, 20)
    items = sorted((rng.randint(1, cap) for _ in range(rng.randint(1, 9))), reverse=True)
    plan = packing.Plan(cap)
    left = dict(Counter(items))
    packing.reduce(left, plan)
    rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
    assert plan.fixed + least(rest, cap) == least(items, cap)


def test_plans_do_not_grow_with_the_items():
    sizes = []
    for n in (10**3, 10**6, 10**9):
        plan = packing.make_plan({60: n, 39: n, 19: n, 18: n}, 100)
        sizes.append(len(plan.rows))
        assert sum(last - first for _, first, last, _, _ in plan.rows) == 4 * n
    assert sizes[0] == sizes[1] == sizes[2] < 20


def test_plan_keys():
    plan = packing.make_plan({5: 3, 70: 4, 2**40: 2}, 2**40)
    a = packing._arrays(plan)
    assert list(a["key"]) == sorted(a["key"]) and len(set(a["key"])) == len(a["key"])
    big = packing.Plan(10)
    big.place(3, 2**61, 0)
    with pytest.raises(OverflowError):
        packing._arrays(big)


def test_pack_rows(spark):
    rows = [(1, 5), (2, 5), (3, 25), (4, 0), (5, None), (6, 10), (7, 3)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long")
    got = packing.pack(df, [(1, 10), (2, 100)]).collect()
    for shape, cap in ((1, 10), (2, 100)):
        own = [r for r in got if r.shape_id == shape]
        assert {d: sum(r.n_tokens for r in own if r.doc_id == d) for d in {r.doc_id for r in own}} == {1: 5, 2: 5, 3: 25, 6: 10, 7: 3}
        load = Counter()
        for r in own:
            load[r.container_id] += r.n_tokens
        assert max(load.values()) <= cap
        assert all(sum(r.doc_id == d for r in own) == 1 for d, n in rows if n and n <= cap)
    assert len({r.container_id for r in got if r.shape_id == 1}) == 5
    assert packing.pack(df.limit(0), [(1, 10)]).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_subset_sum(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(5)}
    target = rng.randint(0, 150)
    reach = {0}
    for length, n in counts.items():
        reach = {s + k * length for s in reach for k in range(n + 1)}
    chosen = mixing.subset_sum(counts, target)
    assert sum(k * n for k, n in chosen.items()) == max(s for s in reach if s <= target)
    assert all(n <= counts[k] for k, n in chosen.items())


@pytest.mark.parametrize("seed", range(60))
def test_windows_reach_the_optimum_of_the_whole_budget(seed):
    rng = random.Random(seed)
    step = rng.choice([1, 2, 6])
    counts = {step * rng.randint(1, 60): rng.randint(1, 6) for _ in range(rng.randint(1, 6))}
    tokens_ = sum(k * n for k, n in counts.items())
    budget = rng.randint(1, tokens_)
    best = sum(k * n for k, n in mixing.subset_sum(counts, budget).items())  # one program over all documents
    for window in (1, 10, 10**6):
        d = mixing.draw("s", counts, budget, 1, window)
        assert d.got == sum(k * n for k, n in d.extra.items()) + d.passes * tokens_ == best
        assert all(n <= counts[k] for k, n in d.extra.items())


def test_a_draw_depends_on_its_source_alone(spark):
    rows = [(i, "a", 10 + i % 5) for i in range(300)]
    more = [(10_000 + i, "b", 7) for i in range(3000)]
    cols = "doc_id long, source string, n_tokens long"
    few, many = (spark.createDataFrame(r, cols) for r in (rows, rows + more))
    one = {(r.doc_id, r.repeats) for r in mixing.mix(few, [("a", 1.0, 1)], seed=3, total=2000)[0].collect()}
    assert one == {(r.doc_id, r.repeats) for r in mixing.mix(many, [("a", 1.0, 1)], seed=3, total=2000)[0].collect()}


def test_draws():
    d = mixing.draw("s", {10: 100, 7: 3}, 2 * 1021 + 107, 4)
    assert d.passes == 2 and d.got == 2 * 1021 + 107 and all(n <= {10: 100, 7: 3}[k] for k, n in d.extra.items())
    assert mixing.draw("s", {10: 2}, 1000, 3).got == 60 and mixing.draw("s", {}, 5, 1).got == 0
    a, b, c = mixing.plan({"a": {10: 100}, "b": {10: 10}}, [("a", 0.5, 1), ("b", 0.5, 4), ("c", 0.1, 1)])
    assert (a.got, b.got, c.got) == (400, 400, 0) and b.passes == 4


def test_mix_rows(spark):
    rows = [(i, "a", 10 + i % 5) for i in range(200)] + [(1000 + i, "b", 8) for i in range(20)] + [(2000, None, 5), (2001, "x", 5), (2002, "a", 0), (2003, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    used, draws = mixing.mix(df, [("a", 0.6, 1), ("b", 0.4, 3)], seed=1)
    got = used.collect()
    tokens_of = {s: sum(r.n_tokens * r.repeats for r in got if r.source == s) for s in "ab"}
    assert tokens_of == {d.source: d.got for d in draws} and abs(tokens_of["a"] / (tokens_of["a"] + tokens_of["b"]) - 0.6) < 0.01
    assert all(r.repeats <= (1 if r.source == "a" else 3) for r in got) and len({r.doc_id for r in got}) == len(got)
    again = {(r.doc_id, r.repeats) for r in mixing.mix(df, [("a", 0.6, 1), ("b", 0.4, 3)], seed=1)[0].collect()}
    other = {(r.doc_id, r.repeats) for r in mixing.mix(df, [("a", 0.6, 1), ("b", 0.4, 3)], seed=2)[0].collect()}
    assert again == {(r.doc_id, r.repeats) for r in got} != other
    assert mixing.mix(df.limit(0), [("a", 1.0, 1)])[0].count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello hello"), (2, None), (3, ""), (4, "x" * 200_000), (5, "<|endoftext|>")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(df, F.col("text"), F.col("doc_id")).collect()}
    assert got[2] == got[3] == 0 and 2 <= got[1] <= 4 and got[4] > 1000 and got[5] > 1
