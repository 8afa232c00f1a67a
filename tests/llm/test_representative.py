import itertools
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import label_records as L
from millrace.llm import representative as R

ROWS = "k string, pos long, trust int, at long, a string, b string, key string"


def choose(spark, rows, deps=None, least=1):
    df = spark.createDataFrame(rows, ROWS)
    usable = {"a": F.col("a").isNotNull(), "b": F.col("b").isNotNull()}
    got = R.choose(df, F.col("k"), F.col("pos"), F.col("trust"), F.col("at"), usable, deps, {"a": F.col("a")} if deps else None, least)
    return {(r.key, r.field_name): r.pos for r in got.collect()}


def brute(rows, deps):
    """All combinations of rows per bundle of each group; the best by filled bundles, trust, time, position."""
    out = {}
    for k in {r[0] for r in rows} - {None}:
        group = [r for r in rows if r[0] == k]
        a = [r for r in group if r[4] is not None]
        b = [r for r in group if r[5] is not None]
        best = None
        for x, y in itertools.product(a or [None], b + [None]):
            if deps and x is not None:
                beside = [r for r in b if r[4] == x[4]]
                if (y is None) != (not beside) or y is not None and y not in beside:
                    continue
            picked = [r for r in (x, y) if r is not None]
            score = tuple(map(sum, zip(*[(1, r[2] if r[2] is not None else R.NO_TRUST, r[3] if r[3] is not None else R.NO_TIME, -r[1]) for r in picked]))) if picked else (0, 0, 0, 0)
            if best is None or score > best[0]:
                best = (score, x, y)
        if best:
            out |= {(k, n): r[1] for n, r in (("a", best[1]), ("b", best[2])) if r is not None}
    return out


def test_ties_nulls_and_repeats(spark):
    rows = [("g", 3, 5, 7, "x", None, "z"), ("g", 1, 5, 7, "x", "y", "z"), ("g", 2, 5, 7, "x", "y", "z"), ("h", 4, None, None, "x", None, None), (None, 5, 9, 9, "x", "y", None), ("g", 6, 5, None, "x", "y", "z")]
    assert choose(spark, rows) == {("g", "a"): 1, ("g", "b"): 1, ("h", "a"): 4}
    assert choose(spark, rows, least=2) == {("g", "a"): 1, ("g", "b"): 1}
    assert choose(spark, []) == {}


def test_against_brute_force(spark):
    rng = random.Random(3)
    for deps in (None, [("a", "b")]):
        rows = [(rng.choice("gh"), i, rng.choice([None, 1, 2, 9]), rng.choice([None, 5, 6]), rng.choice([None, "x", "y", "z"]), rng.choice([None, "u", "v"]), "c") for i in range(60)]
        assert choose(spark, rows, deps) == brute(rows, deps)


def test_size_survives_where_none_was_seen_beside_a_url(spark):
    rows = [("g", 1, 5, 7, "x", None, "z"), ("g", 2, 9, 7, "y", None, "z"), ("g", 3, 1, 7, None, "u", "z"), ("g", 4, 2, 7, None, "v", "z")]
    rows += [("h", 5, 1, 7, "x", "u", "z"), ("h", 6, 9, 7, "y", None, "z"), ("h", 7, 9, 7, None, "v", "z"), ("i", 8, 1, 7, None, "u", "z")]
    want = {("g", "a"): 2, ("g", "b"): 4, ("h", "a"): 5, ("h", "b"): 5, ("i", "b"): 8}
    assert choose(spark, rows, [("a", "b")]) == want
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(150)}", i, rng.choice([None, 1, 2, 9]), rng.choice([None, 5, 6]), rng.choice([None, None, "x", "y"]), rng.choice([None, None, "u"]), "c") for i in range(600)]
    tied = {r[0] for r in rows if r[4] is not None and r[5] is not None}
    free = [r for r in rows if r[0] not in tied]
    assert 20 < len({r[0] for r in free} & {r[0] for r in free if r[4]} & {r[0] for r in free if r[5]})
    assert choose(spark, rows, [("a", "b")]) == brute([r for r in rows if r[0] in tied], [("a", "b")]) | brute(free, None)


def test_two_dependents_and_carried_values(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ghi"), i, rng.choice([1, 2, 9]), rng.choice([5, 6]), rng.choice([None, "x", "y", "z"]), rng.choice([None, "u", "v"]), rng.choice([None, "c"])) for i in range(90)]
    df = spark.createDataFrame(rows, ROWS)
    usable = {n: F.col(n).isNotNull() for n in ("a", "b")} | {"c": F.col("key").isNotNull()}
    got = R.choose(df, F.col("k"), F.col("pos"), F.col("trust"), F.col("at"), usable, [("a", "b"), ("a", "c")], {"a": F.col("a")}, carry={"a": F.col("a"), "b": F.col("b")})
    got = {(r.key, r.field_name): (r.pos, r.value) for r in got.collect()}
    score = lambda r: (r[2], r[3], -r[1])
    for k in "ghi":
        best = None
        for v in {r[4] for r in rows if r[0] == k and r[4]}:
            picked = {"a": max((r for r in rows if r[0] == k and r[4] == v), key=score)}
            for n, at in (("b", 5), ("c", 6)):
                beside = [r for r in rows if r[0] == k and r[4] == v and r[at]]
                if beside:
                    picked[n] = max(beside, key=score)
            total = (len(picked), *map(sum, zip(*[score(r) for r in picked.values()])))
            if best is None or total > best[0]:
                best = (total, picked)
        assert {n: got[k, n][0] for n in "abc" if (k, n) in got} == {n: r[1] for n, r in best[1].items()}
        assert got[k, "a"][1] == best[1]["a"][4] and got[k, "b"][1] == best[1]["b"][5] and got[k, "c"][1] is None


def test_chains_are_refused(spark):
    df = spark.createDataFrame([], ROWS)
    usable = {n: F.col(n).isNotNull() for n in ("a", "b", "key")}
    with pytest.raises(ValueError, match="stars"):
        R.choose(df, F.col("k"), F.col("pos"), F.col("trust"), F.col("at"), usable, [("a", "b"), ("b", "key")], {"a": F.col("a"), "b": F.col("b")})


def test_what_is_gathered_does_not_grow(spark):
    best = "named_struct('trust', cast(id % 7 as int), 'at', id % 11, 'neg_pos', -id, 'value', 'v')"
    df = spark.range(20000).selectExpr("'hot' as key", "id as sig", "1L as n_rows", f"{best} as a", f"if(id % 2 = 0, {best}, null) as b")
    assert R._bounded(df, "a", ["b"]).count() == 2 and R._bounded(df, "a", ["b"], least=20001).count() == 0


def test_hot_group(spark):
    df = spark.range(20000).selectExpr("'hot' as k", "id as pos", "cast(id % 7 as int) as trust", "id % 11 as at", "cast(id % 5000 as string) as a", "if(id % 3 = 0, 'b', null) as b", "'' as key")
    usable = {"a": F.col("a").isNotNull(), "b": F.col("b").isNotNull()}
    got = R.choose(df, F.col("k"), F.col("pos"), F.col("trust"), F.col("at"), usable, [("a", "b")], {"a": F.col("a")})
    assert {r.field_name for r in got.collect()} == {"a", "b"}


def test_search_prunes_to_the_same_answer():
    c = {"a": [(5, 0, 1, 10), (3, 0, 2, 20)], "b": [(1, 0, 3, 10), (9, 0, 4, 20)]}
    assert R.solve(c, [("a", "b")]) == {"a": 2, "b": 4} and R.solve(c, []) == {"a": 1, "b": 4} and R.solve({}, []) == {}


def column(spark, values, f):
    return [r.x for r in spark.createDataFrame([(v,) for v in values], "v string").select(f(F.col("v")).alias("x")).collect()]


def test_usable_values(spark):
    no = [None, "", " ", "N/A", "(untitled)", "sin título", "无", "—", "Image", "a.jpg", "File:Some name.png", "IMG_0292.JPG", "null", "нет данных"]
    yes = ["a map", "无锡", "Nullarbor", "see a.jpg here", "5", "imagery"]
    assert column(spark, no, L.says_something) == [False] * len(no) and column(spark, yes, L.says_something) == [True] * len(yes)
    assert column(spark, ["302", "302px", "885.0", " 7 ", "1,210", "0", "-1", "auto", "8.5", "", None, "9" * 30], L.whole_number) == [302, 302, 885, 7, 1210, None, None, None, None, None, None, None]
    assert column(spark, ["http://h.example/x", "//h", "h.example/a.jpg", "about:blank", "data:image/gif;base64,R0", "#", "", "a.jpg", None, "https:///x"], L.leads_to_host) == [True, True, True, False, False, False, False, False, False, False]
    one = 1_700_000_000_000_000
    assert column(spark, ["1700000000", "1700000000000", "2023-11-14T22:13:20Z", "2023-11-15T00:13:20+02:00", "", None, "soon"], L.instant) == [one] * 4 + [None] * 3
