from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import jsonx
from millrace.operators import orphans

T = lambda d: datetime(2024, 1, d)
REFS = "src_table string, src_pos long, ref_table string, ref_id string, at timestamp"


def run(spark, refs, loads, removals):
    r = spark.createDataFrame(refs, REFS)
    lives = orphans.lifetimes("p", spark.createDataFrame(loads, "ref_id string, at timestamp"), spark.createDataFrame(removals, "ref_id string, at timestamp"))
    return sorted((x.src_pos, x.ref_id) for x in orphans.orphan_references(r, lives).collect())


def test_lifetimes(spark):
    refs = [("s", i, "p", k, T(d) if d else None) for i, (k, d) in enumerate([("a", 1), ("a", 2), ("a", 4), ("a", 6), ("b", 9), ("a", None), ("b", None), ("c", 3), ("c", 5)])]
    loads = [("a", T(2)), ("a", T(2)), ("a", T(6)), ("c", T(3)), (None, T(1)), ("d", None)]
    removals = [("a", T(4)), ("a", T(1)), ("c", T(3)), ("c", T(5)), (None, T(2))]
    # a lives on [2, 4) and from 6; b never; c's removal at its own load time comes first, so it lives on [3, 5)
    assert run(spark, refs, loads, removals) == [(0, "a"), (2, "a"), (4, "b"), (6, "b"), (8, "c")]


def test_empty(spark):
    assert run(spark, [], [("a", T(1))], []) == []
    assert run(spark, [("s", 1, "p", "a", T(1))], [], []) == [(1, "a")]


def live(loads, removals, t):
    return any(i <= t and not any(i < r <= t for r in removals) for i in loads)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 9)), max_size=8), st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 9)), max_size=8))
def test_against_brute_force(spark, loads, removals):
    refs = [("s", i, "p", k, T(d)) for i, (k, d) in enumerate((k, d) for k in "abc" for d in range(1, 10))]
    want = sorted(
        (i, k) for _, i, _, k, t in refs if not live([T(d) for x, d in loads if x == k], [T(d) for x, d in removals if x == k], t)
    )
    assert run(spark, refs, [(k, T(d)) for k, d in loads], [(k, T(d)) for k, d in removals]) == want


def test_references_and_report(spark):
    df = spark.createDataFrame([(1, ["x", "x", None, "y"], T(3), "clash"), (2, None, T(3), ""), (3, [], T(3), None)], "pos long, ids array<string>, at timestamp, ref_id string")
    r = orphans.references(df, "s", "p", F.col("pos"), F.col("ids"), F.col("at"))
    assert sorted((x.src_pos, x.ref_id) for x in r.collect()) == [(1, "x"), (1, "y")]
    rep = orphans.orphan_report(r, r.where("ref_id = 'x'")).collect()
    assert [(x.period, x.n_references, x.n_orphans) for x in rep] == [("2024-01", 2, 1)]
    edge = r.withColumn("at", F.expr("timestamp'2024-01-31 23:30:00Z'"))
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = {p: [x.period for x in orphans.orphan_report(edge, edge, p).collect()] for p in ("month", "week", "year")}
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == {"month": ["2024-01"], "week": ["2024-01-29"], "year": ["2024"]}


def test_strict_objects_and_ids(spark):
    h = "ab" * 32
    rows = ['{"a": 1}', ' {"a": 1}\n', '{"a": 1} x', '{"a": 1}{"b": 2}', '[1]', '"x"', "", None, "{'a': 1}", '{"a": NaN}', '{"a": 1', '{}', '{"a":1}]', '{"a":1},0']
    df = spark.createDataFrame([(r,) for r in rows], "j string")
    assert [x.v for x in df.select(jsonx.is_object(F.col("j")).alias("v")).collect()] == [True, True, *[False] * 9, True, False, False]
    ids = spark.createDataFrame([(f"images/{h.upper()}.jpg",), (h + "0",), (None,), ("",), (f"{h},x{h}",)], "v string")
    assert [x.i for x in ids.select(jsonx.image_id(F.col("v")).alias("i")).collect()] == [h, None, None, None, h]
    assert [len(x.i) for x in ids.select(jsonx.image_ids(F.col("v")).alias("i")).collect()] == [1, 0, 0, 0, 2]
