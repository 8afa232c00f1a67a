import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import pages, urls
from millrace.operators import chat, dedup, localize, ranking, size_filter

A, B, C = "a" * 64, "b" * 64, "c" * 64


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r.x for r in df.select(f(F.col("v")).alias("x")).collect()]


def test_url_normalization(spark):
    got = column(spark, ["https://h.example/a", "//h.example/%C3%A9+1", "h/100%", "//u/c/thumb/e/e9/P.jpg/250px-P.jpg", None, ""], urls.normalize)
    assert got == ["h.example/a", "h.example/é+1", "h/100%", "u/c/e/e9/P.jpg", None, ""]


def test_url_kinds(spark):
    assert column(spark, ["a/b", "#x", "//h/x", "https://h", "data:x", "", None], urls.is_relative) == [True, False, False, False, False, False, False]
    assert column(spark, ["https://netflix.com/x", "https://h/", None], urls.is_social) == [True, False, False]
    assert column(spark, ["a/B.PNG?x", "a.txt", None], urls.is_image_file) == [True, False, False]
    assert column(spark, [" ./images/x1/?q#f", "images/", "http://h/images/x", None, "images/a b"], urls.local_image_id) == ["x1", None, None, None, "a b"]
    assert column(spark, ["a.png 1x, b.png 2x", "a.png 100w, b.png 300w, c.png 300w", "", None], urls.best_of_srcset) == ["a.png", "b.png", None, None]


def test_page_expressions(spark):
    html = '<title> X – Wikipedia </title><link rel="canonical" href="https://h/x"><a href="/wiki/Category:A">A &amp; B</a><a href="/wiki/Category:All_x">All x</a>'
    assert column(spark, [html, "", None], pages.title) == ["X", None, None]
    assert column(spark, [html, "", None], pages.canonical_url) == ["https://h/x", None, None]
    assert column(spark, [html, ""], pages.categories) == [["A & B"], []]
    assert column(spark, ["---\na: 1\n---\n\nx\n---\ny", "x\n---\n", ""], pages.without_front_matter) == ["x\n---\ny", "x\n---\n", ""]
    assert column(spark, ["a​b﻿", None], pages.without_invisible) == ["ab", None]
    assert column(spark, ["漢字漢字a", "abc漢", "", None], pages.is_cjk) == [True, False, False, False]
    assert column(spark, ["https://en.wikipedia.org/x", "https://wiki.a.org/", "https://h.example"], pages.is_wiki_url) == [True, True, False]


def test_image_rewriting(spark):
    html = '<p><img data-x=1 src="//h/a" srcset="a 1x"><img alt="n"><IMG SRC=\'//h/b\'>$1\\</p>'
    df = spark.createDataFrame([(html, {"//h/a": "images/1$"}), (html, None), (None, {"x": "y"})], "h string, m map<string,string>")
    got = [r.x for r in df.select(pages.rewrite_images(F.col("h"), F.col("m")).alias("x")).collect()]
    assert got == [html.replace('"//h/a" srcset="a 1x"', '"images/1$"'), html, None]


def test_host_references(spark):
    html = '<img src="//upload.wikimedia.org/c/thumb/e/x.jpg/9px-x.jpg"><img src="//h/x.jpg"><img src="//upload.wikimedia.org/y">'
    df = spark.createDataFrame([(html, {"upload.wikimedia.org/c/e/x.jpg": "i1", "h/x.jpg": "i2"})], "h string, m map<string,string>")
    assert df.select(pages.host_refs(F.col("h"), F.col("m")).alias("x")).first().x == {"//upload.wikimedia.org/c/thumb/e/x.jpg/9px-x.jpg": "images/i1"}


def tables(spark):
    info = lambda **k: json.dumps(k)
    text = [
        (0, "t0", info(url="https://p/0", image_ids=[A, B, A, C]), '<img src="//h/1.jpg"><img src="https://h/1.jpg"><img src="//h/9.jpg">', None),
        (1, "t1", "broken", '<img src="//h/1.jpg">', ["x"]),
        (2, "t2", info(image_ids=[B]), None, None),
    ]
    labels = [
        (0, A, info(image_url="http://h/2.jpg", image_url_ori="//h/1.jpg"), "", ["x", "", None, "y"]),
        (1, B, info(image_url="https://h/1.jpg"), "d1", None),
        (2, A, info(image_url="http://h/3.jpg", width=5), None, ["y", "z"]),
        (3, B, None, "d2", ["q"]),
        (4, None, info(image_url="//h/9.jpg"), "", []),
    ]
    cols = "pos long, id string, info string, data string, tags array<string>"
    return spark.createDataFrame(text, cols), spark.createDataFrame(labels, cols)


def test_localize(spark):
    got = localize.localize(*tables(spark))
    text = {r.pos: r for r in got.text.collect()}
    assert text[0].data == f'<img src="images/{A}"><img src="images/{A}"><img src="//h/9.jpg">' and text[0].n_used == 2
    assert text[0].image_ids == [A, B, C] and text[1].data == '<img src="//h/1.jpg">' and text[2].data is None
    assert sorted((r.pos, r.image_url_normalized, r.html_url) for r in got.missing.collect()) == [(0, "h/9.jpg", "https://p/0"), (1, "h/1.jpg", "")]
    assert sorted((r.pos, r.image_id, r.type) for r in got.unmatched.collect()) == [(0, C, "image_id_no_candidate_urls"), (2, B, "image_id_not_matched_to_html_url")]
    c = got.counters().first()
    assert (c.rows, c.rewritten_rows, c.rewritten_images, c.missing_urls, c.unmatched_image_ids) == (3, 1, 2, 2, 2)


def test_label_merge(spark):
    _, labels = tables(spark)
    got = {r.id: r for r in dedup.merge_labels(labels).collect()}
    assert set(got) == {A, B} and got[A].tags == ["x", "y", "z"] and got[A].data == "" and got[B].data == "d1"
    assert [json.loads(x) for x in json.loads(got[A].info)["info_addtional"]] == [{"image_url": "http://h/3.jpg", "width": 5}]
    assert json.loads(got[B].info)["info_addtional"] == ["{}"] and got[A].n_rows == 2
    assert [(r.image_id, r.first_data, r.duplicate_data) for r in dedup.data_conflicts(labels).collect()] == [(B, "d1", "d2")]
    assert dedup.merge_labels(labels.limit(0)).count() == 0
    assert got[A].n_variants == 2 and got[A].part == 0
    single = dedup.merge_labels(labels.where("pos = 0")).first()
    assert json.loads(single.info)["info_addtional"] == []


def test_label_merge_keeps_every_variant_of_a_hot_id(spark):
    df = spark.range(1500).selectExpr("id as pos", "if(id < 1200, 'hot', 'cold') as id", """concat('{"width": ', id % 700, '}') as info""", "'' as data", "cast(null as array<string>) as tags")
    for per in (100, 500, 1000):
        rows = sorted(dedup.merge_labels(df, per_part=per).collect(), key=lambda r: (r.id, r.part))
        lists = [(r.id, [json.loads(x)["width"] for x in json.loads(r.info)["info_addtional"]]) for r in rows]
        got = {k: [w for i, ws in lists for w in ws if i == k] for k in ("hot", "cold")}
        assert got == {"hot": list(range(1, 700)), "cold": [*range(501, 700), *range(100)]} and max(len(w) for _, w in lists) <= per
        assert [(r.id, r.n_variants, r.n_rows) for r in rows if r.part == 0] == [("cold", 300, 300), ("hot", 700, 1200)]
        assert len(rows) == -(-299 // per) + -(-699 // per) and len({r.pos for r in rows}) == len(rows)


def test_numbers_in_parts(spark):
    df = spark.range(5000).selectExpr("id * 977 % 5000 as pos", "if(id % 3 > 0, 'hot', if(id % 5 > 0, 'b', null)) as k")
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.pos):
        want.setdefault(r.k, []).append(r.pos)
    for cut in (10, 700, 10**6):
        got = ranking.ranked(df, ["k"], F.floor(F.col("pos") / cut), "pos").collect()
        assert len(got) == 5000 and all(want[r.k][r.rank] == r.pos for r in got)
    orders = [sorted((r.k or "", r["rank"], r.pos) for r in ranking.drawn(df, ["k"], F.xxhash64("pos"), ["pos"], bits).collect()) for bits in (1, 3, 9)]
    assert orders[0] == orders[1] == orders[2]
    some = df.where("k = 'b'")  # the numbers of a group don't depend on other rows
    assert sorted((r.k, r["rank"], r.pos) for r in ranking.drawn(some, ["k"], F.xxhash64("pos"), ["pos"], 5).collect()) == [x for x in orders[0] if x[0] == "b"]
    assert sorted((r.k, r.nth) for r in dedup.row_positions(df.where("k is not null"), "k").where("nth = 1").collect()) == [("b", 1), ("hot", 1)]


def test_broken_first_info_fails_unless_asked(spark):
    df = spark.createDataFrame([(0, "i", "{x", "", [])], "pos long, id string, info string, data string, tags array<string>")
    with pytest.raises(Exception, match="JSONDecodeError|Expecting"):
        dedup.merge_labels(df).collect()
    assert json.loads(dedup.merge_labels(df, strict=False).first().info) == {"info_addtional": []}


def test_image_dedup(spark):
    rows = [(5, "x", b"1", "s1"), (2, "y", b"2", None), (7, "x", b"3", "s2"), (8, "y", b"4", None), (9, "x", b"5", "s1")]
    df = spark.createDataFrame(rows, "pos long, id string, image_bytes binary, sha256 string")
    assert sorted(r.pos for r in dedup.keep_first(df).collect()) == [2, 5]
    assert dedup.keep_first(df.where("pos < 6")).count() == 2 and dedup.keep_first(df.limit(0)).count() == 0
    assert [(r.image_id, r.first_sha256, r.duplicate_sha256) for r in dedup.hash_conflicts(df).collect()] == [("x", "s1", "s2")]
    assert sorted((r.ordinal, r.id) for r in dedup.first_seen_order(df).collect()) == [(0, "y"), (1, "x")]
    far = df.withColumn("pos", F.col("pos") * 700_000)
    assert sorted((r.ordinal, r.id) for r in dedup.first_seen_order(far).collect()) == [(0, "y"), (1, "x")]


def test_image_dedup_in_the_scan(spark, tmp_path):
    many = spark.range(3000).selectExpr("id as pos", "if(id % 3 = 0, 'hot', cast(id % 1999 as string)) as id", "cast('x' as binary) as image_bytes", "'s' as sha256")
    many.repartition(5).write.parquet(str(tmp_path / "images.parquet"))
    seen, want = set(), []
    for r in sorted(many.collect(), key=lambda r: r.pos):
        if r.id not in seen:
            seen.add(r.id)
            want.append(r.pos)
    stored = spark.read.parquet(str(tmp_path / "images.parquet"))
    kept = dedup.keep_first(stored)
    assert sorted(r.pos for r in kept.collect()) == want and kept.columns == stored.columns
    assert "Exchange" not in kept._jdf.queryExecution().toString()  # bytes stay where they are
    assert dedup.keep_first(stored.where("pos < 2")).count() == 2 and dedup.keep_first(stored.where("pos < 0")).count() == 0


def test_markdown_parts():
    parts = lambda md: chat.parts(md)
    text = lambda s: {"type": "text", "text": s}
    image = lambda i: {"type": "image_url", "image_url": {"url": f"images/{i}"}}
    assert parts(None) == ([text("")], 0) and parts("---\na: b\n---\n") == ([text("")], 0)
    assert parts("a ![x](./images/1?q) b") == ([text("a "), image("1"), text(" b")], 0)
    assert parts("a ![x](http://h/x.png) b") == ([text("a  b")], 1)
    assert parts("[![x](images/1)](http://h/a_(b))c") == ([image("1"), text("c")], 0)
    assert parts("[![x](images/1)] c") == ([text("["), image("1"), text("] c")], 0)
    assert parts("![x(images/1) ![y](images/2)") == ([image("2")], 0)  # the alt text ends at the first bracket
    assert parts("![x] (images/1) ![y](images/2)") == ([text("![x] (images/1) "), image("2")], 0)
    assert parts("![x](images/a(b)c)") == ([image("a(b)c")], 0)
    assert parts("![x](images/1") == ([text("![x](images/1")], 0)


def test_chat_and_size_filter(spark):
    rows = [(0, f"a ![x](images/{A})![y](images/{B})![z](http://h/z)", '{"image_ids": ["old"], "k": 1, "filtered_small_images": 2}', "clash"), (1, None, "broken", None)]
    md = spark.createDataFrame(rows, "pos long, data string, info string, image_id string")
    got = {r.pos: r for r in chat.to_chat(md, "tool").collect()}
    assert json.loads(got[0].info) == {"image_ids": [A, B], "k": 1, "format": "openai", "dropped_nonlocal_images": 1} and got[0].image_id == "clash"
    assert json.loads(got[1].data) == [{"role": "tool", "content": [{"type": "text", "text": ""}]}]
    labels = spark.createDataFrame(
        [(0, A, '{"width": 10, "height": 10}'), (1, A, '{"width": "300", "height": 300.9}'), (2, B, '{"width": 300, "height": 10}'), (3, B, '{"width": "x"}'), (4, C, "[]"), (5, None, None)],
        "pos long, id string, info string",
    )
    assert sorted((r.image_id, r.width, r.height) for r in size_filter.size_index(labels).collect()) == [(A, 300, 300), (B, 300, 10)]
    out = {r.pos: r for r in size_filter.filter_small_images(chat.to_chat(md), labels, 100, 100).collect()}
    assert [b["type"] for b in json.loads(out[0].data)[0]["content"]] == ["text", "image_url"]
    assert json.loads(out[0].info)["filtered_small_images"] == 1 and json.loads(out[0].info)["image_ids"] == [A]
    same = size_filter.filter_small_images(chat.to_chat(md), labels, -5, 0).where("pos = 0").first()
    assert len(json.loads(same.data)[0]["content"]) == 3


@pytest.mark.parametrize("bad", ["x", "[]", '[{"role": "u", "content": "x"}]', '[{"content": ["x"]}]', '[{"content": []}, {}]', "null"])
def test_bad_payloads(bad):
    with pytest.raises(ValueError):
        chat.payload(bad)


def test_payload_forms():
    assert chat.payload('{"messages": [{"content": [{"type": "text"}]}]}') == ([{"type": "text"}], "user")
