import hashlib
import io
import json
import os
import tarfile

import pytest

from millrace.plans import pipeline
from millrace.sources import dataset, jsonl_tar
from millrace.sources.jsonl_tar import image_info, pairs, text_info
from millrace.streaming import live


def dump(folder, parts):
    for name, entries, members in parts:
        with open(os.path.join(folder, f"{name}.jsonl"), "w") as f:
            f.write("\n\n".join(json.dumps(e) for e in entries) + "\n")
        with tarfile.open(os.path.join(folder, f"{name}.tar"), "w") as tar:
            for n, b in members:
                i = tarfile.TarInfo(n)
                i.size = len(b)
                tar.addfile(i, io.BytesIO(b))


PAGE = "<title>T - Wikipedia</title><article><p>" + "Text of an article. " * 5 + '</p><img src="//h/1.jpg"></article>'


@pytest.fixture
def folder(tmp_path):
    entry = {"html": PAGE, "final_url": "https://p.example/1", "url": "https://p.example/0", "crawl_type": "PC", "empty": "", "images": [
        {"image_file": "images/1.jpg", "image_url": "https://h/1.jpg", "caption_text": "c", "width": 9, "height": 9}, {"image_file": "gone.jpg"}, {"image_file": ""}]}
    dump(tmp_path, [("p0", [entry, {"html": None}], [("images/1.jpg", b"old"), ("images/1.jpg", b"one")]), ("p1", [entry], [("1.jpg", b"two")])])
    (tmp_path / "alone.jsonl").write_text("x")
    return str(tmp_path)


def test_info_builders():
    entry = {"html": "x", "images": [], "url": "u0", "final_url": "u1", "title": "raw", "n": None, "e": ""}
    assert text_info(entry, "u", "t", ["i"]) == {"format": "html", "url": "u", "title": "raw", "image_ids": ["i"], "original_url": "u0", "final_url": "u1"}
    assert image_info({"image_url": "u", "caption_text": "c", "x": None}, "t") == {"text_ids": ["t"], "image_url": "u", "caption_text": "c", "url": "u", "caption": "c"}


def test_no_pairs(tmp_path):
    with pytest.raises(FileNotFoundError):
        pairs(str(tmp_path))


def test_dump_to_dataset(spark, folder, tmp_path):
    ds = dataset.from_dump(spark, folder)
    text = {r.pos: r for r in ds.text.collect()}
    one, two = (hashlib.sha256(b).hexdigest() for b in (b"one", b"two"))
    assert len(text) == 3 and text[0].id == hashlib.sha256(PAGE.encode()).hexdigest()
    info = json.loads(text[0].info)
    assert info["image_ids"] == [one] and info["title"] == "T" and info["original_url"] == "https://p.example/0" and "empty" not in info
    assert sorted(r.data for r in ds.text.collect())[-1] == "None"  # a null page is the word, as in the dump
    assert sorted(r.id for r in ds.images.collect()) == sorted([one, two])
    assert {r.id: bytes(r.image_bytes) for r in ds.images.collect()} == {one: b"one", two: b"two"}
    out = str(tmp_path / "ds")
    dataset.write(ds, out)
    with pytest.raises(Exception, match="exist"):
        dataset.write(ds, out)
    pipeline.run_localize(spark, out, str(tmp_path / "loc"), strict=False)
    loc = dataset.read(spark, str(tmp_path / "loc"))
    assert any(f'images/{one}' in r.data for r in loc.text.collect())
    assert 'rows: 3' in (tmp_path / "loc" / "dataset.yaml").read_text() and (tmp_path / "loc" / "run_info.yaml").exists()
    md, errors = pipeline.parsed(loc)
    assert errors.count() == 0 and md.text.where("data like '%Text of an article%'").count() == 2
    chats = pipeline.chatted(md)
    assert "tags" not in chats.text.columns
    small = pipeline.size_filtered(chats, 10, 10)
    assert all('"image_url"' not in r.data for r in small.text.collect())
    dataset.verify_order(loc.text, small.text)
    # tables that a stage leaves alone are linked, also through several stages
    same = dict.fromkeys(("images", "image_labels"), str(tmp_path / "loc"))
    dataset.write(md, str(tmp_path / "md"), unchanged=same)
    again = dataset.write(chats, str(tmp_path / "chat"), unchanged=dict.fromkeys(same, str(tmp_path / "md")))
    assert not (tmp_path / "chat" / "images.parquet").exists() and all("/loc/images.parquet" in f for f in again.images.inputFiles()) and again.text.count() == 3
    with pytest.raises(FileExistsError, match="exist"):
        dataset.write(chats, str(tmp_path / "chat"), unchanged=same)
    dataset.write(chats, str(tmp_path / "chat"), overwrite=True)
    assert all("/chat/images.parquet" in f for f in dataset.read(spark, str(tmp_path / "chat")).images.inputFiles())
    dataset.optimize(spark, str(tmp_path / "md"), "images")
    assert (tmp_path / "loc" / "images.parquet").exists() and all("/md/images-" in f for f in dataset.read(spark, str(tmp_path / "md")).images.inputFiles())
    dataset.optimize(spark, str(tmp_path / "loc"), "text")
    assert dataset.read(spark, str(tmp_path / "loc")).text.count() == 3
    info = (tmp_path / "loc" / "run_info.yaml").read_text()
    assert "user:" in info and "write_tables_seconds:" in info and "rows: 3" in info


def test_host_images_at_ingest(spark, tmp_path):
    page = '<p><img src="//upload.h.example/thumb/a.jpg/9px-a.jpg"><img src="//upload.h.example/none.jpg"><img src="//other.example/a.jpg"></p>'
    text = spark.createDataFrame([(0, "t0", "{}", page, []), (1, "t1", "{}", None, []), (2, "t2", "{}", page, [])], "pos long, id string, info string, data string, tags array<string>")
    info = json.dumps({"text_ids": ["t0"], "image_url": "https://upload.h.example/a.jpg"})
    labels = spark.createDataFrame([(0, "i0", info, "", []), (1, "i1", info, "", []), (2, "i2", "broken", "", [])], text.schema)
    got = {r.pos: r.data for r in dataset.host_local(dataset.Dataset(text, labels, labels), r"upload\.h\.example").collect()}
    assert got == {0: page.replace("//upload.h.example/thumb/a.jpg/9px-a.jpg", "images/i0"), 1: None, 2: page}


def test_written_dump_comes_back(spark, tmp_path):
    rows = [("<title>é</title>", None, None), (None, "a/b.jpg", b"xyz"), ("", None, None), ("two\nlines", "c.png", b"")]
    df = spark.createDataFrame(rows, "html string, image_file string, image_bytes binary").repartition(2)
    jsonl_tar.write_dump(df, f"file://{tmp_path}/dump")
    ds = dataset.from_dump(spark, f"file://{tmp_path}/dump")
    assert sorted(r.data for r in ds.text.collect()) == ["", "", "<title>é</title>", "two\nlines"]
    assert sorted(bytes(r.image_bytes) for r in ds.images.collect()) == [b"", b"xyz"] and ds.image_labels.count() == 2


def test_order_check(spark):
    a = spark.createDataFrame([(0, "x"), (1, "y")], "pos long, id string")
    dataset.verify_order(a, a)
    with pytest.raises(RuntimeError):
        dataset.verify_order(a, a.where("pos = 0"))


def test_table_names():
    assert dataset.wanted_tables(None) == ["text", "image_labels", "images"] and dataset.wanted_tables(" images, text") == ["text", "images"]
    with pytest.raises(ValueError):
        dataset.wanted_tables("x")


def test_plugins(spark):
    assert pipeline.load_callable("json:dumps") is json.dumps
    for bad, error in (("json", ValueError), ("json:__name__", TypeError)):
        with pytest.raises(error):
            pipeline.load_callable(bad)
    text = spark.createDataFrame([(0, "a b a"), (1, None)], "pos long, data string")
    known = spark.createDataFrame([(0, "A", "i1")], "pos long, url string, image_id string")

    def rewrite(page, queues):
        return " ".join(queues[w].pop(0) or w for w in page.split())

    got = pipeline.rewrite_with(text, known, str.split, str.upper, lambda i: f"<{i}>", rewrite)
    assert {r.pos: r.data for r in got.collect()} == {0: "<i1> b <i1>", 1: ""}


def test_streams(spark, tmp_path):
    rows = [(0, "a", "<p>x</p>", "{}"), (1, "b", "<h1>y</h1>", "{}")]
    spark.createDataFrame(rows, "pos long, id string, data string, info string").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("pos long, id string, data string, info string").parquet(str(tmp_path / "in"))
    q = live.chat_stream(live.parse_stream(s).drop("_error")).writeStream.format("memory").queryName("live").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("live").count() == 2


def test_first_of_each_stream(spark, tmp_path):
    spark.sql("select 'a' as id, timestamp'2024-01-01 00:00:00' as ingested_at union all select 'a', timestamp'2024-01-01 01:00:00'").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("id string, ingested_at timestamp").parquet(str(tmp_path / "in"))
    q = live.first_of_each(s).writeStream.format("memory").queryName("firsts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("firsts").count() == 1


def test_first_of_each_stream_keeps_late_rows(spark, tmp_path):
    schema = "id string, pos long, ingested_at timestamp"
    for i, rows in enumerate([["('a', 1, timestamp'2024-03-09 00:00:00')"], ["('a', 2, timestamp'2024-03-09 01:00:00')"], ["('b', 3, timestamp'2024-03-01 00:00:00')", "('a', 4, timestamp'2024-03-01 00:00:00')"]]):
        spark.sql(f"select * from values {', '.join(rows)} as t(id, pos, ingested_at)").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = live.first_of_each(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.format("parquet")
        q = q.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        assert q.awaitTermination(60)
    assert sorted((r.id, r.pos) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", 1), ("b", 3)]
