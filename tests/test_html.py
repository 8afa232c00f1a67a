import json
import time

import pytest

from millrace.html import kernel, markdown
from millrace.html.clean import clean, content_area
from millrace.html.dom import parse, serialize
from millrace.html.meta import extract, front_matter

LONG = "Words of an article that is long enough to be taken for the content of its page."


def md(body: str, url: str = "") -> str:
    return kernel.convert(f"<html><body>{body}</body></html>", url)[0]


def test_repair():
    t = parse("<p>a<p>b<ul><li>1<li>2<ul><li>3</ul></ul><table><tr><td>x<td>y<tr><td>z</table></b>tail")
    assert serialize(t.first("body")) == "<body><p>a</p><p>b</p><ul><li>1</li><li>2<ul><li>3</li></ul></li></ul><table><tr><td>x</td><td>y</td></tr><tr><td>z</td></tr></table>tail</body>"
    assert parse("").first("body") is not None and parse("just text").text() == "just text"


def test_content_area_prefers_the_first_tier():
    t = parse(f"<main>{LONG}</main><article>short</article><div class='x post-content'>{LONG}!</div>")
    assert content_area(t).has("post-content")
    assert content_area(parse(f"<article>short</article><p>{LONG}</p>")).tag == "body"


@pytest.mark.parametrize(
    "noise",
    ["<nav>n</nav>", "<div class='ad'>n</div>", "<div class='post_ad'>n</div>", "<div id='cookie'>n</div>", "<div class='toolbar-module__x'>n</div>", "<div data-testid='PromoBox'>n</div>", "<p data-ad=1>n</p>",
     "<p role=note>n</p>", "<span style='clip:rect(0 0 0 0)'>n</span>", "<a href='https://x.com/a'>n</a>", "<a href='/print'>n</a>", "<a href='#top'>Back to top</a>", "<li><a href='#c'>n</a></li>", "<!-- n -->", "<script>n</script>"],
)
def test_noise_goes(noise):
    assert "n" not in clean(parse(f"<div>{noise} <p>X</p></div>")).text().replace("\n", "")


@pytest.mark.parametrize("kept", ["<div class='my-ad'>kept</div>", "<p>see <a href='#note'>kept</a> too</p>", "<div class='advance'>kept</div>"])
def test_content_stays(kept):
    assert "kept" in clean(parse(f"<div>{kept}</div>")).text()


def test_markdown_blocks():
    assert md("<h2>T</h2><p>a <b>b</b> <i>c</i><br>d</p><hr><blockquote><p>q</p></blockquote>") == "## T\n\na **b** *c*  \nd\n\n---\n\n> q"
    assert md("<ul><li>a<ul><li>b<ul><li>c</ul></ul><li>d</ul><ol><li>x<li>y</ol>") == "- a\n  * b\n    + c\n- d\n\n1. x\n2. y"
    assert md("<pre><code class='language-py'>x = 1\n</code></pre><p>y</p>") == "```py\nx = 1\n\n```\ny"
    assert md("<div class='highlight-c'><pre>int a;</pre></div>") == "```c\nint a;\n```\n"
    assert md("<table><tr><th>a<th>b<tr><td>1<td></table>") == "| a | b |\n| --- | --- |\n| 1 |  |"
    assert md("<p><img src='/i.png' alt='x'></p>", "https://h.example/d/p") == '---\nurl: "https://h.example/d/p"\n---\n\n![x](https://h.example/i.png)'
    assert md("<p><a href='/x'>plain</a> <a href='/i.PNG?x'>file</a></p>") == "plain [file](/i.PNG?x)"


def test_media():
    assert md("<video poster='p.jpg'><source src='v.mp4'></video>") == "[![video](p.jpg)](v.mp4)"
    assert md("<figure><audio src='a.ogg'></audio><figcaption> cap </figcaption></figure>") == "[(audio)](a.ogg)cap"
    assert md("<video></video><p>x</p>") == "x"


def test_local_media():
    page = '<p><img src="https://h/a.jpg"><img src="https://h/b.jpg" srcset="https://h/a.jpg 1x"></p><video poster="https://h/a.jpg"><source src="v.mp4"></video>'
    assert kernel.convert(page, media={"https://h/a.jpg": "a1.jpg"})[0] == "![](media/a1.jpg)![](media/a1.jpg)\n\n[![video](media/a1.jpg)](v.mp4)"


def test_image_names():
    names = {"//u/thumb/My_pic.jpg/250px-My_pic.jpg": "My pic", "a/Caf%C3%A9.png?x#y": "Café", "": "", "x/noending": "noending", "120px-a.svg": "120px-a", "a/b.tar.gz/": "b.tar"}
    assert {k: markdown.name_of_image(k) for k in names} == names


def test_boxes_in_boxes():
    inner = "<table class=infobox-subbox><tr><th>C</th><td>3</td></tr></table>"
    box = f"<table class=infobox><tbody><tr><th>A</th><td>1</td></tr><tr><td>kept<table class=infobox-subbox><tr><th>B</th><td>2{inner}</td></tr></table></td></tr><tr><th>D</th><td>4</td></tr></tbody></table>"
    rows = [x for x in wiki(box).split("\n") if x.startswith("|")]
    assert rows == ["| A | 1 |", "| --- | --- |", "| kept |  |", "| B | 2 |", "| C | 3 |", "| D | 4 |"]


def test_sections_end_where_they_should():
    flat = wiki("<h2>A</h2><p>a</p><div><h3>Notes</h3><p>n</p><h3>C</h3><p>c</p></div><p>d</p><div class=x><h2>References</h2></div><ul><li>r</li></ul>", remove_ref=True)
    assert "Notes" not in flat and "### C" in flat and "\nd" in flat and "- r" not in flat and "References" not in flat
    empty = wiki("<h2>A</h2><h3>B</h3><h2>C</h2><p>c</p><h3>D</h3>")
    assert "A" not in empty and "B" not in empty and "## C" in empty and "### D" in empty


def test_nested_tables_move_behind():
    out = md("<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr></table>")
    assert out.index("| a | b |") < out.index("| in |")


def test_table_text_rules():
    assert markdown.tidy_tables("| a | b |  |\n| --- | --- | --- |\n|  |  |  |\n| 1 | 2 |  |") == "| a | b |\n| --- | --- |\n| 1 | 2 |"
    assert markdown.tidy_tables("| --- | --- |\n| 1 | 2 |") == "|  |  |\n| --- | --- |\n| 1 | 2 |"
    assert markdown.tidy_tables("| a | b | --- | 1 | 2 |").split("\n")[:2] == ["| a | b |", "| --- | --- |"]
    assert markdown.tidy("\n\na\n \n\n\nb&amp;lt;<br/>") == "a\n\nb&lt;"


def test_wide_table_is_fast():
    began = time.time()
    md("<table>" + ("<tr>" + "<td></td>" * 3000 + "<td>x</td></tr>") * 20 + "</table>")
    assert time.time() - began < 10


def wiki(body: str, **k) -> str:
    return kernel.convert(f"<html><body><div class='mw-body-content'>{body}<p>{LONG}</p></div></body></html>", "https://en.wikipedia.org/wiki/X", **k)[0]


def test_wiki_rules():
    out = wiki("<span class='mw-editsection'>[edit]</span><table class='ambox'><tr><td>box</table><h2>Empty</h2><h2>Full</h2>")
    assert "edit" not in out and "box" not in out and "Empty" not in out and "## Full" in out
    out = wiki("<p>E <span class='mwe-math-element'><math><annotation encoding='application/x-tex'>{\\displaystyle x^2}</annotation></math></span></p>")
    assert "E $x^2$" in out
    assert "![My pic](" in wiki("<p><img src='//u/thumb/My_pic.jpg/250px-My_pic.jpg'></p>")
    box = "<table class='infobox'><tr><td class='infobox-data'><ul><li>a<li>b</ul></td><td></td></tr><tr><td></td></tr><tr><td class='infobox-data'>1<br>(x)<br>2</td></tr></table>"
    assert "| a, b |" in wiki(box) and "| 1 (x), 2 |" in wiki(box)


def test_reference_sections():
    body = f"<h2>A</h2><p>t<sup class='reference'>[1]</sup></p><h2>References</h2><ul><li>r</li></ul><h3>Sub</h3><p>s</p><h2>B</h2><p>{LONG}</p>"
    out = wiki(body, remove_ref=True)
    assert "References" not in out and "Sub" not in out and "## B" in out and "[1]" not in out and 'remove_ref: true' in out
    assert "## References" in wiki(body)


@pytest.mark.parametrize("wrap", ["<h2>{}</h2>", '<div class="mw-heading mw-heading2"><h2>{}</h2></div>', "<section><h2>{}</h2><p>gone</p></section>"])
@pytest.mark.parametrize("name", ["References", "NOTES", "参考来源", "Einzelnachweise", "Véase también", "примечания"])
def test_reference_layouts(wrap, name):
    body = wrap.format("Kept").replace("gone", "kept too") + "<p>Body.</p>" + wrap.format(name) + ("" if "section" in wrap else "<ol><li>gone</li></ol><h3>Sub</h3><p>gone</p>") + wrap.format("Legacy").replace("gone", "x") + "<p>After.</p>"
    out = wiki(body, remove_ref=True)
    assert "Body." in out and "After." in out and "## Legacy" in out and name not in out and "gone" not in out


def test_presentation_tables_and_track_lists():
    out = wiki("<table role=presentation><tbody><tr><td><p>A side</p></td><td><table class=wikitable><tr><th>N</th></tr><tr><td>1</td></tr></table></td></tr></tbody></table>")
    assert "A side" in out and "| N |" in out
    out = wiki("<ul><li><dl><dt>CD single</dt></dl></li></ul><ol><li>Track 1</li></ol>")
    assert "**CD single**" in out and "1. Track 1" in out


def test_commune_infobox():
    box = (
        "<table class='infobox'><tbody><tr><td colspan=2>Name</td></tr><tr><th>Pays</th><td>France</td></tr><tr><td colspan=2><div><table class='DebutCarte'><tr><td><img alt='Map' src='m.jpg' width=280>"
        "<img src='pin.svg' width=16></td></tr></table></div></td></tr><tr><td colspan=2></td></tr></tbody></table>"
    )
    out = wiki(box)
    rows = [x for x in out.split("\n") if x.startswith("|")]
    assert len({x.count("|") for x in rows}) == 1 and "![Map]" in out and "pin" not in out and "| Pays | France |" in rows


def test_metadata():
    page = """<head><title>T | Site</title><meta property="og:title" content="OG"><meta name="author" content="N"><script type="application/ld+json">[{"headline": "H", "name": "x", "author": {"name": "A"}}]</script></head>
    <h2 class="post-title">second</h2><time datetime="2024">x</time>"""
    assert extract(parse(page)) == {"title": "H", "author": "A", "date": "2024"}
    assert extract(parse("<title>T - Site</title><h2 class='post-title'>Second</h2>"))["title"] == "Second"
    assert extract(parse("<title>T - Site</title>"))["title"] == "T"
    assert front_matter({"title": "a: b", "tags": "x, y"}) == '---\ntitle: "a: b"\ntags:\n  - x\n  - y\n---\n\n' and front_matter({}) == ""


def test_kernel_on_rows(spark):
    rows = [(0, "a", "<p>x</p>", '{"url": "https://h.example/d/", "k": "é"}', 1), (1, "b", None, None, 2), (2, "c", "", "{}", 3), (3, "d", '<img src="images/i1">', '{"url": "https://h.example/d/"}', 4)]
    df = spark.createDataFrame(rows, "pos long, id string, data string, info string, _x int")
    got = {r.pos: r for r in kernel.parse_pages(df).collect()}
    assert got[0].data.endswith("x") and json.loads(got[0].info)["format"] == "md" and "\\u00e9" in got[0].info and got[0]._x == 1
    assert got[1].data == "" and "format" not in json.loads(got[1].info) and got[2]._error is None
    assert "![](images/i1)" in got[3].data
    assert kernel.parse_pages(df.limit(0)).count() == 0
    bad = spark.createDataFrame([(0, "a", "<p>x</p>", "{x", 1)], df.schema)
    assert kernel.parse_pages(bad, strict_info=False).first()._error.startswith("broken info")
    with pytest.raises(Exception, match="JSONDecodeError|Expecting"):
        kernel.parse_pages(bad).collect()
    with pytest.raises(ValueError):
        kernel.parse_pages(df, out_format="pdf")


def test_time_limit():
    with pytest.raises(TimeoutError):
        kernel.with_limit(1, time.sleep, 5)
    assert kernel.with_limit(5, lambda: 3) == 3


def test_captions(spark):
    df = spark.createDataFrame([(1, "<figure><img src=a alt=b><figcaption> c  d</figcaption></figure><figure><img src=e><figcaption> </figcaption></figure>"), (2, None)], "pos long, data string")
    assert [tuple(r) for r in kernel.image_captions(df).collect()] == [(1, "a", "b", "c d")]


def test_simple_html():
    out = kernel.convert(f"<div class=content><p class=x>{LONG}</p><p> </p><font><em>e</em></font><img src=a onclick=b></div>", "", "html")[0]
    assert out == f'<p>{LONG}</p><em>e</em><img src="a">'
