import itertools
import random

from pyspark.sql import functions as F

from millrace.llm import boilerplate as B

WORDS = "river bridge census settlement opened stones museum granite winter harbour declined council"
SENTENCE = "The bridge opened in 1849 and the stones of the old harbour were reused for a museum near the river."


def page(n, furniture=True):
    nav = "<header>\n<nav>\n<ul>\n<li><a href=/0>Home</a></li>\n<li><a href=/1>Log in</a></li>\n</ul>\n</nav>\n</header>\n"
    foot = "<footer>\n<p>Privacy policy | Terms</p>\n<p>All rights reserved</p>\n</footer>"
    body = "\n".join(f"<p>{SENTENCE} {n} {k}</p>" for k in range(3))
    return f"<html><head><title>T</title></head>\n<body>\n{nav}<aside>\n<h3>Most read</h3>\n<div>Name{n}</div>\n</aside>\n<main><article>\n<h1>Title {n}</h1>\n<h2>History</h2>\n{body}\n<aside class=promo><p>Advertisement</p></aside>\n</article></main>\n{foot}\n</body></html>"


def fit(pages):
    counts = {}
    for data in pages:
        for toks, furniture in B.weak_labels(data, "site.example"):
            for t in toks | {""}:
                counts.setdefault(t, [0, 0])[furniture] += 1
    return B.Classifier.of_counts(counts)


MODEL = fit(page(n) for n in range(60))


def furniture(data, is_html=True, title=None, site="site.example"):
    lines, side = B.label(data, is_html, title, site, MODEL)
    return [ln.text.strip() for ln, s in zip(lines, side) if s]


def test_min_cut_is_least():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 9)
        u = [rng.choice([-1, 1]) * rng.randint(0, 6) for _ in range(n)]
        e = {(a, b): rng.randint(1, 5) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5}
        cost = lambda s: sum(max(u[i], 0) if not s[i] else max(-u[i], 0) for i in range(n)) + sum(w for (a, b), w in e.items() if s[a] != s[b])  # noqa: B023, E731
        assert cost(B.min_cut(u, e)) == min(map(cost, itertools.product([False, True], repeat=n)))
    assert B.min_cut([], {}) == [] and B.min_cut([0.0], {}) in ([False], [True])


def test_lines_of_a_page():
    lines, parents, h1 = B.html_lines("<head><title>no</title></head><body><script>\nno\n</script>\n<div>\na<!-- no\n--> b\n<p style='display: none'>no</p>\n&nbsp;\n<h1>t</h1></div></body>")
    assert [(ln.no, ln.text.strip()) for ln in lines] == [(4, "a"), (5, "b"), (8, "t")] and h1 == lines[0].box


def test_semantic_page():
    assert furniture(page(99)) == ["Home", "Log in", "Most read", "Name99", "Advertisement", "Privacy policy | Terms", "All rights reserved"]


def test_page_without_semantics():
    plain = page(98).replace("<nav>", "<div>").replace("</nav>", "</div>")
    for t in ("header", "aside", "footer", "main", "article"):
        plain = plain.replace(f"<{t}>", "<div>").replace(f"</{t}>", "</div>").replace(f"<{t} class=promo>", "<div>")
    assert furniture(plain) == furniture(page(98))
    misleading = page(97).replace("<article>", '<article class="sidebar banner">').replace("<main>", "<div>").replace("</main>", "</div>").replace("<article class", "<div class").replace("</article>", "</div>")
    assert furniture(misleading) == furniture(page(97))


def test_no_voice_is_louder_than_another():
    far = [B.html_lines(page(n))[0] for n in range(3)]
    for lines in far:
        for ln in lines:
            assert abs(MODEL.score(B.tokens(ln.text, "site.example"))) <= B.LIMIT
            assert abs(MODEL.around({t for _, *own in ln.around for t in own})) <= B.SURROUNDINGS <= B.LIMIT


def test_classifier_and_edges_decide(monkeypatch):
    text = f"Home\nLog in\n\nTitle\nHistory\n{SENTENCE}\n- One\n- Two\nMost read\nNeverseen\nUnknownname\n\nPrivacy policy | Terms"
    nothing = B.Classifier({})
    lines, side = B.label(page(95), True, None, "site.example", nothing)
    assert not any(side) and not any(B.label(text, False, None, "site.example", nothing)[1])
    assert {"Neverseen", "Unknownname"} <= set(furniture(text, False, "Title"))
    for name in ("NEAR", "APART", "BESIDE", "CROSS", "HUB", "UP"):
        monkeypatch.setattr(B, name, 0.0)
    assert not {"Neverseen", "Unknownname"} & set(furniture(text, False, "Title"))


def test_a_container_pulls_what_says_little():
    ln = [B.Line(i, 1) for i in range(4)]
    assert len({x.box for x in ln}) == 1
    # three lines of a container that are furniture, one that leans to the article by less than its edges
    u = [3.0, 3.0, -0.7, 3.0, 0.0]
    e = {(0, 1): B.BESIDE, (1, 2): B.BESIDE, (2, 3): B.BESIDE} | {(i, 4): B.HUB for i in range(4)}
    assert B.min_cut(u, e)[:4] == [True] * 4 and B.min_cut(u, {})[:4] == [True, True, False, True]


def test_names_are_learned():
    named = [page(n).replace("<aside class=promo>", '<div class="box-x promo">').replace("</aside>\n</article>", "</div>\n</article>") for n in range(60)]
    acting = [d.replace("<h2>History</h2>", '<h2>History</h2>\n<span class="edit-x">[<a href="/edit/1">change</a>]</span>') for d in named]
    w = fit(acting).weights
    assert w[".edit-x"] > 2 and ".box-x" in w and ".never" not in w and fit([page(1)]).weights.keys() <= fit([page(1), page(2)]).weights.keys()


def test_captured_text():
    text = f"Home\nLog in\n\nTitle\nHistory\n{SENTENCE}\n- One\n- Two\nMost read\nNeverseen\nUnknownname\n\nPrivacy policy | Terms"
    assert furniture(text, False, "Title") == ["Home", "Log in", "Most read", "Neverseen", "Unknownname", "Privacy policy | Terms"]
    assert furniture("", False) == [] and furniture("\n \u200b\n", False) == [] and furniture("", True) == []


def test_rows(spark):
    rows = [(i, "site.example", "T", True, page(i), "x") for i in range(40)]
    rows += [(100, None, None, True, page(7), None), (101, "s", "t", False, None, ""), (102, "s", "t", False, "", ""), (103, "s", None, True, "<p>" + SENTENCE * 3000 + "</p>", ""), (104, None, None, False, SENTENCE, "")]
    df = spark.createDataFrame(rows, "pos long, site string, title string, is_html boolean, data string, line_no string")
    cols = [F.col(c) for c in ("pos", "site", "title", "is_html", "data")]
    got = {}
    for r in B.furniture(df, *cols, df.count()).collect():
        got.setdefault(r.pos, []).append(r.line_no)
    assert sorted(got[100]) == sorted(got[7]) and len(got[7]) == 7 and not {101, 102, 103, 104} & set(got)
    texts = {r.pos: r.text for r in B.main_text(df.where("pos = 3"), *cols, 1).collect()}
    assert texts[3].startswith("Title 3\nHistory\n") and "Home" not in texts[3]
    assert B.furniture(df.limit(0), *cols, 0).count() == 0


def test_held_out_accuracy():
    """Labels of semantic markup told from text and shape alone, on pages not trained on."""
    right = total = 0
    for n in range(200, 220):
        for toks, label in B.weak_labels(page(n), "site.example"):
            score = MODEL.score(toks)
            if score:
                right += (score > 0) == label
                total += 1
    assert right >= 0.95 * total


def test_deep_and_broken_pages():
    deep = "<div>" * 5000 + "\n<h1>T</h1>\n" + SENTENCE + "\n" + "</div>" * 5000
    assert furniture(deep) == []
    for odd in ("<", "<div", "<!-- ", "<script>x", "</p></div>" * 50, "<a href='x" * 200, "&#xZZ; &bogus;", "<p>" * 3000 + "x"):
        furniture(odd)
