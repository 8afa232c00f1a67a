import json
import random
import time

from pyspark.sql import functions as F

from millrace.llm import markup as M


def kinds(text, *others):
    w = []
    for t in (text, *others):
        w = M.infer(w, t)
    return sorted(set(M.cases(w, text)))


def test_markdown():
    text = "# H\ntext *em* and `code`\n\n* item\n* item [l](u)\n\n```py\n# no heading\n```\n\nSet\n-----\n$$\nx\n$$\nin $x$ line"
    assert kinds(text) == [(0, "heading"), (1, "inline"), (3, "list_item"), (4, "inline"), (4, "list_item"), (6, "code_block"), (10, "heading"), (12, "formula"), (15, "formula")]


def test_wiki():
    text = "== H ==\n# one 1901\n# two 1902\n** deep ''x''\n:<math>x</math>\n<syntaxhighlight lang=\"c\">\n* x\n</syntaxhighlight>\n{{cite|a}} [[a|b]]"
    assert kinds(text) == [(0, "heading"), (1, "list_item"), (2, "list_item"), (3, "inline"), (3, "list_item"), (4, "formula"), (5, "code_block"), (8, "inline")]


def test_html_and_tex():
    text = "<H2 class=x>H</H2>\n<p>a <b>b</b></p>\n<ul>\n<li>x\n<li>y</li>\n</ul>\n<pre><code>if a:\n# x\n</code></pre>\n\\section*{S}\n\\begin{itemize}\n\\item z\\footnote{f}\n\\end{itemize}\n\\begin{align*}\nx\n\\end{align*}\nsee~\\cite{r} and \\(y\\)"
    assert kinds(text) == [(0, "heading"), (1, "inline"), (3, "list_item"), (4, "list_item"), (6, "code_block"), (9, "heading"), (11, "inline"), (11, "list_item"), (13, "formula"), (16, "formula"), (16, "inline")]


def test_no_markup():
    plain = "He wrote [sic] there. 4 * 6 * 2 paces. Tickets cost $4 for adults and $2 for children. survey_of_1871_b\n20% & more, height < width and width > 3, 5 ~ 6, {3, 5}, C# for $12, the older for $9.\n\n#1 seed"
    assert kinds(plain) == [] and kinds("") == [] and kinds(" \n\t") == []
    assert kinds("cost $2 for it. ($x + \\frac{1}{2}$)") == [(0, "formula")]


def test_unclosed_blocks():
    assert kinds("```\n# x\n* y") == [(0, "code_block")]
    assert kinds("$$\nno end") == [] and kinds("<!-- open") == [(0, "inline")]


def test_wrapper_reads_what_it_was_made_from():
    texts = ["# H\np\n* a\n* b\n", "p **x**\n\n```\nc\n```\n", "== W ==\n# a 1\n# b 2\np\n", "\\item x\n\\item y\\textbf{z}\n"]
    w = []
    for t in texts:
        w = M.infer(w, t)
    parts = []
    for t in texts:
        parts = M.align(parts, M.infer([], t))
    for t in texts:
        assert all(M._reads(w, M._nodes(s)) and M._reads(parts, M._nodes(s)) for s in M.segments(M.lex(t)))
    assert len({s for s, _ in w}) == len(w)


def test_clean_text():
    text = "== H ==\na '''b''' [[c|d]]{{x}} &amp; e<ref>r</ref>\n* i [l](u)\n* j\n<pre><code>x &lt; 1\n</code></pre>\n:<math>y</math>\nin $z$"
    assert M.clean(M.infer([], text), text) == "## H\n\na b d & e\n\n- i l\n- j\n\n```\nx < 1\n```\n\n$$\ny\n$$\n\nin $z$"


def test_rows(spark):
    rows = [(1, "h", "# H\nx *y*", "k"), (2, None, "* a", None), (3, "h", None, ""), (4, "h", "", ""), (5, "h", "# H\nx *y*", ""), (6, "h", "x " * 100_000 + "**z**", "")]
    df = spark.createDataFrame(rows, "pos long, host string, data string, kind string")
    cols = F.col("pos"), F.col("host"), F.col("data")
    got = sorted((r.pos, r.line_no, r.kind) for r in M.markup_cases(df, *cols).collect())
    assert got == [(1, 0, "heading"), (1, 1, "inline"), (2, 0, "list_item"), (5, 0, "heading"), (5, 1, "inline"), (6, 0, "inline")]
    assert {r.pos: r.text for r in M.clean_text(df.where("pos < 3"), *cols).collect()} == {1: "# H\n\nx y", 2: "- a"}
    assert M.markup_cases(df.limit(0), *cols).count() == 0


WIKI = ["== A ==\n# x 1\n# y 2\np"] * 8
MARKDOWN = ["# A\np\n\n## B\np"] * 8


def test_another_wrapper_gives_another_reading():
    texts = ["p\n\n# only ''one''\n\np", "# a\n## b\n\np", "# a\n# b\n\np"]
    wiki, md = [], []
    for w in [*WIKI, *texts[:2]]:
        wiki = M.infer(wiki, w)
    for w in [*MARKDOWN, *texts]:
        md = M.infer(md, w)
    assert list(M.cases(wiki, texts[0])) == [(2, "list_item"), (2, "inline")] and list(M.cases(md, texts[0])) == [(2, "heading")]
    assert M.clean(wiki, texts[0]) == "p\n\n- only one\n\np" and M.clean(md, texts[0]) == "p\n\n# only one\n\np"
    assert list(M.cases(wiki, texts[1])) == [(0, "list_item"), (1, "list_item")] and list(M.cases(md, texts[1])) == [(0, "heading"), (1, "heading")]
    assert list(M.cases(wiki, texts[2])) == [(0, "list_item"), (1, "list_item")] and list(M.cases(md, texts[2])) == [(0, "heading"), (1, "heading")]
    assert list(M.cases([], texts[0])) == []


def test_the_wrapper_decides():
    bodies = ["# Head\ntext *a* and `b`\n- one\n- two\n```\nx\n```", "$$\nx\n$$\ntext [a](b)", "# Head\n- one **b**\ntext"]
    full = []
    for b in bodies:
        full = M.infer(full, b)
    for b in bodies:
        assert list(M.cases(full, b)) and not list(M.cases([], b)) and M.clean([], b) != M.clean(full, b)
    wiki = M.infer([], "== Head ==\n* [[a]]\ntext")
    assert list(M.cases(wiki, bodies[0])) == []  # a host of wiki markup knows no fences, dashes or Markdown headings


def test_held_out_bodies_of_a_host():
    rng = random.Random(4)
    pieces = ["# Head {}", "text *a{}* here", "- one {}", "- `two` {}", "```\ncode {}\n```", "$$\nx_{}\n$$", "text [l{}](h)", "1. first {}", "plain {}", "> &amp; {}"]
    body = lambda: "\n\n".join(rng.choice(pieces).format(rng.randint(1, 99)) for _ in range(rng.randint(3, 12)))
    seen, held = [body() for _ in range(40)], [body() for _ in range(200)]
    half = whole = []
    for b in seen:
        half = M.infer(half, b)
    for b in seen + held:
        whole = M.infer(whole, b)
    want = [x for b in held for x in M.cases(whole, b)]
    got = [x for b in held for x in M.cases(half, b)]
    assert len(got) >= 0.99 * len(want) > 500


def test_evidence_is_summed_over_partitions(spark):
    text = "p\n\n# only\n\np"
    rows = [(i, h, d) for h, bodies in (("w", WIKI), ("m", MARKDOWN)) for i, d in enumerate([*bodies, text])]
    df = spark.createDataFrame(rows, "pos long, host string, data string").repartition(9, "pos")
    turns = {r.host: {sym: slot["turns"] for sym, slot in json.loads(r.wrapper)} for r in M.wrappers(df).collect()}
    assert turns == {"w": {"equals": 8, "hash+": 8, "hash": 1, "text": 10}, "m": {"hash": 17, "text": 18}}
    got = M.markup_cases(df, F.col("pos"), F.col("host"), F.col("data")).where("pos = 8").collect()
    assert sorted(r.kind for r in got) == ["heading", "list_item"]


def test_hostile_lines_end_soon():
    began = time.time()
    for piece in ("<ref>", "{{", "[[", "**", "''", "`", "$", "<!--", "[", "![", "\\\\textbf{", "~~", "<b ", "&"):
        list(M.cases(M.infer([], piece * 20_000), piece * 20_000))
    assert time.time() - began < 60
