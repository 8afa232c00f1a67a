import unicodedata
from collections import Counter

from hypothesis import given
from hypothesis import strategies as st

from millrace.llm import lookalikes as L

RU = Counter({k: 50 for w in ("построен", "река", "на", "место", "сосна") for k in (f" {w} "[i : i + 2] for i in range(len(w) + 1))})
EN = Counter({k: 50 for w in ("the", "bridge", "coop", "space") for k in (f" {w} "[i : i + 2] for i in range(len(w) + 1))})
READER = L.Reader(dict(RU + EN))


def same(a, b):
    return READER.form(a) == READER.form(b)


def test_same_look():
    assert same("The cape", "Тhе саре") and same("Ｔｈｅ１", "The1") and same("a b", "a\u00a0b") and same("a b", "a\u3000b") and same("a​b", "ab")
    assert same("é", "e\u0301") and same("о\u0301rgano", "órgano") and same("ﬁne", "fine") and same("a‑b", "a-b") and same("⼈", "人") and same("\u202aab\u202c", "ab") and same("ё", "е\u0308")


def test_other_look():
    for a, b in (("e", "é"), ("5", "⁵"), ("18", "19"), ("a", "A"), ("O", "0"), ("l", "I"), ("ab", "a b"), ("①", "1"), ("½", "1/2")):
        assert not same(a, b)


def test_readable_forms():
    assert READER.form("пocтроен нa рекe") == "построен на реке"
    assert READER.form("Тhе bridgе") == "The bridge"
    assert READER.form("") == "" and READER.form(" \u200b") == " "


@given(st.text(max_size=40))
def test_form_is_a_fixed_point(t):
    f = READER.form(t)
    assert READER.form(f) == f and unicodedata.is_normalized("NFC", f)


def test_all_scripts():
    assert same("ɑpple", "apple") and same("օne", "one") and same("Ꭺpple", "Apple") and same("հցսո", "hgun") and same("ꜱay", "say")
    assert not same("ա", "w") and not same("Ꮳ", "C")


def test_neighbours_decide_ambiguous_letters():
    words = Counter({k: 50 for w in ("hello", "Iowa", "In") for k in (f" {w} "[i : i + 2] for i in range(len(w) + 1))})
    reader = L.Reader(dict(words))
    assert reader.form("heӀӏo") == "hello" and reader.form("Ӏowa") == "Iowa" and reader.form("Ӏn ӀӀ") != "ln ll"
    assert L.Reader({}).form("heӀӏo") != "hello"  # without counts the search doesn't know


def test_mixed_scripts_need_the_search():
    # every letter of these could be Latin or Cyrillic: the text's other words and the counts decide, once for all spellings
    assert READER.form("сосна на месте") == READER.form("cocнa нa мecтe") == "сосна на месте"
    assert READER.form("the coop река") == "the coop река"


@given(st.text(alphabet="aeocpxyABEKMHOPCTX bdgil1.é", max_size=30), st.data())
def test_any_spelling_has_one_form(t, data):
    options = {v: [v] for v in set(t)}
    for table in (L.CYRILLIC, L.GREEK, L.ARMENIAN, L.CHEROKEE, L.LATIN):
        for k, v in table.items():
            options.setdefault(v, [v]).append(k)
    other = "".join(data.draw(st.sampled_from(options[c])) + data.draw(st.sampled_from(["", "\u200d", "\u2060"])) for c in t)
    assert same(t, other)


def test_one_long_token():
    assert READER.form("рекa" * 30_000) == "река" * 30_000


def pairs(spark, rows):
    df = spark.createDataFrame(rows, "pos long, data string, look string")
    return sorted((r.pos_a, r.pos_b) for r in L.same_look_pairs(L.looks(df, "pos", "data")).collect())


def test_pairs(spark):
    rows = [(5, "cape", ""), (1, "саре", ""), (3, "cape", ""), (2, "ｃape", ""), (7, None, ""), (8, "", ""), (9, " ", ""), (10, "\u00a0", ""), (11, "cap", None)]
    assert pairs(spark, rows) == [(1, 2), (1, 3), (1, 5), (2, 3), (2, 5)]
    assert pairs(spark, []) == [] and pairs(spark, [(1, None, None)]) == []


def test_classes(spark):
    rows = [(5, "cape", ""), (1, "саре", ""), (3, "cape", ""), (7, None, ""), (9, " ", ""), (11, "cap", None)]
    df = spark.createDataFrame(rows, "pos long, data string, class_pos string")
    got = sorted(tuple(r) for r in L.look_classes(L.looks(df, "pos", "data")).collect())
    assert got == [(1, 1, 3, 2), (3, 1, 3, 1), (5, 1, 3, 1), (11, 11, 1, 0)]
    assert L.look_classes(L.looks(df.limit(0), "pos", "data")).count() == 0


def test_long_and_repeated(spark):
    long = "река " * 40_000
    assert pairs(spark, [(1, long, ""), (2, long.replace("р", "p"), ""), (3, long, "")]) == [(1, 2), (2, 3)]
    copies = [(i, "copy", "") for i in range(3000)] + [(5000, "сору", "")]
    assert len(pairs(spark, copies)) == 3000


def test_forms_of_rows(spark):
    df = spark.createDataFrame([(1, "Тhе"), (2, None), (3, "")], "pos long, data string")
    assert {r.pos: r.form for r in L.consistent_form(df, "pos", "data").collect()} == {1: "The", 2: None, 3: ""}
