import random

from pyspark.sql import functions as F

from millrace.llm import spam as S

PROSE = [
    "The bridge was built in {} by a man who had worked on the harbour before.", "According to the census of {} the settlement had a mill and a school.",
    "It is not known when the first of the towers was opened, but a note of {} names it.", "In {} the river rose, and most of the older houses near the weir were lost.",
    "Visitors reach the museum by ferry from the town, which runs {} times a day in summer.", "Its walls are of granite and the roof, which dates from {}, is of slate.",
]


def prose(rng):
    return "# Title\n\n" + "\n\n".join(" ".join(rng.choice(PROSE).format(rng.randint(1500, 2000)) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 5)))


SPAM = {
    1000: "desk fan cheap desk fan best tea kettle desk fan buy desk fan online tea kettle desk fan sale desk fan tea kettle desk fan near me desk fan",
    1001: " | ".join(f"[Name{i}](https://x.example/{i})" for i in range(30)),
    1002: "Tags: " + ", ".join(f"{a} {b}" for a in ("cheap", "best", "buy") for b in ("kettle", "fan", "rug", "shoes")),
    1003: "\n".join(f"http://shop{i}.example/p/{i}" for i in range(20)),
    1004: "#deskfan #deskfancheap #buydeskfan #deskfan2025 #bestdeskfan #deskfansale #deskfannearme #deskfan #fan",
}
FINE = {
    2000: prose(random.Random(1)).replace("museum", "[museum](https://m.example/1)").replace("bridge", "[bridge](https://b.example/2)"),
    2001: prose(random.Random(2)) + "\n\n## References\n\n" + "\n".join(f"{i}. {n}: [{w}](https://r.example/{i})" for i, (n, w) in enumerate({"A. Marlin": "Stone walls", "B. Oakes": "Old mills", "C. Perrin": "On rivers", "D. Quill": "A survey"}.items())),
    2002: "\n".join("* " + p.format(1900 + i) for i, p in enumerate(PROSE)),
    2003: "", 2004: "# Only a title", 2005: None, 2006: "   \n",
}


def test_spam_and_prose(spark):
    rng = random.Random(7)
    rows = [(i, "en", prose(rng), "x") for i in range(300)] + [(i, None, t, "") for i, t in (SPAM | FINE).items()]
    rows += [(5000 + i, "en", prose(rng) * 60, "") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, spam string")
    v = S.vectors(df, F.col("doc_id"), F.col("lang"), F.col("text"))
    got = {r.doc_id for r in S.spam_scores(v).where("spam").collect()}
    assert got == set(SPAM)


def test_shares_know_how_little_they_have_seen():
    assert S.estimate(0.0, 1)[1] > S.estimate(0.0, 10)[1] > S.estimate(0.0, 1000)[1] > 0
    assert S.estimate(1.3, 50)[0] == S.estimate(1.0, 50)[0] < 1 and abs(S.estimate(0.3, 10**6)[0] - 0.3) < 1e-5
    links = " | ".join(f"[Name{i}](https://x.example/{i})" for i in range(300))
    assert S.features(links, "en")[1][0] > 0.8 and S.features(links[:60], "en")[2][0] > 10 * S.features(links, "en")[2][0]


def test_a_language_of_few_documents(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(1, "de", "Der Turm ist von der Stadt aus gut zu sehen und wurde im Jahr erneuert."), (2, "en", prose(rng)), (3, "en", prose(rng)), (4, "en", prose(rng))], "doc_id long, lang string, text string")
    got = S.spam_scores(S.vectors(df, F.col("doc_id"), F.col("lang"), F.col("text"))).collect()
    assert len(got) == 4 and not any(r.spam for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert S.spam_scores(S.vectors(df, F.col("doc_id"), F.col("lang"), F.col("text"))).count() == 0


def test_language():
    assert S.features("Der Turm ist von der Stadt aus gut zu sehen und wurde im Jahr erneuert.", "en")[0] == "de"
    assert S.features("Мост построен в этом году.", None)[0] == "ru" and S.features("该桥于此地由人主持修建，后来重修。", "en")[0] == "zh"
    assert S.features("kettle rug fan", "es")[0] == "es" and S.features("", "en") is None


def test_length_does_not_matter():
    rng = random.Random(3)
    short, long = (S.features(" ".join(rng.choice(PROSE).format(rng.randint(1500, 2000)) for _ in range(n)), "en")[1] for n in (12, 1200))
    assert all(abs(a - b) < 0.35 for a, b in zip(short, long))


def test_distance_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, S.D)) * 0.1
    x[:10] += S.SPAM_SIGN * 3
    schema = "doc_id long, lang string, " + ", ".join(f"{c}{k} double" for c in "xv" for k in range(S.D))
    df = spark.createDataFrame([(i, "en", *map(float, r), *[0.002] * S.D) for i, r in enumerate(x)], schema)
    mu, p = S.robust_model(df)["en"]
    centre, second = np.median(x, 0), np.eye(S.D) / ((1.4826 * np.median(np.abs(x - np.median(x, 0)), 0)) ** 2 + 0.002)
    for _ in range(S.STEPS):  # the same steps on all rows at once
        core = x[np.einsum("ij,jk,ik->i", x - centre, second, x - centre) <= S.CORE]
        centre, second = core.mean(0), np.linalg.inv(S.TRIMMED * np.cov(core.T, bias=True) + 0.002 * np.eye(S.D))
    assert np.allclose(mu, centre, atol=0.01) and np.allclose(p, second, rtol=0.1, atol=2)
    got = {r.doc_id: r.d2 for r in S.spam_scores(df).collect()}
    want = np.einsum("ij,jk,ik->i", x - mu, p, x - mu)
    assert all(abs(got[i] - want[i]) < 1e-6 * (1 + want[i]) for i in range(400))
    assert {r.doc_id for r in S.spam_scores(df).where("spam").collect()} == set(range(10))
