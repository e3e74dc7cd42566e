import pytest
from pyspark.sql import functions as F

from tidemill.functions import html as H, text as X, tokens as K
from tidemill.operators.enrich import attach_external_ids, attach_full_text, attach_repo_stats
from tidemill.operators.filters import topic_filter, without_junk
from tidemill.operators.reports import list_latest, preview, run_summary


def apply(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


def test_clean_html(spark):
    cases = {
        "<p>a &lt; b &amp;lt; &#233;&#x1F600; &eacute; &foo; &copy 2</p>": "a < b &lt; é😀 é &foo; © 2",
        "x<!-- <p>no</p> -->y<script>var a='</p>'</script><STYLE a=1>s</STYLE ><nav>n</nav> q&nbsp;": "x y q",
        "<head><title>T</title></head><header>h</header><body>one<br>two  three</body>": "T one two  three",
        '<a title="x > y">in</a> 1 < 2': "in 1 < 2",
        "<navy>kept</navy>": "kept",
        "": "",
    }
    assert apply(spark, H.clean_html, list(cases)) == list(cases.values())


def test_main_text(spark):
    long = "This block is long enough to stay."
    page = f"<nav>menu</nav><p>outside the article, long enough</p><article><h1>Short</h1><p>{long}</p><p><a href='x'>just a long link to elsewhere</a></p><p>{long[:-1]} <b>too</b></p></article>"
    got = apply(spark, H.main_text, [page, f"<div>{long}</div><script>{long}</script>", "<p>x</p>"])
    assert got == [f"{long}\n{long[:-1]} too", long, None]


def test_windows(spark):
    texts = ["", "one", "a b c", "a b c d", "a b c d e f", "a-b  c\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = K.chunk(df, "t", 3).orderBy("i", "chunk_no").collect()
    assert [(r.i, r.n_tokens) for r in rows] == [(1, 1), (2, 3), (3, 3), (3, 1), (4, 3), (4, 3), (5, 3), (5, 2)]
    for i, t in enumerate(texts):
        assert "".join(r.chunk_text for r in rows if r.i == i) == t


TITLES = {
    "Engineer at Acme Labs, Berlin": ("Acme Labs", "Acme Labs"),
    "X at Y (Zed)": ("Y", "Zed"),
    "Foo Co is hiring devs": (None, "Foo Co"),
    "Dev (Bar Inc)": (None, "Bar Inc"),
    "Look at   ": (None, None),
    "Chat room": (None, None),
    "Writer at " + "a" * 60: ("a" * 60, None),
    "éat foo": (None, None),
}


def test_companies(spark):
    at = apply(spark, X.company_at, list(TITLES))
    from_title = apply(spark, X.company_from_title, list(TITLES))
    expected_at = [v[0] for v in TITLES.values()]
    expected_at[4] = ""  # "at" followed by blanks only still matches
    assert at == expected_at
    assert from_title == [v[1] for v in TITLES.values()]


@pytest.mark.parametrize(
    "title, description, role",
    [
        ("International sales", "", "Internship"), ("Rapid prototyping", "", "Backend"), ("ML Engineer", "", "Data/ML"),
        ("Vue dev", "", "Frontend"), ("Full stack", None, "Fullstack"), ("Cloud", "", "DevOps/Infra"), ("Software", "", "Engineering"),
        ("UX lead", "", "Design"), ("Growth", "", "Business"), ("Cook", "makes soup", "Other"),
    ],
)
def test_roles(spark, title, description, role):
    df = spark.createDataFrame([(title, description)], "t string, d string")
    assert df.select(X.role_family(F.col("t"), F.col("d"))).first()[0] == role


def test_remote_and_heuristics(spark):
    assert apply(spark, lambda t: X.is_remote(t, F.lit(None).cast("string")), ["Remote job", "remotely", "é-REMOTE!"]) == [True, False, True]
    cards = ["Home page of things | A proper product name | ₹1,299 | $5", "short | Rs 500", "Sponsored content here | tiny"]
    assert apply(spark, X.heuristic_name, cards) == ["A proper product name", None, None]
    assert apply(spark, X.heuristic_price, cards) == ["₹1,299", "Rs 500", None]
    assert apply(spark, X.dollar_price, ["19", "", None]) == ["$19", "", None]
    lines = spark.createDataFrame([("Sign In now",), ("good",)], "l string")
    assert [r.l for r in without_junk(lines, "l").collect()] == ["good"]


def test_enrichment_with_missing_and_repeated_keys(spark):
    news = spark.createDataFrame([(1, "u1"), (2, ""), (3, None), (4, "gone"), (5, "u1")], "i int, url string")
    pages = spark.createDataFrame([("u1", "<p>A paragraph that is long enough.</p>")] * 2, "url string, html string")
    got = {r.i: r.full_text for r in attach_full_text(news, pages).collect()}
    assert got == {1: "A paragraph that is long enough.", 2: None, 3: None, 4: None, 5: "A paragraph that is long enough."}
    papers = spark.createDataFrame([("p/1", "https://github.com/o/r"), ("p/2", None)], "paper_url string, github_url string")
    repos = spark.createDataFrame([("o/r", 5)], "repo string, stars int")
    assert {r.paper_url: r.github_stars for r in attach_repo_stats(papers, repos).collect()} == {"p/1": 5, "p/2": None}
    ids = spark.createDataFrame([("1", "x"), ("2", "y")], "paper_id string, external_ids string")
    assert {r.paper_url: r.external_ids for r in attach_external_ids(papers, ids).collect()} == {"p/1": None, "p/2": "y"}


def test_topic(spark):
    df = spark.createDataFrame([("Deep AI", "x", ["A"]), ("t", "about deep ai!", ["B"]), ("t", None, ["deep", "ai"])], "title string, abstract string, authors array<string>")
    assert topic_filter(df, "Deep AI").count() == 2


def test_reports(spark):
    df = spark.createDataFrame([(1, "http://x", "a" * 70, None), (2, "ftp", "b", 5)], "_id int, url string, body string, n int")
    assert [tuple(r) for r in preview(df, 2).orderBy("url").collect()] == [("LINK", "a" * 60 + "..."), ("ftp", "b")]
    assert [r._id for r in list_latest(df, "_id", 1).collect()] == [2]
    counts = run_summary(df.select(F.struct(F.lit("s").alias("name")).alias("source")))
    assert sorted((r.is_total, r.n_rows) for r in counts.collect()) == [(0, 2), (1, 2)]


def test_skewed_keys_give_whole_results(spark):
    """One address on a third of all rows: nothing is lost or repeated."""
    news = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("url"))
    pages = spark.createDataFrame([("hot", "<p>The hot page has a long enough text.</p>")], "url string, html string")
    got = attach_full_text(news, pages)
    assert got.count() == 30000 and got.filter("full_text is not null").count() == 10000
