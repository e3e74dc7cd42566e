from urllib.parse import parse_qs, urlencode, urljoin, urlparse, urlunparse

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemill.functions import html as H, urls as U


def model_set_page(url, n):
    parsed = urlparse(url)
    query = parse_qs(parsed.query)
    query["page"] = [str(n)]
    return urlunparse(parsed._replace(query=urlencode(query, doseq=True)))


BASES = ["https://example.com/page/1", "http://h.org", "https://h.org/a/b/?q=1#f", "https://h.org/a/./b/c.html?x=y"]
HREFS = [
    "/page/2", "https://other.com/page/2", "//cdn.org/x", "?page=3", "#top", "p/4", "../up", "../../../far", "./same",
    "a//b", "", "x/../y/.", "x/..", "mailto:a@b.c", "/a/../b", "q?x=1#z", " /padded ",
]
PAGES = [
    "https://h.org/list", "https://h.org/list?page=4&a=b", "https://h.org/?a=1&b=&a=2&c#frag", "https://h.org/?a=x+y&t=%7E*%2F",
    "https://h.org/?page=1&z=é&page=9", "https://h.org/x?=v&n",
]


def test_resolve_matches_the_standard_library(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    got = spark.createDataFrame(rows, "b string, h string").select("*", U.resolve_url(F.col("b"), F.col("h")).alias("u")).collect()
    assert {(r.b, r.h): r.u for r in got} == {(b, h): urljoin(b, h.strip()) for b, h in rows}


def test_set_page_matches_the_standard_library(spark):
    got = spark.createDataFrame([(u,) for u in PAGES], "u string").select("u", U.set_page(F.col("u"), 7).alias("v")).collect()
    assert {r.u: r.v for r in got} == {u: model_set_page(u, 7) for u in PAGES}


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", "page", "k+1"]), st.sampled_from(["", "1", "x y", "%41", "~*"])), max_size=5), min_size=15, max_size=15))
def test_set_page_on_generated_queries(spark, queries):
    urls = ["https://h.org/p?" + "&".join(f"{k}={v}" for k, v in q) for q in queries]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", U.set_page(F.col("u"), 2).alias("v")).collect()
    assert {r.u: r.v for r in got} == {u: model_set_page(u, 2) for u in urls}


def test_next_page(spark):
    cases = [
        ('<a rel="next" href="/page/2">Next</a>', "https://example.com/page/1", "https://example.com/page/2"),
        ('<a rel="next" href="https://other.com/page/2">Next</a>', "https://example.com/page/1", "https://other.com/page/2"),
        ('<a href="/p/3">Next page</a>', "https://example.com/p/2", "https://example.com/p/3"),
        ('<a href="/p/4">NEXT</a>', "https://example.com/p/3", "https://example.com/p/4"),
        ('<a href="/about">About</a>', "https://example.com/page/1", None),
        ("", "https://example.com/", None),
        ('<a rel="next">x</a><a class="btn pagination-next" href="/c">&gt;</a>', "https://e.com/", "https://e.com/c"),
        ('<a aria-label="Go Next" href="/d">&gt;</a>', "https://e.com/", "https://e.com/d"),
        ('<a href="/no"><i>a</i><i>next</i></a><a href="/yes"><b>next</b></a>', "https://e.com/", "https://e.com/yes"),
        ('<!-- <a rel="next" href="/no">n</a> --><a href=/q>nexT</a>', "https://e.com/", "https://e.com/q"),
    ]
    df = spark.createDataFrame([(i, h, u) for i, (h, u, _) in enumerate(cases)], "i int, h string, u string")
    got = df.select("i", U.next_page_url(H.link_array(F.col("h")), F.col("u")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [c[2] for c in cases]


def test_next_candidate(spark):
    rows = [("https://e.com/2", "https://e.com/1"), (None, "https://e.com/s"), (None, "https://e.com/s?page=2")]
    df = spark.createDataFrame(rows, "n string, u string")
    got = df.select(U.next_candidate(F.col("n"), F.col("u"), F.lit("https://e.com/s"), F.lit(1)).alias("c")).collect()
    assert [r.c for r in got] == ["https://e.com/2", "https://e.com/s?page=2", None]


def test_keys(spark):
    df = spark.createDataFrame([("http://arxiv.org/abs/2401.1v1/", "see github.com/o-1/r_2.git", "/p?x=1")], "p string, t string, h string")
    row = df.select(
        U.last_segment(F.col("p")).alias("a"), U.repo_url(F.col("t")).alias("b"), U.repo_key(F.col("p")).alias("c"),
        U.product_url("https://s.com", F.col("h")).alias("d"),
    ).first()
    assert tuple(row) == ("2401.1v1", "https://github.com/o-1/r_2", None, "https://s.com/p")
