import random

from pyspark.sql import functions as F

from tidemill.operators.dedupe import first_by_priority, keep_first
from tidemill.operators.limits import category_cap, newest, page_quota, quota_progress


def crawl(pages, max_records, max_pages=20):
    """The page-by-page loop: pages is a list of lists of validity flags, None for a missing page."""
    taken, accepted, page = [], 0, 1
    while accepted < max_records and page <= max_pages:
        if page > len(pages) or not pages[page - 1]:
            break
        offered = pages[page - 1][: max_records - accepted]
        taken += [(page, i) for i in range(len(offered))]
        accepted += sum(offered)
        page += 1
    return taken


def test_quota_equals_the_loop(spark):
    rng = random.Random(2)
    starts = {}
    for s in range(60):
        starts[f"s{s}"] = [
            [rng.random() < 0.5 for _ in range(rng.choice([0, 1, 3, 8]) if p else 4)] for p in range(rng.choice([1, 3, 8, 25]))
        ]
    rows = [(s, p + 1, i * 3, flag) for s, pages in starts.items() for p, cards in enumerate(pages) for i, flag in enumerate(cards)]
    cards = spark.createDataFrame(rows, "start_url string, page_num int, pos int, ok boolean")
    for quota in (1, 5, 17, 1000):
        got = sorted((r.start_url, r.page_num, r.pos) for r in page_quota(cards, "ok", quota).collect())
        assert got == sorted((s, p, i * 3) for s, pages in starts.items() for p, i in crawl(pages, quota))


def test_quota_without_limits(spark, monkeypatch):
    """No last page, no quota, many pages in several blocks, long runs of pages without a valid card."""
    monkeypatch.setattr("tidemill.operators.limits.PAGE_BLOCK", 7)
    rng = random.Random(8)
    starts = {f"s{s}": [[rng.random() < share for _ in range(rng.randint(1, 6))] for _ in range(rng.choice([0, 1, 40, 60]))] for s, share in enumerate([0.0, 0.05, 0.1, 0.5, 0.9, 1.0] * 4)}
    rows = [(s, p + 1, i, flag) for s, pages in starts.items() for p, cards in enumerate(pages) for i, flag in enumerate(cards)]
    rows += [("gap", 1, 0, True), ("gap", 3, 0, True), ("late", 2, 0, True), ("nulls", 1, 0, None), ("nulls", 2, 0, True)]
    cards = spark.createDataFrame(rows, "start_url string, page_num int, pos int, ok boolean").withColumn("quota", F.lit("x")).withColumn("before", F.lit(1))
    starts |= {"gap": [[True]], "late": [], "nulls": [[False], [True]]}
    for quota, last in ((1, None), (3, None), (10, 30), (60, None), (None, None), (None, 2)):
        limit, pages_limit = quota or 10**9, last or 10**9
        want = {s: crawl(pages, limit, pages_limit) for s, pages in starts.items()}
        got = sorted((r.start_url, r.page_num, r.pos) for r in page_quota(cards, "ok", quota, max_pages=last).collect())
        assert got == sorted((s, p, i) for s, taken in want.items() for p, i in taken)
        seen = {r.start_url: r for r in quota_progress(cards, "ok", quota, max_pages=last).collect()}
        for s in {r[0] for r in rows}:
            accepted = sum(starts[s][p - 1][i] for p, i in want[s])
            r = seen[s]
            assert (r.pages_read, r.offered, r.accepted, r.cap) == (max((p for p, _ in want[s]), default=0), len(want[s]), accepted, quota)
            assert r.is_full == (quota is not None and accepted >= quota)


def test_keep_first(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), ("", 0, "empty"), (None, 0, "null"), ("b", 5, None)]
    df = spark.createDataFrame(rows, "k string, pos int, v string")
    assert sorted(tuple(r) for r in keep_first(df, "k", "pos").collect()) == [("a", 1, "early"), ("b", 5, None)]
    dotted = df.select(F.col("k").alias("c.k"), "pos", F.col("v").alias("c.v"))
    assert keep_first(dotted, "c.k", ["pos"]).columns == ["c.k", "pos", "c.v"]


def test_first_by_priority(spark):
    df = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 9, "y"), (1, 0, 4, "z")], "id int, strategy int, pos int, href string")
    assert first_by_priority(df, ["id"], "href", ["strategy", "pos"]).collect()[0].href == "z"


def test_category_cap(spark):
    df = spark.createDataFrame([(c, i) for c in range(5) for i in range(150)], "cat int, i int")
    got = {r.cat: r["count"] for r in category_cap(df, "cat", 400).groupBy("cat").count().collect()}
    assert got == {0: 150, 1: 150, 2: 150}
    assert category_cap(df, "cat", 300).count() == 300


def test_newest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (3, "c")], "t int, u string")
    assert [r.u for r in newest(df, "t", 2, "u").collect()] == ["c", "a"]
