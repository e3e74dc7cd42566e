"""Whole plans on small fixtures, and the stream against the batch."""

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemill.plans import directory as D, listings as L, papers as P, signals as S
from tidemill.sources.seeds import load_seeds
from tidemill.streaming import monitor as M

AS_OF = datetime(2024, 1, 2, 12, 0, tzinfo=timezone.utc)
ITEM = "<item><title>{}</title><link>{}</link><pubDate>{}</pubDate><description>{}</description></item>"


def rss(*items):
    return "<rss><channel>" + "".join(ITEM.format(*i) for i in items) + "</channel></rss>"


def feeds(spark, *docs):
    rows = [(i, f"F{i}", f"http://f/{i}", d) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "src_pos int, source_name string, source_url string, xml string")


DOC_A = rss(
    ("Remote engineer at Acme Inc", "http://j/1", "3 hours ago", " Remote work "),
    ("Old", "http://j/2", "2 days ago", "x"),
    ("Baker", "", "", "no remoteness"),
)
DOC_B = rss(("Acme is hiring a Data Scientist (Berlin)", "http://j/1", "Tue, 02 Jan 2024 01:00:00 +0530", "d" * 400), ("intern", "http://j/3", "bad", "react"))


def test_news(spark):
    page = "<article><p>The whole story of the engineer and the job.</p><p>x</p></article>"
    pages = spark.createDataFrame([("http://j/1", page), ("http://j/9", page)], "url string, html string")
    rows = S.news(feeds(spark, DOC_A), pages, AS_OF).orderBy("`content.url`").collect()
    assert [(r["content.url"], r["content.summary"], r["content.full_text"]) for r in rows] == [
        ("", "no remoteness", None), ("http://j/1", "Remote work", "The whole story of the engineer and the job."),
    ]
    assert rows[1]["content.published_date"] == datetime(2024, 1, 2, 9) and rows[1]["source.name"] == "F0"
    assert list(rows[0].asDict()) == [
        "schemaVersion", "recordType", "source.name", "source.url", "content.title", "content.url",
        "content.published_date", "content.summary", "content.full_text", "collectedAt",
    ]


def test_jobs(spark):
    rows = S.jobs(feeds(spark, DOC_A), AS_OF).orderBy(F.desc("`content.role_family`")).collect()
    assert [(r["content.company"], r["content.is_remote"], r["content.role_family"]) for r in rows] == [
        (None, False, "Other"), ("Acme Inc", True, "Engineering"),
    ]


def test_job_listings(spark):
    rows = S.job_listings(feeds(spark, DOC_A, DOC_B), AS_OF).orderBy("`content.job_url`").collect()
    got = [(r["content.job_url"], r["content.title"], r["content.role_family"], r["content.company"]) for r in rows]
    assert got == [
        ("http://f/0", "Baker", "Other", None),
        ("http://j/1", "Remote engineer at Acme Inc", "Engineering", "Acme Inc"),
        ("http://j/2", "Old", "Other", None),
        ("http://j/3", "intern", "Internship", None),
    ]
    assert rows[1]["content.date"] == "2024-01-02T17:30:00+05:30"


def test_papers(spark):
    entry = "<entry><id>http://x/abs/{0}</id><title>AI {0}</title><published>2024-01-0{0}T00:00:00Z</published><summary>{1}</summary></entry>"
    doc = "<feed>" + entry.format(1, "github.com/o/r") + entry.format(2, "machine") + entry.format(3, "none") + "</feed>"
    repos = spark.createDataFrame([("o/r", 7)], "repo string, stars int")
    ids = spark.createDataFrame([("3", json.dumps({"github_url": "https://github.com/o/r"}))], "paper_id string, external_ids string")
    rows = P.papers(feeds(spark, doc), AS_OF, "ai", 1000, repos).orderBy("`content.title`").collect()
    assert [(r["content.title"], r["content.github_stars"]) for r in rows] == [("AI 1", 7), ("AI 2", None), ("AI 3", None)]
    filled = P.papers(feeds(spark, doc), AS_OF, None, 2, repos, ids, fill_repo=True).collect()
    assert {(r["content.title"], r["content.github_stars"]) for r in filled} == {("AI 2", None), ("AI 3", 7)}
    assert P.papers(feeds(spark, doc), AS_OF, "machine").count() == 1


def test_directory(spark):
    def page(*cards):
        return "".join(f'<div class="card"><b>{a}</b><i>{b}</i></div>' for a, b in cards)

    pages = spark.createDataFrame(
        [
            ("s", 1, "s?page=1", page(("Openai Incorporated Ltd", "builds models and more"), ("tiny", "x"), ("Sign in", "subscribe to the newsletter"))),
            ("s", 2, "s?page=2", page(("Completely Different Name", "$12 only today"), ("Openai Incorporated Ltd", "again, a duplicate card"))),
        ],
        "start_url string, page_num int, url string, html string",
    )
    requests = D.extraction_requests(pages).filter(F.col("text").startswith("Openai") & (F.col("page_num") == 1))
    answer = {"source": {"name": "m", "url": "m"}, "collectedAt": "2024-01-01", "content": {"entityName": "OpenAI Inc.", "data": {"foundedYear": 2015}}}
    responses = requests.select("req_id", F.lit(0).alias("tier"), F.lit(1).alias("attempt"), F.lit(json.dumps(answer)).alias("json"), F.lit(None).cast("string").alias("error"))
    flat, log = D.startups(pages, responses, load_seeds(spark), AS_OF)
    rows = {r["content.entityName"]: r for r in flat.collect()}
    # Two cards name the company differently, so both stay; the lookup then gives both the seed's name.
    assert sorted((r["content.entityName"], r["source.name"], r["content.data.foundedYear"]) for r in flat.collect()) == [
        ("Completely Different Name", "HeuristicFallback", None), ("OpenAI", "Directory", 2015), ("OpenAI", "HeuristicFallback", None),
    ]
    assert set(rows) == {"OpenAI", "Completely Different Name"} and log.count() == 3
    shop, _ = D.products(pages, responses, load_seeds(spark), AS_OF, ecommerce=True)
    got = {r["content.productName"]: r["content.price"] for r in shop.collect()}
    assert got["Completely Different Name"] == "$12 only today"
    plain, _ = D.products(pages, responses, load_seeds(spark), AS_OF, max_records=1)
    assert [r["content.pricingModel"] for r in plain.collect()] == ["UNKNOWN"]


def test_listings(spark):
    catalog = spark.createDataFrame(
        [(0, "S", "https://s/products.json", 1, json.dumps({"products": [{"title": "A", "handle": "a"}, {"title": "B", "handle": "a"}]}))],
        "store_pos int, store string, base_url string, page_num int, json string",
    )
    food = spark.createDataFrame(
        [(i, f"C{i}", json.dumps({"products": [{"product_name": f"food {i} {j}"} for j in range(3)]})) for i in range(3)],
        "category_pos int, label string, json string",
    )
    cards = spark.createDataFrame([("Phones", "u", '<div data-id="1"><a href="/x" title="y">Phone X</a></div>')], "category string, source_url string, html string")
    rows = L.catalog_products(L.store_products(catalog, AS_OF), L.food_products(food, AS_OF, 4), L.marketplace_products(cards, "M", "https://m", AS_OF))
    assert rows.columns[:4] == ["recordType", "source.name", "source.url", "content.productName"] and rows.columns[-1] == "content.rating"
    assert sorted(r["content.productName"] for r in rows.collect()) == ["A", "Phone X"] + sorted(f"food {i} {j}" for i in range(2) for j in range(3))
    assert L.nutrition_products(food.withColumn("source_url", F.lit("u")), AS_OF).count() == 9


def test_company_list(spark):
    html = '<a href="/companies/a">Openai</a><a href="/companies/b">Other Firm|does things</a><a href="/companies/c">Openai</a>'
    pages = spark.createDataFrame([(1, "u", html)], "page_num int, url string, html string")
    rows, log = L.company_list(pages, load_seeds(spark), "https://d.com", "Dir", "YC", AS_OF)
    got = sorted((r["content.entityName"], r["source.url"], r["content.data.description"]) for r in rows.collect())
    assert got == [("OpenAI", "https://d.com/companies/a", None), ("Other Firm", "https://d.com/companies/b", "does things")]
    assert sorted((r.raw_name, r.match_score) for r in log.collect()) == [("Openai", 100), ("Other Firm", 0)]


def test_chunks_rebuild_the_text(spark):
    pages = spark.createDataFrame([(1, "<p>one two, three</p><p>four  five!</p>"), (2, "<script>x</script>")], "page_id int, html string")
    rows = L.chunks(pages, 3).orderBy("chunk_no").collect()
    assert [r.n_tokens for r in rows] == [3, 3, 1] and "".join(r.chunk_text for r in rows) == "one two, three four  five!"


def test_stream_equals_batch_and_drops_repeats(spark, tmp_path):
    landed = feeds(spark, DOC_A, DOC_B).select("source_name", "source_url", "xml")
    landed.write.parquet(str(tmp_path / "in"))
    items = M.dedupe_stream(M.fresh_stream(M.payload_stream(spark, str(tmp_path / "in")), AS_OF))
    for _ in range(2):  # the second poll finds nothing new
        M.start_monitor(items, "jobs", str(tmp_path / "out"), str(tmp_path / "cp"), AS_OF).awaitTermination(120)
    # A later poll brings a known address and a new one.
    more = rss(("Again", "http://j/1", "1 hour ago", ""), ("New", "http://j/8", "1 hour ago", ""))
    feeds(spark, more).select("source_name", "source_url", "xml").write.mode("append").parquet(str(tmp_path / "in"))
    M.start_monitor(items, "jobs", str(tmp_path / "out"), str(tmp_path / "cp"), AS_OF).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out" / "jobs"))
    batch = S.fresh_items(feeds(spark, DOC_A, DOC_B, more), AS_OF)
    assert got.count() == batch.filter("link <> ''").select("link").distinct().count() + batch.filter("link = ''").count() == 4
    assert got.select("`content.date`").where(F.col("`content.date`") < AS_OF - timedelta(hours=24)).isEmpty()


def test_stream_loses_nothing_to_odd_dates_and_links(spark, tmp_path):
    """A date in the future makes nothing late, and items without an address are not taken for one another."""
    polls = [
        [("Engineer at Ahead", "http://j/1", "Wed, 02 Jan 2030 01:00:00 +0000", "")],
        [("Engineer at Nowhere", "", "1 hour ago", ""), ("Engineer at Noplace", "", "1 hour ago", "")],
        [("Engineer at Later", "http://j/2", "1 hour ago", ""), ("Again", "http://j/1", "1 hour ago", "")],
    ]
    for items in polls:
        feeds(spark, rss(*items)).select("source_name", "source_url", "xml").write.mode("append").parquet(str(tmp_path / "in"))
        stream = M.dedupe_stream(M.fresh_stream(M.payload_stream(spark, str(tmp_path / "in")), AS_OF))
        M.start_monitor(stream, "jobs", str(tmp_path / "out"), str(tmp_path / "cp"), AS_OF).awaitTermination(120)
    got = sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out" / "jobs")).select("`content.company`").collect())
    assert got == ["Ahead", "Later", "Noplace", "Nowhere"]


def test_xml_file_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(DOC_A)
    pages = spark.createDataFrame([("http://j/1", "<p>A body that is long enough to keep.</p>")], "url string, html string")
    items = M.fresh_stream(M.xml_stream(spark, str(tmp_path / "in")), AS_OF)
    M.start_monitor(items, "news", str(tmp_path / "out"), str(tmp_path / "cp"), AS_OF, pages).awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out" / "news")).collect()
    assert sorted((r["content.url"], r["content.full_text"]) for r in rows if r["content.url"]) == [("http://j/1", "A body that is long enough to keep.")]
