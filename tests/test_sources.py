import csv
import glob
import json
from datetime import datetime

from pyspark.sql import functions as F

from tidemill.sources import sinks
from tidemill.sources.cards import card_text, company_cards, selector_cards
from tidemill.sources.catalog import scan_catalog, scan_food
from tidemill.sources.feeds import scan_feed, scan_papers
from tidemill.sources.registry import registry, with_source

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>Feed</title><link>http://f</link>
<item><title> One &amp; only </title><link>http://a/1</link><pubDate>Mon, 01 Jan 2024 12:00:00 +0000</pubDate><updated>u</updated>
<description><![CDATA[<p>Hi</p> there]]></description></item>
<item><link>http://a/2</link></item><item><title>No link</title></item>
<item><title>Bare</title><link>http://a/4</link></item>
<item><title></title><link>http://a/5</link><published>p</published><summary>s</summary></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title><link href="http://f"/>
<entry><title type="html">Two</title><link href="http://b/1" rel="alternate"/><updated>2024-01-01T00:00:00Z</updated><content>c</content></entry>
<entry><title>Three</title><link/></entry></feed>"""
BOTH = """<rss><channel><item><title>I</title><link>l</link></item></channel><entry><title>E</title><link href="x"/></entry></rss>"""


def feeds(spark, *docs):
    return spark.createDataFrame([(i, f"http://feed/{i}", d) for i, d in enumerate(docs)], "src_pos int, source_url string, xml string")


def test_news_profile(spark):
    rows = scan_feed(feeds(spark, RSS, ATOM, BOTH, "<rss><broken")).orderBy("src_pos", "item_pos").collect()
    got = [(r.src_pos, r.title, r.link, r.date_text, r.description) for r in rows]
    assert got == [
        (0, "One & only", "http://a/1", "Mon, 01 Jan 2024 12:00:00 +0000", "<p>Hi</p> there"),
        (0, "Bare", "http://a/4", None, None),
        (0, "", "http://a/5", "p", "s"),
        (1, "Two", "http://b/1", "2024-01-01T00:00:00Z", None),
        (1, "Three", "", None, None),
        (2, "I", "l", None, None),
    ]


def test_lenient_profile(spark):
    rows = scan_feed(feeds(spark, RSS, ATOM), profile="lenient").orderBy("src_pos", "item_pos").collect()
    assert [(r.title, r.link, r.description) for r in rows] == [
        ("One & only", "http://a/1", "<p>Hi</p> there"),
        ("No link", "http://feed/0", None),
        ("Bare", "http://a/4", None),
        ("Two", "http://b/1", "c"),
        ("Three", "http://feed/1", None),
    ]


def test_papers(spark):
    entry = "<entry><id>http://x/abs/{0}</id><title>T\n{0}</title><published>{1}</published><summary>{2}</summary>{3}</entry>"
    two = "<author><name>A B</name></author><author><name>C</name></author>"
    doc = "<feed>" + entry.format(1, "2024-01-02T03:04:05Z", "code at github.com/o-x/r_y.js ok", two)
    doc += entry.format(2, "2024-01-02", "", two) + entry.format(3, "2024-01-02T03:04:05Z", "none", "") + "</feed>"
    rows = scan_papers(feeds(spark, doc)).orderBy("entry_pos").collect()
    assert [(r.title, r.authors, r.paper_url, r.github_url) for r in rows] == [
        ("T 1", ["A B", "C"], "http://x/abs/1", "https://github.com/o-x/r_y"),
        ("T 3", [], "http://x/abs/3", None),
    ]
    assert rows[0].published_date == datetime(2024, 1, 2, 3, 4, 5)


def test_catalog(spark):
    products = [
        {"title": "Shirt", "handle": "shirt", "vendor": "V", "product_type": "", "tags": ["a" * 60, "b" * 60],
         "variants": [{"price": "19.00", "available": False}, {"price": "1", "available": True}]},
        {"title": "", "handle": "x"},
        {"title": "Bare", "handle": "bare"},
        {"title": "Free", "handle": "f", "product_type": "P", "variants": [{"price": None}]},
    ]
    df = spark.createDataFrame([("S", "https://s.com/products.json", 1, json.dumps({"products": products}))], "store string, base_url string, page_num int, json string")
    rows = scan_catalog(df).orderBy("item_pos").collect()
    assert [(r.product_name, r.product_url, r.category, r.brand, r.price, r.available) for r in rows] == [
        ("Shirt", "https://s.com/products/shirt", "General", "V", "$19.00", True),
        ("Bare", "https://s.com/products/bare", "General", "", None, False),
        ("Free", "https://s.com/products/f", "P", "", None, False),
    ]
    assert rows[0].tags == ("a" * 60 + ", " + "b" * 60)[:100] and rows[0].currency == "USD"


def test_food(spark):
    products = [
        {"product_name": "Juice", "code": "12", "brands": "B", "categories_tags": ["en:juices", "en:x"], "nutriscore_grade": "b", "countries": "c" * 90},
        {"product_name": "", "product_name_en": "Milk"},
        {"product_name": "ab"},
    ]
    df = spark.createDataFrame([("Drinks", json.dumps({"products": products}))], "label string, json string")
    rows = scan_food(df).orderBy("item_pos").collect()
    assert [(r.product_name, r.product_url, r.category, r.brand, r.tags) for r in rows] == [
        ("Juice", "https://world.openfoodfacts.org/product/12", "Drinks", "B", "juices"),
        ("Milk", "https://world.openfoodfacts.org", "Drinks", "", ""),
    ]
    rows = scan_food(df, profile="nutrition").orderBy("item_pos").collect()
    assert [(r.nutriscore, r.quantity, r.countries) for r in rows] == [("B", "", "c" * 80), ("", "", None)]


def test_directory_cards(spark):
    nested = '<div class="grid-x"><div class="Product-Card"><b>Name</b> text <!-- no --><script>no</script></div><li>plain</li></div>'
    plain = "<ul><li>a &amp; b<li>c</ul><p>after</p>"
    df = spark.createDataFrame([(1, 1, nested), (2, 1, plain), (3, 2, plain), (4, 1, "<p>none</p>")], "id int, page_num int, html string")
    rows = card_text(df).orderBy("id", "pos").collect()
    assert [(r.id, r.pos, r.text) for r in rows] == [
        (1, 0, "Name | text | plain"), (1, 1, "Name | text"), (2, 0, "a & b | c"), (2, 1, "c"),
    ]


def test_company_cards(spark):
    html = (
        '<a href="/companies/acme-1"><span>Acme</span><div>Makes | things</div><i>well</i></a>'
        '<a href="/companies/Upper">No</a><a href="/companies/x"> X </a><a href="/companies/zed">Zed</a>'
    )
    df = spark.createDataFrame([("u", html)], "url string, html string")
    rows = company_cards(df).orderBy("pos").collect()
    assert [(r.name, r.description, r.href) for r in rows] == [
        ("Acme", "Makes things", "/companies/acme-1"), ("Zed", None, "/companies/zed"),
    ]


def test_selector_cards(spark):
    card = '<div class="_1AtVbE"><a href="/p?x=1" title="t">Go</a><div class="_4rR01T">Phone <b>X</b></div><div class="Nx9bqj">₹1,299</div></div>'
    short = '<div class="_1AtVbE"><a href="/q"></a><div class="KzDlHZ">abcd</div></div>'
    no_link = '<div class="_1AtVbE"><div class="KzDlHZ">abcdef</div></div>'
    other = '<div data-id="1"><a class="s1Q9rs" href="https://o.com/z">Headset</a><div class="XQDdHH">4.1</div></div>'
    df = spark.createDataFrame([("A", card + short + no_link), ("B", other), ("C", "")], "category string, html string")
    rows = selector_cards(df, "https://m.com").orderBy("category").collect()
    assert [tuple(r) for r in rows] == [
        ("A", 0, "PhoneX", "https://m.com/p", "₹1,299", None), ("B", 0, "Headset", "https://o.com/z", None, "4.1"),
    ]


def test_registry(spark):
    sources = registry(spark)
    payloads = spark.createDataFrame([("https://hnrss.org/jobs", "x"), ("https://nowhere", "y")], "source_url string, xml string")
    assert [(r.source_name, r.xml) for r in with_source(payloads, sources, "jobs").collect()] == [("YC HackerNews Jobs", "x")]


def read_csv(path):
    rows = []
    for part in sorted(glob.glob(f"{path}/*.csv")):
        with open(part, newline="") as f:
            rows += list(csv.reader(f))
    return rows


def test_csv_and_ragged(spark, tmp_path):
    df = spark.sql("""select 'x, "y"' `a.b`, array('p', 'q') authors, cast(null as string) n, '' e""").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "a"))
    assert read_csv(tmp_path / "a") == [["a.b", "authors", "n", "e"], ['x, "y"', '["p","q"]', "", ""]]
    left, right = spark.sql("select 'l' `k.x`, 1 n"), spark.sql("select 'r' `k.x`, 'z' extra")
    assert sinks.union_ragged(left, right).columns == ["k.x", "n", "extra"]
    assert [tuple(r) for r in sinks.union_ragged(left, right).collect()] == [("l", 1, ""), ("r", None, "z")]
    assert not sinks.write_ragged(str(tmp_path / "none"), left.limit(0))
    assert not (tmp_path / "none").exists()


def test_collections_append_unless_replaced(spark, tmp_path):
    df = spark.range(3)
    for replace, expected in [(False, 3), (False, 6), (True, 3)]:
        sinks.write_collection(df, str(tmp_path), "items", replace)
        assert spark.read.parquet(str(tmp_path / "items")).count() == expected


def test_mapping_file(spark, tmp_path):
    log = spark.sql("select 'r' raw_name, 'c' canonical_name, 90 match_score, 0 step")
    assert sinks.write_mapping(log, str(tmp_path / "m"))
    assert read_csv(tmp_path / "m") == [["Raw Name", "Canonical Name", "Match Score"], ["r", "c", "90"]]
    assert not sinks.write_mapping(log.limit(0), str(tmp_path / "e"))
