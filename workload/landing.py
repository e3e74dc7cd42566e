"""Landed payloads derived from the given tables by Spark: feeds, catalogs, pages, responses.

Every payload document groups a bounded run of ids, so documents stay small however large the tables grow.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.plans.directory import extraction_requests

AS_OF = datetime(2024, 1, 3, tzinfo=timezone.utc)
BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
PER_DOC = 50
#: Rows of a table that one task takes when each row is costly.
SPREAD_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; with ``spread`` it is dealt out for costly row work, to all cores and to tasks of at most about ``SPREAD_ROWS`` rows."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if not spread:
        return df
    parts = max(spark.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS))
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df


def xml_text(c: Column) -> Column:
    """Text escaped for XML."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def element(name: str, text: Column) -> Column:
    """An element, or nothing for a null text."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>")), F.lit(""))


def joined(keys: list[str], order: str, text: Column, df: DataFrame) -> DataFrame:
    """One text per key: the rows' texts in order."""
    pieces = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, text.alias("_t")))).alias("_parts"))
    return pieces.select(*keys, F.array_join(F.transform("_parts", lambda p: p["_t"]), "").alias("body"))


def headline() -> Column:
    return F.substring_index("text", "\n", 1)


def feed_date() -> Column:
    """The date text of a document: mail date, ISO, relative or none, by language; the age is its length in minutes."""
    ts = F.lit(BASE) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("n_chars").cast("int"))
    return (
        F.when(F.col("lang") == "en", F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")))
        .when(F.col("lang") == "de", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("lang") == "fr", F.concat((F.col("n_chars") % 60).cast("string"), F.lit(" hours ago")))
    )


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS documents of the ``documents`` table; an item links to the page of the same id, if there is one.

    English items carry their link as an address, French documents are Atom entries with ``href`` links.
    """
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    docs = table(spark, sf_dir, "documents").join(pages, "doc_id", "left")
    url = xml_text(F.coalesce("url", F.lit("")))
    rss = F.concat(
        F.lit("<item>"), element("title", xml_text(headline())), element("link", url), element("pubDate", feed_date()),
        element("description", xml_text(F.col("text"))), F.lit("</item>"),
    )
    atom = F.concat(
        F.lit("<entry>"), element("title", xml_text(headline())), F.lit('<link href="'), url, F.lit('"/>'),
        element("updated", feed_date()), element("summary", xml_text(F.col("text"))), F.lit("</entry>"),
    )
    is_atom = F.col("lang") == "fr"
    rows = docs.withColumn("part", F.floor(F.col("doc_id") / PER_DOC).cast("int")).withColumn("atom", is_atom)
    bodies = joined(["part", "atom"], "doc_id", F.when(F.col("atom"), atom).otherwise(rss), rows)
    xml = F.when(F.col("atom"), F.concat(F.lit("<feed>"), F.col("body"), F.lit("</feed>"))).otherwise(
        F.concat(F.lit("<rss><channel>"), F.col("body"), F.lit("</channel></rss>"))
    )
    name = F.concat(F.when(F.col("atom"), "atom").otherwise("rss"), F.col("part"))
    return bodies.select(
        (F.col("part") * 2 + F.col("atom").cast("int")).alias("src_pos"),
        name.alias("source_name"),
        F.concat(F.lit("http://feeds.example.com/"), name).alias("source_url"),
        xml.alias("xml"),
    )


def paper_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atom paper feeds of the ``documents`` table: two authors, a repository link for English texts."""
    ts = F.lit(BASE) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("n_chars").cast("int"))
    link = F.when(
        F.col("lang") == "en", F.concat(F.lit(" Code: github.com/"), F.col("source"), F.lit("/doc-"), F.col("doc_id"), F.lit(".git"))
    ).otherwise("")
    entry = F.concat(
        F.lit("<entry>"),
        element("id", F.concat(F.lit("http://papers.example.org/abs/"), F.col("doc_id"))),
        element("title", F.concat(F.lit(" "), xml_text(F.replace("text", F.lit("\n"), F.lit(" "))))),
        element("published", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        element("summary", F.concat(xml_text(F.col("text")), link)),
        F.lit("<author><name>"), F.col("source"), F.lit("</name></author><author><name>"), F.col("lang"), F.lit("</name></author></entry>"),
    )
    rows = table(spark, sf_dir, "documents").withColumn("part", F.floor(F.col("doc_id") / PER_DOC).cast("int"))
    return joined(["part"], "doc_id", entry, rows).select(
        "part", F.concat(F.lit("<feed>"), F.col("body"), F.lit("</feed>")).alias("xml")
    )


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository stars for the labelled documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        F.concat("source", F.lit("/doc-"), "doc_id").alias("repo"), (F.col("quality") * 100 + F.col("toxic")).alias("stars")
    )


def paper_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External ids of the German and French documents, which name a repository."""
    docs = table(spark, sf_dir, "documents").filter(F.col("lang").isin("de", "fr"))
    repository = F.concat(F.lit("https://github.com/"), F.col("source"), F.lit("/doc-"), F.col("doc_id"))
    return docs.select(F.col("doc_id").cast("string").alias("paper_id"), F.to_json(F.struct(F.lit("x").alias("other"), repository.alias("github_url"))).alias("external_ids"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store pages of the ``part`` table: one store per brand, equal names share a handle."""
    variants = F.array(
        F.struct(F.col("p_retailprice").cast("string").alias("price"), (F.col("p_size") > 40).alias("available")),
        F.struct(F.lit("1.0").alias("price"), (F.col("p_size") < 10).alias("available")),
    )
    product = F.struct(
        F.col("p_name").alias("title"),
        F.replace("p_name", F.lit(" "), F.lit("-")).alias("handle"),
        F.lower("p_brand").alias("vendor"),
        F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type")).alias("product_type"),
        F.array(F.repeat("p_name", 6), F.repeat("p_type", 6)).alias("tags"),
        F.when(F.col("p_size") > 5, variants).otherwise(F.array().cast(variants_type())).alias("variants"),
    )
    rows = table(spark, sf_dir, "part").withColumn("page_num", (F.floor(F.col("p_partkey") / 1000) + 1).cast("int"))
    pages = rows.groupBy("p_brand", "page_num").agg(F.sort_array(F.collect_list(F.struct("p_partkey", product.alias("p")))).alias("ps"))
    return pages.select(
        F.substring_index("p_brand", "#", -1).cast("int").alias("store_pos"),
        F.col("p_brand").alias("store"),
        F.lit("https://shop.example.com/products.json").alias("base_url"),
        "page_num",
        F.to_json(F.struct(F.transform("ps", lambda x: x["p"]).alias("products"))).alias("json"),
    )


def variants_type() -> str:
    return "array<struct<price:string,available:boolean>>"


def food(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Food pages of the ``part`` table: one category per type, larger sizes carry only the English name."""
    english = F.col("p_size") > 25
    product = F.struct(
        F.when(~english, F.col("p_name")).otherwise("").alias("product_name"),
        F.when(english, F.col("p_name")).alias("product_name_en"),
        F.when(F.col("p_size") > 3, F.col("p_partkey").cast("string")).alias("code"),
        F.col("p_brand").alias("brands"),
        F.when(F.col("p_size") > 10, F.array(F.concat(F.lit("en:"), F.lower("p_type")), F.lit("en:x"))).alias("categories_tags"),
        F.substring(F.lower("p_type"), 1, 1).alias("nutriscore_grade"),
        F.concat(F.col("p_size").cast("string"), F.lit(" g")).alias("quantity"),
        F.repeat("p_name", 10).alias("countries"),
    )
    rows = table(spark, sf_dir, "part").withColumn("page_num", (F.floor(F.col("p_partkey") / 1000) + 1).cast("int"))
    pages = rows.groupBy("p_type", "page_num").agg(F.sort_array(F.collect_list(F.struct("p_partkey", product.alias("p")))).alias("ps"))
    label = F.col("p_type")
    return pages.select(
        F.ascii(label).cast("int").alias("category_pos"),
        label.alias("label"),
        F.concat(F.lit("https://food.example.com/"), label).alias("source_url"),
        F.to_json(F.struct(F.transform("ps", lambda x: x["p"]).alias("products"))).alias("json"),
    )


def marketplace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marketplace pages of the ``part`` table in the markup the selectors expect."""
    card = F.concat(
        F.lit('<div class="_1AtVbE col"><a href="/p/'), F.col("p_partkey"), F.lit('?tracking=1" title="x"><img src="i.png">view</a>'),
        F.lit('<div class="_4rR01T">'), F.col("p_name"), F.lit("</div>"),
        F.when(F.col("p_size") > 10, F.concat(F.lit('<div class="_30jeq3">₹'), F.col("p_retailprice").cast("string"), F.lit("</div>"))).otherwise(""),
        F.when(F.col("p_size") > 30, F.concat(F.lit('<div class="x XQDdHH">'), F.col("p_size").cast("string"), F.lit("</div>"))).otherwise(""),
        F.lit("</div>"),
    )
    rows = table(spark, sf_dir, "part").withColumn("part", F.floor(F.col("p_partkey") / PER_DOC).cast("int"))
    return joined(["p_type", "part"], "p_partkey", card, rows).select(
        F.col("p_type").alias("category"),
        F.concat(F.lit("https://market.example.com/"), F.col("p_type"), F.lit("/"), F.col("part")).alias("source_url"),
        F.concat(F.lit("<html><body>"), F.col("body"), F.lit("</body></html>")).alias("html"),
    )


def company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory pages of the ``supplier`` table with its nation and region; every company is linked twice."""
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    link = F.concat(
        F.lit('<a class="c" href="/companies/'), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))), F.lit('"><span>'),
        F.col("s_name"), F.lit("</span><div>"), F.col("n_name"), F.lit(" | "), F.col("r_name"), F.lit("</div><i>more</i></a>"),
    )
    rows = rows.withColumn("page_num", (F.floor(F.col("s_suppkey") / PER_DOC) + 1).cast("int"))
    return joined(["page_num"], "s_suppkey", F.concat(link, link), rows).select(
        "page_num",
        F.concat(F.lit("https://dir.example.com/?page="), F.col("page_num")).alias("url"),
        F.concat(F.lit('<nav><a href="/about">About</a></nav>'), F.col("body")).alias("html"),
    )


#: Customers per listing and per listing page.
PER_LISTING, PER_PAGE = 300, 12


def directory_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of the ``customer`` table: cards with a name and a balance; builders are advertised, so no names."""
    name = F.concat(F.when(F.col("c_mktsegment") == "BUILDING", "Sponsored ").otherwise(""), F.col("c_name"))
    card = F.concat(
        F.lit('<div class="company-card"><b>'), name, F.lit("</b><i>$"), F.col("c_acctbal").cast("string"), F.lit("</i></div>")
    )
    key = F.col("c_custkey")
    rows = (
        table(spark, sf_dir, "customer")
        .withColumn("listing", F.floor(key / PER_LISTING))
        .withColumn("page_num", (F.floor((key % PER_LISTING) / PER_PAGE) + 1).cast("int"))
    )
    start = F.concat(F.lit("https://list.example.com/"), F.col("listing"))
    return joined(["listing", "page_num"], "c_custkey", card, rows).select(
        start.alias("start_url"), "page_num",
        F.concat(start, F.lit("?page="), F.col("page_num")).alias("url"),
        F.concat(F.lit("<body>"), F.col("body"), F.lit("</body>")).alias("html"),
    )


def extraction_responses(pages: DataFrame, content: dict[str, Column]) -> DataFrame:
    """Stored answers to the cards of ``directory_pages``: tier 0 fails below 5000, tier 1 knows balances above 1000."""
    requests = extraction_requests(pages, max_pages=None).withColumn("balance", F.substring_index("text", "$", -1).cast("double"))
    answer = F.to_json(
        F.struct(
            F.struct(F.lit("model").alias("name"), F.col("url")).alias("source"),
            F.struct(*[v.alias(k) for k, v in content.items()]).alias("content"),
            F.lit("2024-01-02T00:00:00Z").alias("collectedAt"),
        )
    )
    card = F.min(F.struct("json", "balance")).alias("card")  # one card, not the parts of two
    answers = requests.withColumn("json", answer).groupBy("req_id").agg(card).select("req_id", "card.balance", "card.json")
    tiers = F.array(
        F.struct(F.lit(0).alias("tier"), F.lit(1).alias("attempt"), F.when(F.col("balance") > 5000, F.col("json")).otherwise("{}").alias("json"), F.lit(None).cast("string").alias("error")),
        F.struct(F.lit(1).alias("tier"), F.lit(1).alias("attempt"), F.lit(None).cast("string").alias("json"), F.lit("rate_limit").alias("error")),
        F.struct(F.lit(1).alias("tier"), F.lit(2).alias("attempt"), F.when(F.col("balance") > 1000, F.col("json")).alias("json"), F.when(F.col("balance") <= 1000, "timeout").alias("error")),
    )
    return answers.select("req_id", F.explode(tiers).alias("_r")).select("req_id", "_r.*")


def tier_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``conversations`` table as answers: a turn is a tier; users fail, short answers lack the name."""
    length = F.length("text")
    named = F.to_json(F.struct(F.col("role").alias("name"), length.cast("string").alias("value")))
    nameless = F.to_json(F.struct(length.alias("value")))
    is_answer = F.col("role") == "assistant"
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("req_id"),
        F.col("turn").alias("tier"),
        F.lit(1).alias("attempt"),
        F.when(is_answer, F.when(length >= 100, named).otherwise(nameless)).alias("json"),
        F.when(F.col("role") == "user", "boom").when(F.col("role") == "system", "rate_limit").alias("error"),
    )
