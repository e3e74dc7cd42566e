"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemill.functions import dates, fuzzy, html, text, tokens, urls
from tidemill.operators import dedupe, enrich, filters, limits, links, neighbours, records, reports, resolve, tiers
from tidemill.plans import directory, listings, papers, signals
from tidemill.session import scratch_path
from tidemill.sources import cards, catalog, feeds, history, registry, seeds, sinks, versions
from tidemill.streaming import monitor, resolution
from workload import landing
from workload.landing import AS_OF, table

Query = Callable[[SparkSession, str], DataFrame]
_REGISTERED: dict[str, Query] = {}
#: The state store that keyed streaming state needs.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENTS_AS_OF = datetime(2024, 1, 20, tzinfo=timezone.utc)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    _REGISTERED[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_REGISTERED)


def stamp_text(ts: Column) -> Column:
    """An instant as plain text, so that results do not depend on how a client shows time zones."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", spread=True).withColumn("ts", F.col("ts").cast("timestamp"))


def plain(df: DataFrame) -> DataFrame:
    """Dotted names to underscores, times and lists to text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        c = stamp_text(c) if kind == "timestamp" else F.array_join(c, "|") if kind.startswith("array") else c
        out.append(c.alias(name.replace(".", "_").replace(" ", "_")))
    return df.select(*out)


# --- text and pages -----------------------------------------------------------------------------------


@query
def clean_html(spark, sf_dir):
    return table(spark, sf_dir, "pages", spread=True).select("page_id", html.clean_html(F.col("html")).alias("text"))


@query
def chunk_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", spread=True).select("page_id", "html")
    return listings.chunks(pages, 200)


@query
def chunk_counts(spark, sf_dir):
    """Windows and tokens per page."""
    pages = table(spark, sf_dir, "pages", spread=True).select("page_id", "html")
    return listings.chunks(pages, 200).groupBy("page_id").agg(
        F.count("*").alias("n_chunks"), F.sum("n_tokens").alias("n_tokens")
    )


@query
def chunk_ids(spark, sf_dir):
    """Windows of 500 byte-pair ids over whole documents."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    return tokens.chunk_ids(docs, "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 500)


@query
def token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True)
    return docs.select("doc_id", tokens.token_count(F.col("text")).cast("bigint").alias("n_tokens"))


@query
def main_text(spark, sf_dir):
    return table(spark, sf_dir, "pages", spread=True).select("page_id", html.main_text(F.col("html"), None).alias("body"))


@query
def main_text_regions(spark, sf_dir):
    """Pages whose region is ``main``, or that mark none, with a block of links at the end."""
    name = F.when(F.col("page_id") % 3 == 0, "main").otherwise("section")
    shown = F.replace(F.replace("html", F.lit("<article"), F.concat(F.lit("<"), name)), F.lit("</article"), F.concat(F.lit("</"), name))
    more = F.lit('<div><a href="/x">More of what others have read here</a> and some</div><p>The last block of this page.</p>')
    pages = table(spark, sf_dir, "pages", spread=True)
    return pages.select("page_id", html.main_text(F.concat(shown, more), None).alias("body"))


@query
def page_links(spark, sf_dir):
    links = table(spark, sf_dir, "pages", spread=True).select("page_id", F.explode(html.link_array(F.col("html"))).alias("l"))
    return links.select("page_id", F.col("l.pos").cast("bigint").alias("pos"), F.col("l.href").alias("href"), F.col("l.text").alias("text"))


@query
def next_links(spark, sf_dir):
    """Pages with a pager added: ``rel`` for even text lengths, a "Next" text otherwise, none on marked addresses."""
    pages = table(spark, sf_dir, "pages", spread=True)
    pager = (
        F.when(F.col("url").contains("#top"), "")
        .when(F.length("html") % 2 == 0, '<a rel="nofollow next" href="?p=2">more</a>')
        .otherwise('<a href="/list/2"><b>NEXT</b></a>')
    )
    links = html.link_array(F.concat("html", pager))
    return pages.select("page_id", urls.next_page_url(links, F.col("url")).alias("next_url"))


@query
def page_frontier(spark, sf_dir):
    """The next address to fetch: the page's own link, else the address with the page number raised."""
    pages = table(spark, sf_dir, "pages", spread=True)
    found = pages.select("page_id", "url", urls.next_page_url(html.link_array(F.col("html")), F.col("url")).alias("next_url"))
    return found.select("page_id", urls.next_candidate(F.col("next_url"), F.col("url"), F.col("url"), F.lit(1)).alias("next_url"))


@query
def set_page(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.set_page(F.col("url"), F.col("page_id") + 3).alias("paged_url"))


@query
def resolve_links(spark, sf_dir):
    """Every kind of reference against every page address."""
    forms = ["p/2", "?page=3", "#frag", "//cdn.example.com/x", "https://o.com/y", "../up", "/abs/./x", ""]
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(F.array(*map(F.lit, forms))).alias("href"))
    return pages.select("page_id", "href", urls.resolve_url(F.col("url"), F.col("href")).alias("resolved"))


@query
def product_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", spread=True)
    links = pages.select("page_id", "url", F.explode(html.link_array(F.col("html"))).alias("l"))
    return links.select(
        "page_id", F.col("l.pos").cast("bigint").alias("pos"),
        urls.product_url("https://shop.example.com", F.col("l.href")).alias("product_url"),
        urls.product_url("https://shop.example.com", F.col("url")).alias("page_product_url"),
    )


@query
def path_ids(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.last_segment(F.col("url")).alias("path_id"))


@query
def list_item_cards(spark, sf_dir):
    """Pages without card classes give their list items."""
    pages = table(spark, sf_dir, "pages", spread=True).select("page_id", "html")
    found = cards.card_text(pages, page_num=None)
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "text")


@query
def heuristic_names(spark, sf_dir):
    """Documents read as cards, one line per part: name, price and the length gate."""
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", F.regexp_replace("text", "\n", " | ").alias("card"))
    return filters.min_length(docs, "card", 20).select(
        "doc_id", text.heuristic_name(F.col("card")).alias("name"), text.heuristic_price(F.col("card")).alias("price")
    )


@query
def junk_free_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "documents", spread=True).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    kept = filters.without_junk(filters.min_length(lines, "line", 15), "line")
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


# --- dates ---------------------------------------------------------------------------------------------


@query
def normalize_dates(spark, sf_dir):
    """Each event's time written in seven ways and read back."""
    ts = F.col("ts")
    forms = {
        "mail": F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0530")),
        "mail_named": F.concat(F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" PST")),
        "mail_bare": F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss"),
        "iso": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "hours": F.concat(F.lit("Posted "), (F.col("event_id") % 1000).cast("string"), F.lit(" Hours ago")),
        "days": F.concat(F.col("user_id").cast("string"), F.lit("  days ago")),
        "junk": F.concat(F.lit("on "), F.col("event_type")),
    }
    rows = events(spark, sf_dir).select(
        "event_id", F.explode(F.array(*[F.struct(F.lit(k).alias("form"), v.alias("raw")) for k, v in forms.items()])).alias("f")
    )
    read = dates.normalize_date(F.col("f.raw"), F.lit(EVENTS_AS_OF))
    return rows.select("event_id", F.col("f.form").alias("form"), stamp_text(read).alias("read"))


@query
def parse_dates(spark, sf_dir):
    """The strict reading, rendered in UTC+05:30."""
    raw = F.when(F.col("event_type") == "view", F.lit("2 hours ago")).when(
        F.col("event_type") == "click", F.concat(F.date_format("ts", "d MMM yyyy HH:mm"), F.lit(" -0100"))
    ).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    read = dates.parse_date(raw, F.lit(EVENTS_AS_OF))
    return events(spark, sf_dir).select("event_id", dates.to_ist_iso(read).alias("read_ist"))


@query
def ist_times(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", dates.to_ist_iso(F.col("ts")).alias("ts_ist"))


@query
def fresh_events(spark, sf_dir):
    return filters.fresh(events(spark, sf_dir), "ts", EVENTS_AS_OF).select("event_id", "event_type", "user_id")


# --- text rules ----------------------------------------------------------------------------------------


def titled(spark, sf_dir) -> DataFrame:
    """Documents as job postings: the first line and a role as title, the text as description."""
    role = (
        F.when(F.col("lang") == "fr", F.concat(F.lit("Stage engineer at "), F.col("source"), F.lit(" Labs, Paris")))
        .when(F.col("lang") == "de", F.concat(F.col("source"), F.lit(" GmbH is hiring")))
        .when(F.col("lang") == "es", F.concat(F.lit("Remote designer ("), F.col("source"), F.lit(" SA)")))
        .otherwise("")
    )
    return table(spark, sf_dir, "documents", spread=True).select(
        "doc_id", F.concat(role, F.lit("; "), landing.headline()).alias("title"), F.col("text").alias("description")
    )


@query
def job_rules(spark, sf_dir):
    title, description = F.col("title"), F.col("description")
    return titled(spark, sf_dir).select(
        "doc_id",
        text.company_at(title).alias("company"),
        text.is_remote(title, description).alias("is_remote"),
        text.role_simple(title).alias("role_simple"),
        text.role_family(title, description).alias("role_family"),
    )


@query
def company_from_titles(spark, sf_dir):
    return titled(spark, sf_dir).select("doc_id", text.company_from_title(F.col("title")).alias("company"))


@query
def clean_names(spark, sf_dir):
    """Names without commas and stops, and the form the scorers compare."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "name"))
    name = F.concat(F.lit(" "), F.col("name"))
    return lines.select("doc_id", "line", text.clean_name(name).alias("name"), fuzzy.form(name).alias("form"))


# --- records -------------------------------------------------------------------------------------------


def nested_orders(spark, sf_dir) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("id"),
        F.struct("o_orderstatus", F.struct("o_totalprice", "o_orderpriority").alias("detail")).alias("order"),
        F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_mktsegment").alias("segment")).alias("market")).alias("customer"),
    )


@query
def flatten_orders(spark, sf_dir):
    return plain(records.flatten(nested_orders(spark, sf_dir)))


def order_json(spark, sf_dir) -> DataFrame:
    """Orders as extraction answers with every defect the rules know."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    name = F.concat(F.lit("Order "), F.col("o_orderkey"))
    year = F.year("o_orderdate")
    data = F.concat(
        F.lit('{"foundedYear": '),
        F.when(status == "F", F.concat(F.lit('"'), year, F.lit('"'))).when(status == "P", F.lit("null")).otherwise(F.concat(year, F.lit(".0"))),
        F.when(priority.startswith("1"), ', "employeeCount": "many"').otherwise(', "employeeCount": 12'),
        F.lit("}"),
    )
    content = F.concat(
        F.when(priority.startswith("2"), "{").otherwise(F.concat(F.lit('{"entityName": "'), name, F.lit('", '))), F.lit('"data": '), data, F.lit("}")
    )
    envelope = F.concat(
        F.when(priority.startswith("3"), '{"recordType": "JOB", ').otherwise("{"),
        F.lit('"source": {"name": "s", "url": "u"}, "collectedAt": "'), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('Z", "content": '), content, F.lit("}"),
    )
    broken = F.when(priority.startswith("4"), F.substring(envelope, 1, 60)).otherwise(envelope)
    return table(spark, sf_dir, "orders", spread=True).select("o_orderkey", broken.alias("json"))


@query
def conform_orders(spark, sf_dir):
    valid, _ = records.conform(order_json(spark, sf_dir), "json", "STARTUP")
    return plain(records.flatten(valid)).select(
        "o_orderkey", "record_schemaVersion", "record_recordType", "record_content_entityName",
        "record_content_data_foundedYear", "record_content_data_employeeCount", "record_collectedAt",
    )


@query
def conform_rejects(spark, sf_dir):
    _, rejected = records.conform(order_json(spark, sf_dir), "json", "STARTUP")
    return rejected.select("o_orderkey", F.array_join("errors", "; ").alias("errors"))


@query
def stamped_records(spark, sf_dir):
    """Suppliers as startup records with provenance and defaults."""
    rows = records.stamp(table(spark, sf_dir, "supplier"), "Supplier list", F.concat(F.lit("http://s/"), "s_suppkey"), AS_OF)
    return plain(records.flatten(records.to_records(rows, "STARTUP", {"entityName": F.col("s_name")})))


# --- dedupe, limits, reports ---------------------------------------------------------------------------


@query
def first_event_per_user(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return dedupe.keep_first(rows, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query
def first_document_per_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("text <> ''").select(F.sha2("text", 256).alias("digest"), "doc_id", "source")
    return dedupe.keep_first(docs, "digest", "doc_id").select("doc_id", "source")


@query
def first_by_priority(spark, sf_dir):
    """Per order the part of the first returned line, else of the first line."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("strategy")
    )
    return dedupe.first_by_priority(lines, ["l_orderkey"], "l_partkey", ["strategy", "l_linenumber", "l_partkey"])


@query
def newest_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return limits.newest(orders, "o_orderdate", 1000, "o_orderkey").select("o_orderkey", "o_totalprice")


@query
def page_quota(spark, sf_dir):
    """Events as cards: a user is a listing, a day a page; errors do not count toward the quota of 25."""
    return limits.page_quota(event_cards(spark, sf_dir), "ok", 25).select("start_url", F.col("pos").alias("event_id"))


def event_cards(spark, sf_dir) -> DataFrame:
    """Events as cards: a user is a listing, a day a page; errors are not valid."""
    rows = events(spark, sf_dir)
    return rows.select(
        F.col("user_id").alias("start_url"), F.dayofmonth("ts").alias("page_num"), F.col("event_id").alias("pos"),
        F.coalesce(F.col("event_type") != "error", F.lit(False)).alias("ok"),
    )


@query
def quota_progress(spark, sf_dir):
    """How far the crawl of each user's days comes with a quota of 25."""
    return limits.quota_progress(event_cards(spark, sf_dir), "ok", 25)


@query
def quota_progress_open(spark, sf_dir):
    """The same without a quota and without a last page."""
    return limits.quota_progress(event_cards(spark, sf_dir), "ok", None, max_pages=None)


@query
def category_cap(spark, sf_dir):
    """Parts by size, no further size started once a fifth of them are there."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return limits.category_cap(parts, "p_size", 400)


@query
def run_summary(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.struct(F.col("source").alias("name")).alias("source"))
    return reports.run_summary(docs)


@query
def latest_events(spark, sf_dir):
    return reports.list_latest(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), "event_id")


@query
def preview_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("_id"), F.col("page_id").alias("id"), "url", "html")
    return reports.preview(pages)


@query
def ragged_regions(spark, sf_dir):
    """Regions, nations and suppliers under the union of their columns."""
    parts = [
        table(spark, sf_dir, "region"),
        table(spark, sf_dir, "nation"),
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey")),
    ]
    return sinks.union_ragged(*parts)


# --- joins -----------------------------------------------------------------------------------------------


@query
def full_text_news(spark, sf_dir):
    """Documents link to the page of their id; a tenth of the links are empty and some lead nowhere."""
    pages = table(spark, sf_dir, "pages", spread=True)
    link = F.when(F.col("lang") == "es", "").otherwise(F.coalesce("url", F.concat(F.lit("http://gone/"), "doc_id")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    news = docs.join(pages.select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left").select("doc_id", link.alias("url"))
    return enrich.attach_full_text(news, pages, max_chars=None).select("doc_id", "url", "full_text")


@query
def repo_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    link = F.when(F.col("lang") != "es", F.concat(F.lit("https://github.com/"), "source", F.lit("/doc-"), "doc_id", F.lit(".x")))
    linked = docs.select("doc_id", link.alias("github_url"))
    return enrich.attach_repo_stats(linked, landing.repos(spark, sf_dir))


@query
def external_ids(spark, sf_dir):
    """Orders as papers without a repository, except the finished ones; customers as the id table."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("http://p.org/abs/"), "o_custkey", F.lit("/")).alias("paper_url"),
        F.when(F.col("o_orderstatus") == "F", F.lit("https://github.com/a/b")).alias("github_url"),
    )
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("paper_id"), F.col("c_name").alias("external_ids"))
    return enrich.attach_external_ids(rows, ids).select("o_orderkey", "external_ids")


@query
def first_valid_by_tier(spark, sf_dir):
    schema = T.StructType([T.StructField("name", T.StringType(), False, {}), T.StructField("value", T.IntegerType(), False, {"default": 0})])
    responses = landing.tier_responses(spark, sf_dir)
    requests = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("req_id")).distinct()
    chosen = tiers.first_valid_by_tier(requests, responses, schema)
    return chosen.select("req_id", "tier", F.col("record.name").alias("name"), F.col("record.value").alias("value"))


@query
def alive_tiers(spark, sf_dir):
    """Turns as tiers; a turn is alive when assistants speak in it."""
    turns = table(spark, sf_dir, "conversations")
    health = turns.groupBy(F.col("turn").alias("tier")).agg(F.bool_or(F.col("role") == "assistant").alias("alive"))
    return tiers.alive_tiers(turns.select(F.col("turn").alias("tier")).distinct(), health)


@query
def nearest_vectors(spark, sf_dir):
    """The ten nearest of all vectors to each whose id is a multiple of 100."""
    vectors = table(spark, sf_dir, "embeddings")
    found = neighbours.top_neighbours(vectors, 10, queries=vectors.filter("vec_id % 100 = 0"))
    return found.withColumn("cosine", F.round("cosine", 6))


# --- resolution ------------------------------------------------------------------------------------------


def part_names(spark, sf_dir) -> DataFrame:
    """Part names with a suffix by brand, so that they are close to, but seldom equal to, the plain names."""
    suffix = F.when(F.col("p_size") > 40, "").when(F.col("p_size") > 20, ", s.").otherwise(F.concat(F.lit(" "), F.substring("p_type", 1, 1)))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.concat("p_name", suffix).alias("name"))


def part_seeds(spark, sf_dir) -> DataFrame:
    """The names of large parts, in order of first appearance."""
    large = table(spark, sf_dir, "part").filter(F.col("p_type") == "LARGE").filter(F.col("p_size") > 45)
    return large.groupBy(F.col("p_name").alias("seed")).agg(F.min("p_partkey").alias("seed_pos")).select("seed_pos", "seed")


@query
def canonicalize_levenshtein(spark, sf_dir):
    return resolve.canonicalize(part_names(spark, sf_dir), part_seeds(spark, sf_dir), scorer="levenshtein")


@query
def canonicalize_names(spark, sf_dir):
    """The weighted ratio against the default seeds and the part names."""
    own = part_seeds(spark, sf_dir)
    both = seeds.load_seeds(spark).unionByName(own.withColumn("seed_pos", F.col("seed_pos") + 1000))
    return resolve.canonicalize(part_names(spark, sf_dir), both)


@query
def apply_mapping(spark, sf_dir):
    names = part_names(spark, sf_dir)
    log = resolve.mapping_log(names, part_seeds(spark, sf_dir), scorer="levenshtein")
    rewritten = resolve.apply_mapping(names, log, "name")
    return rewritten.groupBy("name").agg(F.count("*").alias("n_rows"))


@query
def dedup_levenshtein(spark, sf_dir):
    return resolve.dedup_batch(part_names(spark, sf_dir), part_seeds(spark, sf_dir), scorer="levenshtein")


@query
def dedup_names(spark, sf_dir):
    """Part, supplier and nation names as one batch under the weighted ratio."""
    suppliers = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 10**9).alias("pos"), F.col("s_name").alias("name"))
    nations = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 2 * 10**9).cast("bigint").alias("pos"), F.col("n_name").alias("name"))
    batch = part_names(spark, sf_dir).unionByName(suppliers).unionByName(nations)
    return resolve.dedup_batch(batch, seeds.load_seeds(spark))


@query
def dedup_customers(spark, sf_dir):
    """Customer names: a crowd of near copies."""
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), F.col("c_name").alias("name"))
    return resolve.dedup_batch(names, seeds.load_seeds(spark))


@query
def mapping_log_levenshtein(spark, sf_dir):
    log = resolve.mapping_log(part_names(spark, sf_dir), part_seeds(spark, sf_dir), scorer="levenshtein", pairwise=True)
    return log.select("step", "pos", "raw_name", "canonical_name", "match_score")


@query
def canonicalize_ratio(spark, sf_dir):
    """The plain ratio of insertions and deletions."""
    return resolve.canonicalize(part_names(spark, sf_dir), part_seeds(spark, sf_dir), scorer="ratio")


@query
def dedup_ratio(spark, sf_dir):
    return resolve.dedup_batch(part_names(spark, sf_dir), part_seeds(spark, sf_dir), scorer="ratio")


@query
def mapping_log_ratio(spark, sf_dir):
    log = resolve.mapping_log(part_names(spark, sf_dir), part_seeds(spark, sf_dir), scorer="ratio", pairwise=True)
    return log.select("step", "pos", "raw_name", "canonical_name", "match_score")


@query
def entity_mappings(spark, sf_dir):
    return resolve.mapping_log(part_names(spark, sf_dir), seeds.load_seeds(spark))


def names_middle(spark, sf_dir) -> int:
    """The place that halves the part names."""
    return table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0] // 2


def typed_names(spark, sf_dir) -> DataFrame:
    """The names of three record types: products, startups and papers' nations."""
    parts = part_names(spark, sf_dir).select(F.lit("PRODUCT").alias("entity_type"), "name")
    suppliers = table(spark, sf_dir, "supplier").select(F.lit("STARTUP").alias("entity_type"), F.col("s_name").alias("name"))
    labels = table(spark, sf_dir, "part").select(F.lit("LISTING").alias("entity_type"), F.concat(F.upper("p_name"), F.lit(" "), F.substring("p_type", 1, 1)).alias("name"))
    return parts.unionByName(suppliers).unionByName(labels)


@query
def link_records(spark, sf_dir):
    """Names of products, startups and listings resolved together."""
    found = links.link_records(typed_names(spark, sf_dir), part_seeds(spark, sf_dir), AS_OF, scorer="levenshtein")
    return found.withColumn("linked_at", stamp_text(F.col("linked_at")))


@query
def stream_resolution(spark, sf_dir):
    """Part names landed and resolved in two polls: the same as one batch of them all."""
    base = scratch_path(spark, "resolution")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    names = part_names(spark, sf_dir).withColumn("poll", F.col("pos") > names_middle(spark, sf_dir))
    for poll in (False, True):
        names.filter(F.col("poll") == poll).drop("poll").write.mode("append").parquet(f"{base}/landed")
        stream = spark.readStream.schema("pos long, name string").parquet(f"{base}/landed")
        resolution.start_resolution(stream, part_seeds(spark, sf_dir), f"{base}/out", f"{base}/checkpoint", scorer="levenshtein").awaitTermination()
    return resolution.mapping(spark, f"{base}/out")


# --- sources and sinks -------------------------------------------------------------------------------------


def item_rows(items: DataFrame) -> DataFrame:
    return items.select(
        "source_url", F.col("item_pos").cast("bigint").alias("item_pos"), "title", "link", "date_text",
        F.md5("description").alias("description_md5"),
    )


@query
def feed_items(spark, sf_dir):
    return item_rows(feeds.scan_feed(landing.feeds(spark, sf_dir)))


@query
def feed_items_lenient(spark, sf_dir):
    return item_rows(feeds.scan_feed(landing.feeds(spark, sf_dir), profile="lenient"))


@query
def paper_entries(spark, sf_dir):
    found = feeds.scan_papers(landing.paper_feeds(spark, sf_dir))
    return found.select(
        "title", F.array_join("authors", "|").alias("authors"), "paper_url", stamp_text(F.col("published_date")).alias("published"),
        "github_url", F.length("abstract").cast("bigint").alias("abstract_chars"),
    )


@query
def topic_papers(spark, sf_dir):
    found = feeds.scan_papers(landing.paper_feeds(spark, sf_dir))
    return filters.topic_filter(found, "ER THE").select("paper_url")


@query
def catalog_rows(spark, sf_dir):
    return catalog.scan_catalog(landing.catalog(spark, sf_dir), tag_chars=None).withColumn("item_pos", F.col("item_pos").cast("bigint"))


@query
def food_rows(spark, sf_dir):
    return catalog.scan_food(landing.food(spark, sf_dir)).drop("item_pos", "category_pos", "source_url")


@query
def nutrition_rows(spark, sf_dir):
    return catalog.scan_food(landing.food(spark, sf_dir), profile="nutrition", country_chars=None).drop("item_pos", "category_pos", "source_url")


@query
def company_cards(spark, sf_dir):
    found = cards.company_cards(landing.company_pages(spark, sf_dir), description_chars=None)
    return found.groupBy("name", "description", "href").agg(F.count("*").alias("n_links"))


@query
def marketplace_cards(spark, sf_dir):
    found = cards.selector_cards(landing.marketplace(spark, sf_dir), "https://market.example.com")
    return found.drop("pos", "source_url")


@query
def sourced_payloads(spark, sf_dir):
    """Landed documents matched to an ordered source list by address; the rest are dropped."""
    payloads = landing.feeds(spark, sf_dir).select("source_url", F.length("xml").alias("n"))
    number = F.regexp_extract("source_url", r"(\d+)$", 1).cast("int")
    known = payloads.select("source_url", number.alias("n")).distinct().filter("n % 3 <> 2")
    sources = known.select((-F.col("n")).alias("src_pos"), F.lit("jobs").alias("kind"), F.concat(F.lit("Feed "), "n").alias("source_name"), "source_url")
    return registry.with_source(payloads, sources, "jobs").select("src_pos", "source_name", "source_url")


@query
def csv_round_trip(spark, sf_dir):
    """Flattened orders written as CSV and read back."""
    path = scratch_path(spark, "orders-csv")
    sinks.write_csv(records.flatten(nested_orders(spark, sf_dir)), path)
    return plain(spark.read.option("header", True).csv(path)).withColumn("id", F.col("id").cast("bigint")).withColumn(
        "order_detail_o_totalprice", F.col("order_detail_o_totalprice").cast("double")
    )


@query
def collection_round_trip(spark, sf_dir):
    """Two appends and a replacement of one collection."""
    base = scratch_path(spark, "collections")
    nations = table(spark, sf_dir, "nation")
    sinks.write_collection(table(spark, sf_dir, "region"), base, "places", replace=True)
    for replace in (True, False):
        sinks.write_collection(nations, base, "places", replace)
    return spark.read.parquet(f"{base}/places").groupBy("n_nationkey", "n_name").agg(F.count("*").alias("n_rows"))


@query
def collection_versions(spark, sf_dir):
    """A collection replaced twice and added to."""
    base = scratch_path(spark, "versions")
    nations = table(spark, sf_dir, "nation")
    versions.replace(table(spark, sf_dir, "region"), base, "places")
    versions.replace(nations, base, "places")
    versions.append(nations, base, "places")
    return versions.read(spark, base, "places").groupBy("n_nationkey", "n_name").agg(F.count("*").alias("n_rows"))


@query
def unseen_addresses(spark, sf_dir):
    """Addresses of pages that the second of two runs finds new."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.length("html").alias("n"))
    name = f"addresses_{uuid.uuid4().hex}"
    history.create(spark, name, 8, scratch_path(spark, "addresses"))
    first = pages.filter(F.col("n") % 2 == 0)
    history.remember(history.unseen(first, name, "url"), name, "url")
    return history.unseen(pages, name, "url").select("url").distinct()


@query
def ragged_csv(spark, sf_dir):
    """Regions, nations and suppliers in one CSV file set, read back."""
    path = scratch_path(spark, "ragged-csv")
    regions, nations, suppliers = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    suppliers = suppliers.select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    sinks.write_ragged(path, regions, nations, suppliers)
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("r_name", "n_name", F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "s_name").agg(F.count("*").alias("n_rows"))


@query
def seed_file(spark, sf_dir):
    """Part names matched against seeds from a file."""
    path = scratch_path(spark, "seeds")
    listed = part_seeds(spark, sf_dir).agg(F.transform(F.sort_array(F.collect_list(F.struct("seed_pos", "seed"))), lambda x: x["seed"]).alias("names"))
    listed.select(F.to_json("names").alias("value")).write.text(path)
    known = seeds.load_seeds(spark, path)
    return resolve.canonicalize(part_names(spark, sf_dir), known, scorer="levenshtein")


@query
def mapping_file(spark, sf_dir):
    path = scratch_path(spark, "mapping-csv")
    log = resolve.mapping_log(part_names(spark, sf_dir), part_seeds(spark, sf_dir), scorer="levenshtein")
    sinks.write_mapping(log, path)
    rows = plain(spark.read.option("header", True).csv(path))
    return rows.groupBy("Raw_Name", "Canonical_Name", F.col("Match_Score").cast("bigint").alias("Match_Score")).agg(F.count("*").alias("n_rows"))


# --- plans -------------------------------------------------------------------------------------------------


@query
def research_papers(spark, sf_dir):
    return plain(papers.papers(landing.paper_feeds(spark, sf_dir), AS_OF, "er the", None, landing.repos(spark, sf_dir)))


@query
def research_papers_with_ids(spark, sf_dir):
    """The same with the repository that external ids name where the abstract names none."""
    feeds, repos, ids = landing.paper_feeds(spark, sf_dir), landing.repos(spark, sf_dir), landing.paper_ids(spark, sf_dir)
    return plain(papers.papers(feeds, AS_OF, "er the", None, repos, ids, fill_repo=True))


@query
def news(spark, sf_dir):
    rows = signals.news(landing.feeds(spark, sf_dir), table(spark, sf_dir, "pages", spread=True), AS_OF, None, None)
    return plain(rows)


@query
def jobs(spark, sf_dir):
    return plain(signals.jobs(landing.feeds(spark, sf_dir), AS_OF))


@query
def job_listings(spark, sf_dir):
    return plain(signals.job_listings(landing.feeds(spark, sf_dir), AS_OF, None, None))


@query
def catalog_products(spark, sf_dir):
    parts = [
        listings.store_products(landing.catalog(spark, sf_dir), AS_OF, None),
        listings.food_products(landing.food(spark, sf_dir), AS_OF, None),
        listings.marketplace_products(landing.marketplace(spark, sf_dir), "Market", "https://market.example.com", AS_OF),
        listings.nutrition_products(landing.food(spark, sf_dir), AS_OF, None),
    ]
    return plain(listings.catalog_products(*parts))


def supplier_seeds(spark, sf_dir) -> DataFrame:
    rich = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 9000)
    return rich.select(F.col("s_suppkey").alias("seed_pos"), F.col("s_name").alias("seed"))


@query
def company_list(spark, sf_dir):
    rows, _ = listings.company_list(
        landing.company_pages(spark, sf_dir), supplier_seeds(spark, sf_dir), "https://dir.example.com", "Directory", "YC", AS_OF, None,
        scorer="levenshtein", threshold=90,
    )
    return plain(rows)


def customer_seeds(spark, sf_dir) -> DataFrame:
    rich = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 9900)
    return rich.select(F.col("c_custkey").alias("seed_pos"), F.col("c_name").alias("seed"))


def _entity(name: str) -> Column:
    return F.regexp_extract("text", r"(Customer#\d+)", 1).alias(name)


def _directory(spark, sf_dir, content: dict[str, Column], entity_type: str) -> DataFrame:
    pages = landing.directory_pages(spark, sf_dir)
    responses = landing.extraction_responses(pages, content)
    flat, _ = directory.directory(pages, responses, entity_type, customer_seeds(spark, sf_dir), AS_OF, None, max_pages=None, scorer="levenshtein")
    return plain(flat)


@query
def startups(spark, sf_dir):
    data = F.struct(F.lit(2001).alias("foundedYear"), F.lit("seed").alias("fundingStage"))
    return _directory(spark, sf_dir, {"entityName": _entity("n"), "data": data}, "startup")


@query
def products(spark, sf_dir):
    return _directory(spark, sf_dir, {"startupName": _entity("n"), "pricingModel": F.lit("PAID")}, "product")


@query
def ecommerce_products(spark, sf_dir):
    return _directory(spark, sf_dir, {"productName": _entity("n"), "brand": F.lit("b")}, "ecommerce")


# --- streams -------------------------------------------------------------------------------------------------


@query
def stream_jobs(spark, sf_dir):
    """Landed feed documents polled twice into the jobs collection; the second poll finds nothing new."""
    base = scratch_path(spark, "monitor")
    landing.feeds(spark, sf_dir).select("source_name", "source_url", "xml").write.parquet(f"{base}/landed")
    items = monitor.fresh_stream(monitor.payload_stream(spark, f"{base}/landed"), AS_OF)
    for _ in range(2):
        monitor.start_monitor(items, "jobs", f"{base}/out", f"{base}/checkpoint", AS_OF).awaitTermination()
    return plain(spark.read.parquet(f"{base}/out/jobs")).drop("batch_id")


@query
def stream_xml_jobs(spark, sf_dir):
    """Feed documents landed as XML files, one of them broken off, polled into the jobs collection as they are."""
    base = scratch_path(spark, "xml-monitor")
    landing.feeds(spark, sf_dir).select("xml").write.text(f"{base}/landed")
    broken = spark.createDataFrame([("<rss><channel><item><title>Lost</title><link>http://x</link><desc",)], "value string")
    broken.write.mode("append").text(f"{base}/landed")
    found = []
    for element in ("item", "entry"):
        items = monitor.fresh_items_stream(monitor.item_stream(spark, f"{base}/landed", element), AS_OF)
        monitor.start_monitor(items, "jobs", f"{base}/out-{element}", f"{base}/checkpoint-{element}", AS_OF).awaitTermination()
        found.append(plain(spark.read.parquet(f"{base}/out-{element}/jobs")).drop("batch_id"))
    both = found[0].unionByName(found[1])
    return both.groupBy("content_company", "content_date", "content_is_remote", "content_role_family").agg(F.count("*").alias("n_items"))


@query
def stream_dedupe(spark, sf_dir):
    """Items that survive deduplication across polls; those without an address all do."""
    base = scratch_path(spark, "dedupe")
    landed = landing.feeds(spark, sf_dir).select("source_name", "source_url", "xml")
    landed.unionByName(landed).write.parquet(f"{base}/landed")
    items = monitor.dedupe_stream(monitor.fresh_stream(monitor.payload_stream(spark, f"{base}/landed"), AS_OF))
    monitor.start_monitor(items, "jobs", f"{base}/out", f"{base}/checkpoint", AS_OF).awaitTermination()
    written = plain(spark.read.parquet(f"{base}/out/jobs"))
    return written.groupBy("source_url", "content_company", "content_date", "content_is_remote", "content_role_family").agg(F.count("*").alias("n_items"))
