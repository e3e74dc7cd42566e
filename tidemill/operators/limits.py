"""Top-k, quota and cap operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tidemill.session import cut

#: What the crawl reads of a listing unless told otherwise.
MAX_PAGES = 20
#: Pages whose running sums are made together.
PAGE_BLOCK = 1024


def newest(df: DataFrame, ts: str, max_records: int | None = 1000, tie_breaker: str | None = None) -> DataFrame:
    """The newest rows, at most ``max_records`` (None: all); every task keeps that many before the merge."""
    if max_records is None:
        return df
    order = [F.desc(ts)] + ([F.col(tie_breaker)] if tie_breaker else [])
    return df.orderBy(*order).limit(max_records)


def _running(pages: DataFrame, start: str, page: str, value: str) -> DataFrame:
    """``pages`` with ``before``, the sum of ``value`` over the earlier pages of a listing, and ``nth``, the page's place among them.

    In two levels, blocks of pages and then the blocks of a listing, so that a listing with very many pages is not one task's work.
    """
    dealt = pages.withColumn("_block", F.floor(F.col(page) / PAGE_BLOCK))
    inside = Window.partitionBy(start, "_block").orderBy(page)
    dealt = dealt.withColumn("_within", F.sum(value).over(inside) - F.col(value)).withColumn("_nth", F.row_number().over(inside))
    blocks = dealt.groupBy(start, "_block").agg(F.sum(value).alias("_sum"), F.count("*").alias("_count"))
    earlier = Window.partitionBy(start).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.select(start, "_block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_sum", "_count")])
    joined = dealt.join(sums, [start, "_block"])
    return joined.withColumn("before", F.col("_within") + F.col("_sum")).withColumn("nth", F.col("_nth") + F.col("_count")).drop("_block", "_within", "_nth", "_sum", "_count")


def _quotas(ranked: DataFrame, pages: DataFrame, start: str, page: str, max_records: int) -> DataFrame:
    """``start, page, quota`` of every page that is read.

    While a page has no more cards than the quota left, the quota falls by its accepted cards, so running sums give it. From the first page with
    more cards on, what a page accepts depends on the quota itself; only then pages are settled one after the other, all listings at once, and pages
    whose first accepted card lies beyond the quota are passed over.
    """
    left = F.lit(max_records) - F.col("before")
    tight = pages.filter((left > 0) & (F.col("cards") > left)).groupBy(start).agg(F.min(page).alias("_tight"))
    settled = pages.join(tight, start, "left").filter((left > 0) & (F.col("_tight").isNull() | (F.col(page) <= F.col("_tight"))))
    quotas = cut(settled.select(start, page, left.alias("quota"), (F.col(page) == F.col("_tight")).alias("is_tight")))
    done = [quotas.select(start, page, "quota")]
    accepted = ranked.filter("_valid").select(start, page, "_rank")

    def after(read: DataFrame) -> DataFrame:
        """What is left after a page that was read in part: ``start, from, quota``."""
        taken = read.join(accepted, [start, page], "left").groupBy(start, page, "quota").agg(F.count(F.when(F.col("_rank") <= F.col("quota"), 1)).alias("_n"))
        return taken.select(start, (F.col(page) + 1).alias("from"), (F.col("quota") - F.col("_n")).alias("quota")).filter("quota > 0")

    state = cut(after(quotas.filter("is_tight").drop("is_tight")))
    rest = pages.join(tight, start).filter(F.col(page) > F.col("_tight")).select(start, page, "first")
    while not state.isEmpty():
        ahead = rest.join(state, start).filter(F.col(page) >= F.col("from"))
        nearest = state.join(ahead.filter(F.col("first") <= F.col("quota")).groupBy(start).agg(F.min(page).alias("_next")), start, "left")
        nearest = cut(nearest)
        reached = rest.join(nearest, start).filter((F.col(page) >= F.col("from")) & (F.col("_next").isNull() | (F.col(page) <= F.col("_next"))))
        done.append(reached.select(start, page, "quota"))
        state = cut(after(nearest.filter("_next is not null").select(start, F.col("_next").alias(page), "quota")))
    return reduce(DataFrame.unionByName, done)


def page_quota(
    cards: DataFrame, valid: str, max_records: int | None = 1000, start: str = "start_url", page: str = "page_num",
    pos: str = "pos", max_pages: int | None = MAX_PAGES,
) -> DataFrame:
    """The cards a page-by-page crawl with a quota takes.

    Each page offers its first ``max_records - accepted so far`` cards, valid or not; only valid ones count as
    accepted. Pages are read from 1 while the quota lasts; a missing page ends the crawl, as does page ``max_pages``. Either limit may be None.
    """
    w = Window.partitionBy(start, page).orderBy(pos)
    # No page can give more cards than the whole quota, and the rank filter is applied before the shuffle too.
    read = cards.filter(F.col(page) >= 1) if max_pages is None else cards.filter(F.col(page).between(1, max_pages))
    ranked = read.withColumn("_rank", F.row_number().over(w)).withColumn("_valid", F.coalesce(F.col(valid), F.lit(False)))
    if max_records is not None:
        ranked = ranked.filter(F.col("_rank") <= max_records)
    counted = ranked.groupBy(start, page).agg(
        F.count("*").alias("cards"), F.count(F.when(F.col("_valid"), 1)).alias("accepted"), F.min(F.when(F.col("_valid"), F.col("_rank"))).alias("first")
    )
    pages = cut(_running(counted, start, page, "accepted").filter(F.col(page) == F.col("nth")))
    if max_records is None:
        quotas = pages.select(start, page, F.lit(None).cast("long").alias("quota"))
    else:
        quotas = _quotas(ranked, pages, start, page, max_records)
    within = F.col("_quota").isNull() | (F.col("_rank") <= F.col("_quota"))
    return ranked.join(quotas.withColumnRenamed("quota", "_quota"), [start, page]).filter(within).select(*cards.columns)


def quota_progress(
    cards: DataFrame, valid: str, max_records: int | None = 1000, start: str = "start_url", page: str = "page_num",
    pos: str = "pos", max_pages: int | None = MAX_PAGES,
) -> DataFrame:
    """How far the crawl of each listing came: ``start, pages_read, offered, accepted, cap, is_full``; ``cap`` is ``max_records``."""
    taken = page_quota(cards, valid, max_records, start, page, pos, max_pages)
    counts = taken.groupBy(start).agg(
        F.max(page).cast("int").alias("pages_read"), F.count("*").alias("offered"), F.count(F.when(F.col(valid), 1)).alias("accepted")
    )
    every = cards.select(start).distinct().join(counts, start, "left")
    cap = F.lit(max_records).cast("long")
    n = [F.coalesce(c, F.lit(0)).alias(c) for c in ("pages_read", "offered", "accepted")]
    return every.select(start, *n, cap.alias("cap"), F.coalesce(F.col("accepted") >= cap, F.lit(False)).alias("is_full"))


def category_cap(df: DataFrame, category: str, target: int | None = 400) -> DataFrame:
    """Whole categories in order, the null one first, none started once ``target`` rows are reached (None: all).

    Row counts per category come first; the running total is over that short list.
    """
    if target is None:
        return df
    counts = df.groupBy(category).agg(F.count("*").alias("_n"))
    w = Window.orderBy(category).rowsBetween(Window.unboundedPreceding, -1)
    started = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).filter(F.col("_before") < target)
    return df.join(started.select(F.col(category).alias("_started")), F.col(category).eqNullSafe(F.col("_started")), "left_semi")
