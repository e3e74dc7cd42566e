"""Mixing sources to target weights by Pareto order sampling (operator 10). DataFrame functions only.

The size of a document is its number of words. Sources, by code point and null last, weigh ``weights`` in turn and share ``share`` times
all words; a source's target stops at ``most`` times its words, and the excess is shared again by weight until no target is above.

A source whose target is ``r`` times its words takes every document ``floor(r)`` times (certain whole copies). For the rest, ``f =
r - floor(r)`` of its words, documents are ranked by random odds divided by inclusion odds, ``u / (1 - u)`` over ``f / (1 - f)``
(times ``importance``, when a column gives one), and taken from the lowest rank on until the next one would pass the target in words. That
fixes the size of the sample in words; ``CLOSING`` more documents, each the one that comes nearest to what is left, close it as long as
that brings the total nearer. Where documents that are left would still bring it nearer, or the last one passes the target by more than the mean of those
left, the sample goes on from there down the ranks, past documents that do not fit, until none fits, and the nearest one closes it;
whichever is nearer to the target counts. The random number is a keyed hash of the row, so reruns agree.

No source is sorted as a whole: ranks are summed up in 4096 ranges, the range with the end of the sample in 4096 again, and only rows of that
small range are put in order.

Defined cases: a null text or one without words has size 0 and takes nothing; a null source is a source of its own; repeated rows
have a chance each; an empty table gives no rows; other columns are kept by ``sample`` and ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.session import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
CLOSING = 4
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Rows numbered from 0 in a total order, without bringing them into one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    parts = cut(parts.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))  # one row a partition
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return parts.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_n", "_start")


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes(source, source_size)`` with ``target``: the water level is raised until no capped source lies below it."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = cut(ranked(sizes, F.asc_nulls_last("source")).withColumn("weight", weight).drop("rank"))
    limit = most * F.col("source_size")
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level, capped = F.lit(0.0), -1
    while True:
        below = limit / F.col("weight") < level
        row = weighed.agg(
            F.count_if(below).alias("capped"), F.coalesce(F.sum(F.when(below, F.col("source_size"))), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(~below, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()  # three numbers
        if row.capped == capped or not row.weight:
            break
        level, capped = F.lit((total - most * row.words) / row.weight), row.capped
    return weighed.withColumn("target", F.least(limit, level * F.col("weight"))).drop("weight")


def _numbered(base: DataFrame) -> DataFrame:
    """Each row with ``copy``: its number, from 0, among rows of the same id, source and size."""
    key = ["doc_id", "source", "size"]
    rows = base.withColumn("part", F.shiftright("uid", 33))  # equal rows of one part are counted there, so that no task gets all of them
    inside = rows.withColumn("copy", F.row_number().over(Window.partitionBy(*key, "part").orderBy("uid")) - 1)
    counts = rows.groupBy(*key, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.withColumn("first", before).filter("first is not null").drop("n")
    same = [inside[c].eqNullSafe(starts[c]) for c in [*key, "part"]]
    return inside.join(starts, same, "left").select(*[inside[c] for c in base.columns], (F.col("copy") + F.coalesce("first", F.lit(0))).alias("copy"))


def _end_of(rows: DataFrame, bucket: Column, base: Column) -> DataFrame:
    """Per source the bucket in which the words taken reach ``rest``, and the words before it."""
    sums = rows.groupBy("sid", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first(base).alias("base"))
    through = F.col("base") + F.sum("words").over(Window.partitionBy("sid").orderBy("bucket"))
    over = sums.withColumn("through", through).filter("through > rest")
    return over.groupBy("sid").agg(F.min_by(F.struct("bucket", (F.col("through") - F.col("words")).alias("base")), "bucket").alias("b")).select("sid", "b.*")


def _ended(drawn: DataFrame) -> DataFrame:
    """Per source where its documents in rank order pass ``rest``: ``sid, fine_end, end, have, want``; no row where they do not."""
    wide, fine = F.shiftright("at", 28), F.shiftright("at", 16)
    first = _end_of(drawn, wide, F.lit(0).cast("long")).withColumnRenamed("bucket", "wide_end").withColumnRenamed("base", "base1")
    near = drawn.join(first, "sid").filter(wide == F.col("wide_end"))
    second = _end_of(near, fine, F.col("base1")).withColumnRenamed("bucket", "fine_end").withColumnRenamed("base", "base2")
    last = near.join(second, "sid").filter(fine == F.col("fine_end"))
    through = F.col("base2") + F.sum("size").over(Window.partitionBy("sid").orderBy("c", "doc_id", "copy").rowsBetween(Window.unboundedPreceding, 0))
    return last.withColumn("through", through).withColumn("in_", F.col("through") <= F.col("rest")).groupBy("sid").agg(
        F.first("fine_end").alias("fine_end"), F.max(F.when(F.col("in_"), _order())).alias("end"),
        F.coalesce(F.max(F.when(F.col("in_"), F.col("through"))), F.first("base2")).alias("have"), F.first("rest").alias("want"),
    )


def _order() -> Column:
    return F.struct("c", "doc_id", "size", "copy")


def _before_end() -> Column:
    """Whether a row joined with ``_ended`` comes before the end."""
    fine = F.shiftright("at", 16)
    return F.coalesce(fine < F.col("fine_end"), F.lit(False)) | (F.coalesce(fine == F.col("fine_end"), F.lit(False)) & F.coalesce(_order() <= F.col("end"), F.lit(False)))


def _nearest(free: DataFrame, gaps: DataFrame) -> DataFrame:
    """Per source the document that comes nearest to ``gap``, if it brings the total nearer: ``uid, sid, size, gap``."""
    m = F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "c", "doc_id", "size", "copy", "uid")).alias("m")
    return cut(free.join(gaps, "sid").groupBy("sid").agg(m, F.first("gap").alias("gap")).filter("m.off < gap").select("m.uid", "sid", "m.size", "gap"))


def _walked(left: DataFrame, gaps: DataFrame, closed: DataFrame) -> DataFrame:
    """``uid`` of the documents that close the samples: ``closed``, or a walk on down the ranks where that leaves room for more."""
    sums = closed.groupBy("sid").agg(F.sum("size").alias("words"), F.sum(F.when(F.col("size") > F.col("gap"), F.col("size"))).alias("over"))
    misses = gaps.join(sums, "sid", "left").select("sid", (F.col("gap") - F.coalesce("words", F.lit(0))).alias("miss"), F.coalesce("over", F.lit(0)).alias("over"))
    unused = left.join(closed.select("uid"), "uid", "left_anti").filter("size > 0")
    least = unused.groupBy("sid").agg(F.min("size").alias("least"), F.avg("size").alias("mean"))
    misses = cut(misses.join(least, "sid").filter("(miss > 0 and least < 2 * miss) or (miss < 0 and mean < -miss)"))
    if misses.isEmpty():
        return closed.select("uid")
    # The document that passes the target is put back there, and the ranks are followed past the documents that do not fit.
    fits = closed.filter("size <= gap").select("uid", "sid", "size")
    start = misses.select("sid", (F.col("miss") + F.col("over")).alias("gap"))
    free = cut(left.filter("size > 0").join(fits.select("uid"), "uid", "left_anti").join(misses.select("sid"), "sid", "left_semi"))
    open_, room, walked = free, start, None
    while True:
        fitting = cut(open_.join(room.withColumnRenamed("gap", "rest"), "sid").filter("size <= rest"))
        if fitting.isEmpty():
            break
        ends = cut(_ended(fitting))
        now = cut(fitting.join(ends, "sid", "left").filter(F.col("want").isNull() | _before_end()).select("uid", "sid", "size", "rest"))
        walked = now if walked is None else walked.unionByName(now)
        room = cut(now.groupBy("sid").agg((F.first("rest") - F.sum("size")).alias("gap")))
        open_ = fitting.drop("rest").join(now.select("uid"), "uid", "left_anti")
    if walked is not None:
        taken = walked.groupBy("sid").agg(F.sum("size").alias("words"))
        start = start.join(taken, "sid", "left").select("sid", (F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap"))
        free = free.join(walked.select("uid"), "uid", "left_anti")
    start = cut(start)
    last = _nearest(free, start)
    ends = start.join(last.select("sid", "size"), "sid", "left").withColumn("end", F.abs(F.col("gap") - F.coalesce("size", F.lit(0))))
    better = cut(ends.join(misses, "sid").filter("end < abs(miss)").select("sid"))
    more = fits.select("uid", "sid").unionByName(last.select("uid", "sid"))
    more = more if walked is None else more.unionByName(walked.select("uid", "sid"))
    return more.join(better, "sid", "left_semi").select("uid").unionByName(closed.join(better, "sid", "left_anti").select("uid"))


def plan(base: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """``base(uid, doc_id, source, size, importance)``, a written table, with ``source_size, target, times``.

    ``uid`` numbers the rows as ``monotonically_increasing_id`` does; ``times`` is how often the mix takes the document.
    """
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    per_source = targets(sizes, weights=weights, share=share, most=most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per_source = per_source.select(
        F.col("source").alias("src"), F.xxhash64("source", F.col("source").isNull()).alias("sid"), "source_size", "target", F.floor(ratio).alias("whole"),
        (ratio - F.floor(ratio)).alias("f"), (F.col("target") - F.floor(ratio) * F.col("source_size")).alias("rest"),
    )
    per_source = cut(per_source)
    numbered = _numbered(base)
    text = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("source", F.lit("")), "size", "copy")
    u = (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)
    joined = numbered.join(per_source, F.col("source").eqNullSafe(F.col("src"))).withColumn("u", u).drop("src")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("f") / (1 - F.col("f")) * F.col("importance"))
    chance = joined.withColumn("odds", F.when(F.col("f") > 0, odds)).withColumn("c", F.col("odds") / (1 + F.col("odds"))).drop("odds", "u")
    rows = cut(chance.withColumn("at", F.floor(F.col("c") * float(1 << 40))))

    drawn = rows.filter("f > 0")
    ended = cut(_ended(drawn))
    marked = cut(rows.join(ended, "sid", "left").withColumn("taken", (F.col("f") > 0) & _before_end()).drop("fine_end", "end", "have", "want"))

    gaps = ended.select("sid", (F.col("want") - F.col("have")).alias("gap"))
    left = marked.filter("f > 0 and not taken").select("uid", "sid", "c", "at", "doc_id", "size", "copy")
    closed, still = None, gaps
    for _ in range(CLOSING):
        more = _nearest(left if closed is None else left.join(closed.select("uid"), "uid", "left_anti"), still)
        closed = more if closed is None else closed.unionByName(more)
        still = more.select("sid", (F.col("gap") - F.col("size")).alias("gap"))
    extra = _walked(left, gaps, closed)
    chosen = marked.join(extra.select("uid", F.lit(True).alias("closing")), "uid", "left")
    times = F.col("whole") + (F.col("taken") | F.coalesce("closing", F.lit(False))).cast("int")
    return chosen.select("uid", "doc_id", "source", "size", "source_size", "target", times.cast("int").alias("times"))


def _base(docs: DataFrame, importance: str | None) -> DataFrame:
    weight = F.col(importance).cast("double") if importance else F.lit(1.0)
    return docs.select("uid", F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), weight.alias("importance"))


def mix(docs: DataFrame, *, importance: str | None = None, **options) -> DataFrame:
    """``docs(doc_id, source, text)``: ``doc_id, size, source_size, target, taken`` (words, repeats counted)."""
    base = cut(_base(docs.withColumn("uid", F.monotonically_increasing_id()), importance))
    return plan(base, **options).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def sample(docs: DataFrame, *, importance: str | None = None, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it takes them, with all their columns."""
    columns = docs.columns
    kept = cut(docs.select(F.struct(*columns).alias("row"), "doc_id", "source", "text", *([importance] if importance else [])).withColumn("uid", F.monotonically_increasing_id()).select("uid", "row"))
    base = cut(_base(kept.select("uid", "row.doc_id", "row.source", "row.text", *([f"row.{importance}"] if importance else [])), importance))
    times = plan(base, **options).select("uid", "times").filter("times > 0")
    return kept.join(times, "uid").select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
