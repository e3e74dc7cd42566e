"""Date rules against fixed cases and against the standard library on generated dates."""

from datetime import datetime, timedelta, timezone
from email.utils import format_datetime

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemill.functions.dates import normalize_date, parse_date, parse_paper_date, to_ist_iso
from tidemill.operators.filters import fresh

AS_OF = datetime(2024, 6, 15, 12, 0, tzinfo=timezone.utc)


def run(spark, texts, fn=normalize_date):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    rows = df.select("i", fn(F.col("raw"), F.lit(AS_OF)).alias("ts")).orderBy("i").collect()
    return [r.ts.replace(tzinfo=timezone.utc) if r.ts else None for r in rows]


def utc(*args):
    return datetime(*args, tzinfo=timezone.utc)


def test_cases(spark):
    cases = {
        None: AS_OF,
        "": AS_OF,
        "3 hours ago": AS_OF - timedelta(hours=3),
        "1 hour ago": AS_OF - timedelta(hours=1),
        "2 days ago": AS_OF - timedelta(days=2),
        "1 day 3 hours ago": AS_OF - timedelta(hours=3),
        "30 minutes ago": AS_OF,
        "Mon, 01 Jan 2024 12:00:00 +0000": utc(2024, 1, 1, 12),
        "Mon, 01 Jan 2024 12:00:00": utc(2024, 1, 1, 12),
        "Mon, 01 Jan 2024 12:00:00 GMT": utc(2024, 1, 1, 12),
        "Mon, 01 Jan 2024 12:00:00 EST": utc(2024, 1, 1, 17),
        "1 Jan 24 12:00 -0730": utc(2024, 1, 1, 19, 30),
        "2024-06-15T08:30:00Z": utc(2024, 6, 15, 8, 30),
        "2024-06-15 08:30:00.25+05:30": utc(2024, 6, 15, 3, 0, 0, 250000),
        "2024-06-15": utc(2024, 6, 15),
        "2024-13-45": AS_OF,
        "Mon, 45 Jan 2024 12:00:00 +0000": AS_OF,
        "not-a-date-at-all!!!": AS_OF,
        "99999999999 hours ago": None,
    }
    assert run(spark, list(cases)) == list(cases.values())


def test_strict_variant_ignores_relative_forms(spark):
    got = run(spark, ["3 hours ago", "Mon, 01 Jan 2024 12:00:00 +0530", "2024-06-15T08:30:00Z"], parse_date)
    assert got == [AS_OF, utc(2024, 1, 1, 6, 30), utc(2024, 6, 15, 8, 30)]


def test_paper_date_is_strict(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02",), ("2024-01-02T03:04:05+00:00",)], "d string")
    got = [r[0] for r in df.select(parse_paper_date(F.col("d"))).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4, 5), None, None]


def test_ist_text(spark):
    df = spark.createDataFrame([(utc(2024, 1, 1, 12),), (utc(2024, 1, 1, 20, 0, 0, 5),)], "t timestamp")
    got = [r[0] for r in df.select(to_ist_iso(F.col("t"))).collect()]
    assert got == ["2024-01-01T17:30:00+05:30", "2024-01-02T01:30:00.000005+05:30"]


@settings(max_examples=3, deadline=None)
@given(
    st.lists(
        st.datetimes(min_value=datetime(1950, 1, 1), max_value=datetime(2060, 1, 1)).flatmap(
            lambda d: st.integers(-11 * 60, 13 * 60).map(lambda m: d.replace(tzinfo=timezone(timedelta(minutes=m))))
        ),
        min_size=20,
        max_size=20,
    )
)
def test_generated_dates_match_the_standard_library(spark, dates):
    assert run(spark, [d.isoformat() for d in dates]) == [d.astimezone(timezone.utc) for d in dates]
    whole = [d.replace(microsecond=0) for d in dates]
    assert run(spark, [format_datetime(d) for d in whole]) == [d.astimezone(timezone.utc) for d in whole]


def test_freshness_includes_the_bound_and_the_future(spark):
    stamps = [AS_OF - timedelta(hours=24), AS_OF - timedelta(hours=24, microseconds=1), AS_OF + timedelta(days=9)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "i int, ts timestamp")
    assert sorted(r.i for r in fresh(df, "ts", AS_OF).collect()) == [0, 2]


def test_rows_of_costly_work_are_dealt_to_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    from workload import landing

    spark.range(1000).repartition(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(landing, "SPREAD_ROWS", 20)
    dealt = landing.table(spark, str(tmp_path), "events", spread=True)
    assert dealt.rdd.getNumPartitions() == 50 and max(dealt.rdd.glom().map(len).collect()) <= 40
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))
