"""Collections that are replaced, and addresses seen before."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemill.sources import history, versions


def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(ValueError, match="no rows yet"):
        versions.read(spark, base, "items")
    assert versions.append(spark.range(3), base, "items") == 1
    assert versions.append(spark.range(3), base, "items") == 1
    assert versions.read(spark, base, "items").count() == 6
    broken = spark.range(8).withColumn("id", F.when(F.col("id") < 7, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(PySparkException):
        versions.replace(broken, base, "items")
    assert versions.read(spark, base, "items").count() == 6
    # Rows that were written while their pointer was not count for nothing either.
    spark.range(50).write.parquet(f"{base}/items/rows-orphan")
    assert versions.read(spark, base, "items").count() == 6
    assert versions.replace(spark.range(2), base, "items") == 2
    assert sorted(r.id for r in versions.read(spark, base, "items").collect()) == [0, 1]
    assert versions.read(spark, base, "items", 1).count() == 6
    assert [r.version for r in versions.versions(spark, base, "items").orderBy("version").collect()] == [1, 2]


def test_only_unseen_addresses(spark, tmp_path):
    table = f"seen_{uuid.uuid4().hex}"
    history.create(spark, table, 4, str(tmp_path / "seen"))
    first = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("", 4), (None, 5)], "url string, _known int")
    new = history.unseen(first, table, "url")
    assert sorted(r["_known"] for r in new.collect()) == [1, 2, 3, 4, 5]
    history.remember(new, table, "url")
    second = spark.createDataFrame([("b", 6), ("c", 7), (None, 8), ("", 9)], "url string, _known int")
    assert sorted(r["_known"] for r in history.unseen(second, table, "url").collect()) == [7, 8, 9]
    history.remember(second, table, "url")
    assert sorted(r.address for r in spark.table(table).distinct().collect()) == ["a", "b", "c"]


def test_the_history_is_not_shuffled(spark, tmp_path):
    table = f"seen_{uuid.uuid4().hex}"
    history.create(spark, table, 4, str(tmp_path / "seen"))
    history.remember(spark.range(500).select(F.concat(F.lit("http://x/"), "id").alias("url")), table, "url")
    rows = spark.range(100).select(F.concat(F.lit("http://x/"), F.col("id") * 50).alias("url"))
    new = history.unseen(rows, table, "url")
    assert new.count() == 90
    plan = new._jdf.queryExecution().executedPlan().toString()
    # The one exchange is that of the new rows; the history is read bucket by bucket.
    assert plan.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount" in plan
