"""XML files as item streams, and names resolved across polls."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.test_resolve import frame, random_names
from tidemill.operators.resolve import dedup_batch
from tidemill.sources.seeds import load_seeds
from tidemill.streaming import monitor, resolution

AS_OF = datetime(2024, 1, 3, tzinfo=timezone.utc)
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def polled(stream, path, checkpoint):
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_xml_items(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.xml").write_text(
        "<rss><channel><item><title> One &amp; two </title><link>http://x/1</link><pubDate>Tue, 02 Jan 2024 20:00:00 +0000</pubDate><description>d &lt;b&gt;</description></item>"
        "<item><title>no link</title></item>\n<item><title>Empty</title><link/></item></channel></rss>"
    )
    (landed / "broken.xml").write_text("<rss><item><title>Lost</title><link>http://x/2</link><a></item><item><title>Kept</title><link>http://x/3</link></item><item><title>cut o")
    (landed / "none.xml").write_text("no xml at all")
    items = monitor.item_stream(spark, str(landed))
    polled(items, str(tmp_path / "out"), str(tmp_path / "check"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    fine = {r.title: r for r in rows if r.malformed is None}
    assert {"One & two", "Empty", "Kept"} == set(fine)
    assert fine["One & two"].link == "http://x/1" and fine["One & two"].description == "d <b>" and fine["Empty"].link == ""
    assert any("Lost" in r.malformed for r in rows if r.malformed)
    assert all(r.source_url.endswith(".xml") for r in rows)


def test_fresh_xml_items(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.xml").write_text(
        "<feed><entry><title>New</title><link href='http://x/1'/><updated>2024-01-02T23:00:00Z</updated><summary>s</summary></entry>"
        "<entry><title>Old</title><link href='http://x/2'/><updated>2023-01-02T23:00:00Z</updated></entry></feed>"
    )
    items = monitor.fresh_items_stream(monitor.item_stream(spark, str(landed), "entry"), AS_OF)
    polled(items, str(tmp_path / "out"), str(tmp_path / "check"))
    assert [(r.title, r.link, r.description) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("New", "http://x/1", "s")]


@pytest.mark.parametrize("scorer", ["wratio", "levenshtein"])
def test_polls_together_equal_one_batch(spark, tmp_path, scorer):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    names = [*random_names(70, seed=21), "OpenAI", "openai", "Hugging Face"]
    seeds = load_seeds(spark, seeds=["OpenAI", "Hugging Face"])
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    rows = frame(spark, names)
    assert resolution.mapping(spark, out).count() == 0
    for low, high in ((0, 30), (30, 31), (31, 200)):
        rows.filter(F.col("pos").between(low, high - 1)).write.mode("append").parquet(str(tmp_path / "landed"))
        stream = spark.readStream.schema("pos long, name string").parquet(str(tmp_path / "landed"))
        resolution.start_resolution(stream, seeds, out, check, scorer=scorer).awaitTermination()
    got = {r.name: r.canonical_name for r in resolution.mapping(spark, out).collect()}
    want = {r.name: r.canonical_name for r in dedup_batch(rows, seeds, scorer=scorer).collect()}
    assert got == want
    assert resolution.mapping(spark, out).count() == len(want)
