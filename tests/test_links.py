"""Link records: ids by name, one resolution for all record types."""

import random
import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemill.operators import links
from tidemill.sources.seeds import load_seeds

AS_OF = datetime(2024, 1, 3, tzinfo=timezone.utc)
ROWS = [
    ("STARTUP", "Acme Robotics Solutions"), ("PRODUCT", "Acme Robotics Solution"), ("JOB", "acme robotics solutions"), ("JOB", "acme robotics solutions"), ("STARTUP", "openai"), ("NEWS", "OpenAI, Inc"),
    ("PAPER", "Zebra Dynamics"), ("STARTUP", None), ("STARTUP", "!!"), ("JOB", ""), ("STARTUP", "OpenAI"), ("PRODUCT", "Ünïcode Labs"), ("PRODUCT", "Zebra Dynamic"),
]


def test_uuid_of_a_name(spark):
    names = ["acme", "", "Ünïcode 京都", "x" * 300, *[str(random.Random(i).random()) for i in range(60)]]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", links.name_uuid(F.col("n")).alias("u"))
    assert all(r.u == str(uuid.uuid5(links.NAMESPACE, r.n)) for r in df.collect())


def records(spark, rows):
    df = spark.createDataFrame(rows, "entity_type string, name string").withColumn("pos", F.lit(1)).withColumn("canonical", F.lit("x"))
    return {(r.entity_type, r.raw_name): r for r in links.link_records(df, load_seeds(spark), AS_OF).collect()}


def test_one_entity_across_types(spark):
    got = records(spark, ROWS)
    assert len(got) == 9
    acme = {got[k].canonical_id for k in got if k[1].lower().startswith("acme")}
    assert len(acme) == 1 and uuid.UUID(acme.pop()).version == 5
    assert {got[k].canonical_id for k in got if "openai" in k[1].lower()} == {"seed_openai"}
    assert got[("PAPER", "Zebra Dynamics")].canonical_id == got[("PRODUCT", "Zebra Dynamic")].canonical_id
    assert got[("JOB", "acme robotics solutions")].n_records == 2
    assert got[("STARTUP", "OpenAI")].match_score == 100


def test_ids_do_not_depend_on_the_order(spark):
    want = {k: (r.canonical_id, r.canonical_name) for k, r in records(spark, ROWS).items()}
    for seed in range(2):
        rows = random.Random(seed).sample(ROWS, len(ROWS))
        assert {k: (r.canonical_id, r.canonical_name) for k, r in records(spark, rows).items()} == want


def test_no_names(spark):
    assert records(spark, [("JOB", None)]) == {}
