import json
from datetime import datetime

from pyspark.sql import functions as F, types as T

from tidemill.operators import records as R
from tidemill.operators.tiers import alive_tiers, first_valid_by_tier

SIMPLE = T.StructType([T.StructField("name", T.StringType(), False, {}), T.StructField("value", T.IntegerType(), False, {"default": 0})])


def columns(spark, sql):
    return R.flatten(spark.sql(sql)).columns


def test_flatten(spark):
    assert columns(spark, "select 1 a, 'x' b") == ["a", "b"]
    assert columns(spark, "select named_struct('inner', 1) outer") == ["outer.inner"]
    assert columns(spark, "select named_struct('b', named_struct('c', 'x')) a") == ["a.b.c"]
    assert columns(spark, "select 'n' name, named_struct('score', 1, 'label', null) data") == ["name", "data.score", "data.label"]
    assert columns(spark, "select array('a') authors, struct() e") == ["authors"]
    assert R.flatten(spark.sql("select named_struct('b', array('x')) a")).first()[0] == ["x"]


def check(spark, schema, docs):
    df = spark.createDataFrame([(i, d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(docs)], "i int, j string")
    rows = R.parse_records(df, "j", schema).orderBy("i").collect()
    return [(r.record.asDict(True) if r.record else None, r.errors) for r in rows]


def test_lax_coercion_defaults_and_nulls(spark):
    got = check(
        spark, SIMPLE,
        [{"name": "a", "value": 42}, {"name": "a", "value": "42"}, {"name": "a", "value": 42.0}, {"name": "a"},
         {"name": "a", "value": None}, {"name": 5, "value": 1}, {"value": 1}, {"name": None}, {"name": "a", "value": 4.5},
         "not json", "[1]", None, {"name": "a", "extra": 1}],
    )
    assert [g[0] and g[0]["value"] for g in got] == [42, 42, 42, 0, None, None, None, None, None, None, None, None, 0]
    assert got[6][1] == ["name: missing"] and got[4][1] == ["value: invalid"] and got[9][1] == ["not an object"]


def test_record_types(spark):
    base = {"source": {"name": "s", "url": "u"}, "collectedAt": "2024-01-01T00:00:00Z"}
    startup = {**base, "content": {"entityName": "X", "data": {"foundedYear": "2001"}}}
    got = check(spark, "STARTUP", [startup, {**startup, "recordType": "JOB"}, {**startup, "content": {"entityName": "X"}}, {**startup, "source": {"name": "s"}}])
    assert got[0][0]["schemaVersion"] == "1.0" and got[0][0]["recordType"] == "STARTUP"
    assert got[0][0]["content"]["data"]["foundedYear"] == 2001
    assert got[0][0]["collectedAt"] == datetime(2024, 1, 1)
    assert [g[1] for g in got[1:]] == [["recordType: invalid"], ["content.data: missing"], ["source.url: missing"]]
    product = {**base, "content": {"startupName": "X", "pricingModel": "PAID"}}
    got = check(spark, "PRODUCT", [product, {**base, "content": {"startupName": "X", "pricingModel": "cheap"}}])
    assert got[0][0] and got[1] == (None, ["content.pricingModel: invalid"])
    got = check(spark, "JOB", [{"content": {"date": 86400, "company": None}}, {"content": {}}])
    assert got[0][0]["content"] == {"company": None, "date": datetime(1970, 1, 2), "is_remote": False, "role_family": "Engineering"}
    assert got[0][0]["source"] is None and got[1][0] is None
    paper = {**base, "content": {"title": "t", "authors": ["a", "b"], "paper_url": "u", "published_date": "2024-01-01"}}
    got = check(spark, "RESEARCH_PAPER", [paper, {**paper, "content": {**paper["content"], "authors": [1]}}])
    assert got[0][0]["content"]["authors"] == ["a", "b"] and got[1][0] is None


def test_conform_splits(spark):
    df = spark.createDataFrame([(1, '{"name":"a"}'), (2, "{}")], "i int, j string")
    valid, rejected = R.conform(df, "j", SIMPLE)
    assert [(r.i, r.record.name) for r in valid.collect()] == [(1, "a")]
    assert [(r.i, r.errors) for r in rejected.collect()] == [(2, ["name: missing"])]


def test_record_type_choice():
    assert [R.record_type(t) for t in ("startup", "product", "ecommerce", "other")] == ["STARTUP", "PRODUCT", "ECOMMERCE_PRODUCT", "PRODUCT"]


def test_first_valid_by_tier(spark):
    ok = '{"name":"%s","value":%d}'
    rows = [
        (1, 0, 1, ok % ("test", 42), None), (1, 1, 1, ok % ("late", 1), None),
        (2, 0, 1, None, "boom"), (2, 1, 1, ok % ("fallback", 99), None),
        (3, 0, 1, None, "boom"), (3, 1, 1, "{}", None), (3, 2, 1, None, "rate_limit"),
        (4, 0, 1, None, "rate_limit"), (4, 0, 2, None, "rate_limit"), (4, 0, 3, ok % ("third", 3), None),
        (5, 0, 1, None, "rate_limit"), (5, 0, 2, None, "boom"), (5, 0, 3, ok % ("never", 3), None), (5, 1, 1, ok % ("next", 4), None),
        (6, 0, 1, None, "rate_limit"), (6, 0, 2, None, "rate_limit"), (6, 0, 3, None, "rate_limit"), (6, 0, 4, ok % ("no", 1), None),
    ]
    responses = spark.createDataFrame(rows, "req_id long, tier int, attempt int, json string, error string")
    requests = spark.range(1, 8).withColumnRenamed("id", "req_id")
    got = {r.req_id: r.record and (r.tier, r.record.name, r.record.value) for r in first_valid_by_tier(requests, responses, SIMPLE).collect()}
    assert got == {1: (0, "test", 42), 2: (1, "fallback", 99), 3: None, 4: (0, "third", 3), 5: (1, "next", 4), 6: None, 7: None}


def test_alive_tiers(spark):
    tiers = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "tier int, model string")
    some = spark.createDataFrame([(0, False), (1, True), (2, True)], "tier int, alive boolean")
    none = some.withColumn("alive", F.lit(False))
    assert sorted(r.model for r in alive_tiers(tiers, some).collect()) == ["b", "c"]
    assert sorted(r.model for r in alive_tiers(tiers, none).collect()) == ["a", "b", "c"]
