"""One entity across record types: ids that follow from names, and a link record for every name a record type uses."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions import fuzzy
from tidemill.operators.filters import instant
from tidemill.operators.resolve import resolve_batch
from tidemill.session import cut, numbered

#: The space that ids of names are made in.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_DNS, "tidemill")


def name_uuid(name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """The version 5 UUID of a name, as ``uuid.uuid5`` gives it; null for a null name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    parts = [F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12)]
    return F.concat_ws("-", *parts)


def seed_id(seed: Column) -> Column:
    """``seed_`` and the seed's words in lower case, joined by underscores."""
    return F.concat(F.lit("seed_"), F.array_join(fuzzy.tokens(fuzzy.form(seed)), "_"))


def link_records(
    names: DataFrame, seeds: DataFrame, as_of, threshold: int = 85, scorer: str = "wratio", clean: bool = True, first_slice: int = 1024
) -> DataFrame:
    """Links of ``names(entity_type, name)``, the names that all record types use, resolved together.

    One row per type and name: ``entity_type, raw_name, canonical_id, canonical_name, match_score, n_records, linked_at``. A name of a seed gets the seed's id.
    Other names are taken in the order of their forms, so that the same names give the same groups whatever order and batches they came in; a
    group's id follows from the form of its first name. Names without a form (null, empty, marks only) link to nothing and have no row.
    """
    counted = names.filter(F.col("name").isNotNull()).groupBy("entity_type", "name").agg(F.count("*").alias("n_records"))
    counted = cut(counted.withColumn("_form", fuzzy.form(F.col("name"), clean)).filter("_form <> ''"))
    distinct = counted.select("name", "_form").distinct()
    resolved = cut(resolve_batch(numbered(distinct, "_form", "name").select("pos", "name"), seeds, threshold, scorer, clean, first_slice))
    joined = counted.join(resolved, "name")
    by_seed = F.col("canonical_name") != F.col("name")
    known = seeds.select(F.col("seed").alias("_seed")).distinct()
    target = F.when(by_seed, F.col("canonical_name")).otherwise(F.coalesce("merged_name", "name"))
    joined = joined.withColumn("canonical", target).join(known, F.col("canonical") == F.col("_seed"), "left")
    lead = fuzzy.form(F.col("canonical"), clean)
    return joined.select(
        "entity_type", F.col("name").alias("raw_name"),
        F.when(F.col("_seed").isNotNull(), seed_id(F.col("canonical"))).otherwise(name_uuid(lead)).alias("canonical_id"),
        F.col("canonical").alias("canonical_name"),
        F.when(by_seed, F.col("match_score")).otherwise(F.coalesce("merged_score", F.lit(100))).cast("int").alias("match_score"),
        "n_records", instant(as_of).alias("linked_at"),
    )

