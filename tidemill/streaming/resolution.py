"""Names resolved across polls: a name met in a later poll joins the representative that an earlier one made.

Two kinds of state live on between micro-batches. Keyed by name, a stateful operator remembers which names were met, so each is resolved once, however
often it comes again. Beside it lies the table of forms: every distinct form with its place and, for followers, whom it follows. A micro-batch
matches its new forms against the representatives in that table, groups the rest among themselves and adds its own part to the table. That is what
the sequential loop does when it goes on, so the polls together give what one batch of all their names gives, provided later polls carry
later places.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from tidemill.functions import fuzzy
from tidemill.operators.resolve import canonicalize, cluster
from tidemill.session import cut

_FORMS = "form string, pos long, lead_name string, ref_pos long, ref_name string, score int, batch_id int"
_MAPPING = "name string, canonical_name string, batch_id int"


class FirstMeeting(StatefulProcessor):
    """Lets a name through when it is met for the first time, with its earliest place in that micro-batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._met = handle.getValueState("met", StructType([StructField("pos", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = min(int(frame["pos"].min()) for frame in rows)
        if not self._met.exists():
            self._met.update((first,))
            yield pd.DataFrame({"pos": [first], "name": [key[0]]})

    def close(self) -> None:
        pass


def first_meetings(names: DataFrame) -> DataFrame:
    """A stream of ``pos, name``, each name once across all micro-batches; rows without a name are left out.

    State is kept by the RocksDB store, which ``spark.sql.streaming.stateStore.providerClass`` has to name.
    """
    met = names.select(F.col("pos").cast("long").alias("pos"), "name").filter("name is not null")
    return met.groupBy("name").transformWithStateInPandas(
        statefulProcessor=FirstMeeting(), outputStructType="pos long, name string", outputMode="Append", timeMode="None"
    )


def _parts(spark: SparkSession, base: str, name: str, schema: str, before: int) -> DataFrame:
    """What the micro-batches before one have written."""
    try:
        return spark.read.schema(schema).parquet(f"{base}/{name}").filter(F.col("batch_id") < before)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def resolve_increment(
    names: DataFrame, seeds: DataFrame, known: DataFrame, threshold: int = 85, scorer: str = "wratio", clean: bool = True, first_slice: int = 1024
) -> tuple[DataFrame, DataFrame]:
    """``(forms, mapping)`` that distinct new names ``pos, name`` add to the ``known`` forms."""
    matched = cut(canonicalize(names, seeds, "name", threshold, scorer, clean).withColumn("form", fuzzy.form(F.col("name"), clean)))
    is_open = (F.col("canonical_name") == F.col("name")) & (F.col("form") != "")
    met = matched.filter(is_open).groupBy("form").agg(F.min("pos").alias("pos"), F.min_by("name", "pos").alias("lead_name"))
    fresh = cut(met.join(known.select("form"), "form", "left_anti"))
    leaders = known.filter("ref_pos is null").select("pos", "form", "lead_name")
    followed = cluster(fresh.select("pos", "form"), threshold, scorer, first_slice, leaders.select("pos", "form"))
    every = leaders.select("pos", "lead_name").unionByName(fresh.select("pos", "lead_name"))
    refs = every.select(F.col("pos").alias("ref_pos"), F.col("lead_name").alias("ref_name"))
    score = F.bround("score", 0).cast("int").alias("score")
    added = fresh.join(followed, "pos", "left").join(refs, "ref_pos", "left").select("form", "pos", "lead_name", "ref_pos", "ref_name", score)
    added = cut(added)
    names_of = known.select("form", "lead_name", "ref_name").unionByName(added.select("form", "lead_name", "ref_name"))
    target = names_of.select(F.col("form").alias("open_form"), F.coalesce("ref_name", "lead_name").alias("merged_name"))
    joined = matched.withColumn("open_form", F.when(is_open, F.col("form"))).join(target, "open_form", "left")
    return added, joined.select("name", F.coalesce("merged_name", "canonical_name").alias("canonical_name"))


def start_resolution(names: DataFrame, seeds: DataFrame, base: str, checkpoint: str, trigger: dict | None = None, **match):
    """Resolve a stream of ``pos, name`` into ``base/forms`` and ``base/mapping``; ``mapping`` reads the latter.

    Every micro-batch overwrites its own part and reads only earlier ones, so one that is run again after a failure changes nothing. The default trigger
    polls once: it takes all that has landed and ends.
    """
    base = base.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = _parts(spark, base, "forms", _FORMS, batch_id).drop("batch_id")
        forms, rows = resolve_increment(cut(batch), seeds, known, **match)
        # The mapping first: the forms of a batch that never finished are written again as they were.
        rows.write.mode("overwrite").parquet(f"{base}/mapping/batch_id={batch_id}")
        forms.write.mode("overwrite").parquet(f"{base}/forms/batch_id={batch_id}")

    return (
        first_meetings(names).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def mapping(spark: SparkSession, base: str) -> DataFrame:
    """``name, canonical_name`` of every name met so far."""
    return _parts(spark, base.rstrip("/"), "mapping", _MAPPING, 2**31 - 1).drop("batch_id")
