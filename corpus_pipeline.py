"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

1. toxicity (operator 3): documents that the severity model calls toxic go.
2. near duplicates (operator 4; five words, likeness 0.8): one document of each group stays.
3. personal data (operator 2): entities become surrogates.
4. mixing (operator 10): documents as often as the mix of sources takes them.
5. packing (operator 7): pieces in sequences of 4096 ids.

All but the last return the columns of ``documents``. Stages 1, 3 and 5 cannot be expressed in SQL, so the whole has no SQL; the tests hold it
against plain Python instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import bottomk, packing, pareto, severity, surrogates
from tidemill.llm.queries import SURROGATE_KEY
from tidemill.session import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return severity.keep_clean(docs, severity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bottomk.keep_one_each(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(docs, key=SURROGATE_KEY).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pareto.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last is not written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
