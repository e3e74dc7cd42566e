"""One query per operator: ``opN_<name>(spark, sf_dir)`` applies it to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import bottomk, collocations, crosspolytope, cws, k2treap, kneser_ney, linmax, main_text, packing, pareto, severity, surrogates, token_file


#: The queries' own key, so that reruns agree; a user keeps theirs secret.
SURROGATE_KEY = "queries"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return main_text.extract(pages, main_text.fit(pages))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), key=SURROGATE_KEY)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return severity.score(docs, severity.fit(docs, _table(spark, sf_dir, "labels")))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.encode_and_read(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linmax.count_tokens(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_vectors(_table(spark, sf_dir, "embeddings"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.compare_edited(_table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto.mix(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return kneser_ney.predict(docs, kneser_ney.fit(docs))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k2treap.rank_all(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
