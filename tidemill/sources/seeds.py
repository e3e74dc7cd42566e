"""The seed list names are resolved against."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

logger = logging.getLogger(__name__)

# The default seed entities, in the order that settles ties.
DEFAULT_SEEDS = (
    "OpenAI", "Anthropic", "DeepMind", "Mistral AI", "Cohere", "Hugging Face", "Perplexity", "Scale AI", "Midjourney",
    "Stability AI", "Meta AI", "Google AI", "xAI", "Inflection AI", "Databricks", "Runway", "Jasper AI", "Adept AI",
    "Character AI", "Together AI", "Replicate", "Anyscale", "Weights & Biases", "LangChain", "Pinecone", "Weaviate",
    "Galileo AI", "Snorkel AI", "Mosaic ML", "Lightning AI", "Aleph Alpha", "AI21 Labs", "Imbue", "Contextual AI",
    "Descript", "ElevenLabs", "Pika Labs", "Luma AI", "Synthesia", "Twelve Labs", "Tome", "Glean", "Vectara", "Qdrant",
    "Chroma", "LlamaIndex", "Fixie AI", "Dust", "Comet ML", "Superagent",
)


def load_seeds(spark: SparkSession, path: str | None = None, seeds: list[str] | None = None) -> DataFrame:
    """``seed_pos, seed`` from a JSON array file or a list, else the default seeds.

    A missing or broken file falls back to the defaults, as does an empty list; an empty list in a file does not.
    """
    if path:
        try:
            listed = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<string>").alias("names"))
            if not listed.filter("names is not null").isEmpty():
                return listed.select(F.posexplode("names").alias("seed_pos", "seed")).select(
                    F.col("seed_pos").cast("long").alias("seed_pos"), "seed"
                )
            logger.warning("seed file %s is no JSON array; using the defaults", path)
        except AnalysisException as error:
            logger.warning("seed file %s not readable (%s); using the defaults", path, error)
        return load_seeds(spark)
    names = list(seeds) if seeds else list(DEFAULT_SEEDS)
    return spark.createDataFrame(list(enumerate(names)), "seed_pos long, seed string")
