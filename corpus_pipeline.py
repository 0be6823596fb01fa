"""A corpus pipeline made of the numbered operators. Each stage works on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmart.llm import decontaminate, jaccard, mixing, shards, toxicity
from eventmart.llm.queries import word_tokenizer
from eventmart.llm.ship import ship
from eventmart.llm.storage import materialize
from eventmart.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.keep_clean(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents stays, the one with the least doc_id."""
    ship(spark)
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources meet their targets."""
    return mixing.repeat_rows(docs, mixing.mix_sources(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, and what is read back from them."""
    path = shared_folder(ship(spark), "pipeline-shards")
    shards.write_shards(docs, path, word_tokenizer(), end_id=1)
    return shards.read_digests(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: The stages learn models and encode subwords, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
