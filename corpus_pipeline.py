"""A training corpus in five stages, each one of the operators of ``sparsepages.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparsepages.llm.common import scratch, table
from sparsepages.llm.decontaminate import without_contaminated
from sparsepages.llm.mixing import mixed
from sparsepages.llm.neardup import without_near_duplicates
from sparsepages.llm.queries import quality_weights
from sparsepages.llm.tokenfile import read_tokens, write_tokens
from sparsepages.llm.toxicity import train, without_toxic
from sparsepages.llm.vocab import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the weights are learned from the labels of ``docs``."""
    return without_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked at five words and 80 %."""
    return without_near_duplicates(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs, quality_weights(spark, sf_dir))


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus; their documents, read back."""
    path = scratch(spark, "corpus-tokens")
    write_tokens(docs, vocabulary("byte_bpe_50k.json"), path)
    return read_tokens(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_files),
]

ORACLE_SQL = None  # scores, minhashes, keys and token ids have no SQL form; tests compare the stages with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return made
        place = scratch(spark, f"stage-{k}")
        made.write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
