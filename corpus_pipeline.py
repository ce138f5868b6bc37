"""The corpus pipeline: filter, de-duplicate, decontaminate and mix ``documents``.

Each stage takes the rows its predecessor kept.  Every stage but the last
returns the columns of ``documents``; the last adds ``copy`` and
``shuffle_key``.  Stages treat nulls, ties, repeated rows, empty texts and
empty tables as their operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kalulu.llm import decontamination, mixing, simhash_dedup, suffix_dedup, toxicity
from kalulu.llm.common import checkpoint, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the grammar learns from their labels."""
    grammar = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.accept(docs, grammar, threshold=0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each SimHash component (3-word shingles, 2 bits)."""
    return simhash_dedup.one_of_each(docs, shingle=3, max_bits=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that occur earlier."""
    return suffix_dedup.suffix_dedup_texts(docs, length=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents by their source's rate, in shuffled order."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]

#: the grammar, the hashes and the byte spans are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each one's rows are checkpointed for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = checkpoint(docs)
    return docs
