"""A training corpus from ``documents``: the stages that one command runs after another."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm import line_dedup, near_dedup, retrieval_packing, source_mixing, toxicity_neighbours
from coffer.llm.common import labels
from coffer.session import shared_dir

#: Words of a shingle in the near-duplicate stage.
SHINGLE_WORDS = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples do not make them toxic; learnt from the labels of ``sf_dir``."""
    return toxicity_neighbours.without_toxic(docs, toxicity_neighbours.learn(docs, labels(spark, sf_dir)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs, and their new lengths; a document that was nothing else goes."""
    return line_dedup.without_copies(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.one_of_each(docs, SHINGLE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the schedule; a source that runs dry leaves the rest in their proportions."""
    return source_mixing.in_order(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of related documents, with their token ids and the slot of the window.

    The slots are those of the stage before, which kept every row: they follow from the rows alone.
    """
    return retrieval_packing.pack(docs, order=source_mixing.slots_of(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("packing", pack_windows),
]

#: The stages learn, sketch and tokenise; SQL cannot express them. A test holds them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, f"pipeline/{uuid.uuid4().hex}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
