"""A corpus pipeline of five stages over ``documents``; each stage's rows are written and reread by the next.

Toxic documents go, repeated lines go, of near copies one document stays, documents that hold benchmark items
go, and what is left is mixed to the sources' target weights. All stages but the last return the columns of
``documents``. Empty and null texts pass every filter; so do rows without an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import catalog, contamination, line_dedup, minhash, mixing
from flowlake.llm.scratch import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; the model is fitted on the labelled documents of ``sf_dir``."""
    scored = catalog.toxicity_model(spark, sf_dir).scored(docs, into="__toxicity")
    return scored.where(F.col("__toxicity") < catalog.TOXIC_FROM).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand earlier in the corpus; documents that keep no word go."""
    return line_dedup.clean(docs, least_words=1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return minhash.without_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.Contamination(docs, benchmark).clean()


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, one row per pass, with ``pass, first_slot, taken``."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-duplicate documents", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("source mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: Similarity search, a learned model and a seeded schedule are beyond SQL; tests hold a brute-force version.
ORACLE_SQL = None
