"""The corpus pipeline: stages of the training-data operators over ``documents``.

Each stage is a function of (spark, docs, sf_dir) and works on all that the one
before kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import common, jaccard, linededup, mixing, pack, toxicity
from hirelake.llm.queries import OTHERS, TARGETS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 5 rejects go."""
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(toxicity.threshold() == 0).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go (operator 10), and with them documents
    that lost lines and have none left but blank ones."""
    new = {"text": F.col("cleaned_text"),
           "n_chars": F.when(F.col("n_dropped") > 0, F.length("cleaned_text").cast("long")).otherwise(F.col("n_chars"))}
    kept = linededup.drop_recurring(docs).where((F.col("n_dropped") == 0) | F.col("cleaned_text").rlike(r"\S"))
    return kept.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays (operator 8)."""
    return jaccard.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mixture (operator 2)."""
    mixed = mixing.mix(docs, TARGETS, OTHERS)
    return (mixed.repartitionByRange(common.partitions(spark), "slot", "place").sortWithinPartitions("slot", "place")
            .select("row.*"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences (operator 1), along the curve within
    windows of the mixture's slots."""
    return pack.pack(docs, weights=mixing.shares(TARGETS, OTHERS))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The first stage learns its scores, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again."""
    scratch = common.Scratch(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
