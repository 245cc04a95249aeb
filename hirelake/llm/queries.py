"""Registered queries of the operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import (common, forest, hardneg, idstore, jaccard, katz, licences, linededup, mixing, nndescent, pack, pii,
                          toxicity, turns)

#: Target shares of sources; all others share one.
TARGETS, OTHERS = {"src0": 25.0, "src1": 15.0, "src2": 10.0, "src3": 5.0}, 45.0


def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack.pack(common.table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op2_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return mixing.mix(docs.select("doc_id", "source", "text"), TARGETS, OTHERS).select(
        "row.doc_id", "row.source", "class", "block", "slot", "place")


def op3_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(common.table(spark, sf_dir, "embeddings"))


def op4_hashed_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    folder = common.Scratch(spark, "idstore").root
    idstore.write(docs, folder)
    keys = docs.groupBy("doc_id").count().select(
        "doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("occurrence"))
    return idstore.fetch(spark, folder, keys).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("row.doc_id", common.in_fold("row.doc_id", 3, 1).alias("held_out"), "score",
                         toxicity.threshold().alias("predicted"), F.size("hits").alias("n_hits"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.nearest(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.summary(licences.scan(common.table(spark, sf_dir, "documents")))


def op8_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(common.table(spark, sf_dir, "documents"))


def op9_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(common.table(spark, sf_dir, "documents"), common.in_fold("doc_id", 7, 2))


def op10_template_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.drop_recurring(common.table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", "emptied", "cleaned_text")


def op11_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(common.table(spark, sf_dir, "documents")))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = common.table(spark, sf_dir, "conversations")
    return turns.report(conversations, turns.damage(conversations))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hardneg.relabelled(common.table(spark, sf_dir, "embeddings"))
    return hardneg.mine(vectors, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hilbert_packing": op1_hilbert_packing,
    "op2_pfair_mixing": op2_pfair_mixing,
    "op3_projection_forest": op3_projection_forest,
    "op4_hashed_id_store": op4_hashed_id_store,
    "op5_lexicon_toxicity": op5_lexicon_toxicity,
    "op6_nn_descent": op6_nn_descent,
    "op7_licence_scan": op7_licence_scan,
    "op8_chosen_path_join": op8_chosen_path_join,
    "op9_katz_backoff": op9_katz_backoff,
    "op10_template_line_dedup": op10_template_line_dedup,
    "op11_boosted_pii": op11_boosted_pii,
    "op12_turn_repair": op12_turn_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op8_chosen_path_join": jaccard.ORACLE_SQL,
    "op10_template_line_dedup": linededup.ORACLE_SQL,
}
