"""Small tables for the operators: nulls in any column, empty and long texts,
ties, repeated rows, columns with names that operators use themselves."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMOKE = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("row", "part", "before", "ids", "bucket", "key", "node", "component", "a", "b", "u", "v", "n", "block", "word",
           "score", "label", "start", "length", "position", "line", "class_id", "rank", "count")


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeiklmnorst") for _ in range(draw.randint(2, 9))) for _ in range(n))


def awkward_rows():
    long = prose(1, 6000)
    near = prose(2, 300).split()
    rows = [(i, prose(100 + i, 5 + 7 * i), "en", f"src{i % 3}", 1) for i in range(12)]
    rows += [(20, None, "en", "src0", None), (21, "", None, None, 0), (22, " \n\t ", "en", "src0", 4), (23, "one two", "en", "src1", 7)]
    rows += [(30, long, "en", "src0", 1), (31, long, "en", "src0", 1), (32, long, "fr", "src2", 1)]
    rows += [(40, " ".join(near), "en", "src0", 1), (41, " ".join(near[:150] + ["changed"] + near[151:]), "en", "src1", 1)]
    rows += [(50, "Größe naïve İstanbul Σίσυφος 東京 😀 don't <|endoftext|> x2 a b ćd", "de", "src0", 1)]
    rows += [(60, "same row", "en", "src0", 1)] * 3 + [(None, "no id", "en", "src0", 1)] * 2
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(awkward):
    from pyspark.sql import functions as F

    return awkward.select("*", *(F.lit("x").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def smoke_docs(spark):
    return spark.read.parquet(f"{SMOKE}/documents.parquet")
