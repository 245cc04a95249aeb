"""A learned title classifier (multinomial naive Bayes over words and pairs
of words), trained and applied as Spark jobs.

Training counts the words of labelled titles per label: one shuffle of (word,
label) counts, combined on the map side, gives a table with a row per word
that holds its weight for each label.  Labels are a short, fixed list (a
parameter), so a word's weights are one array.  The model is that table and a
row of numbers per label; both are stored and loaded as tables.

Scoring joins the words of titles with the table (an equi-join on the word;
a word that a third of all titles share meets one model row, which a skew split
divides) and adds the weights per title.  Words that training has not seen say
nothing; a title of such words only gets no label, as a failed classification
does in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from .titles import title_tokens

#: Scores are compared at this many decimals: sums of doubles depend on their order.
DECIMALS = 9


def grams(title: Column) -> Column:
    """Words and pairs of neighbouring words of a title, with repetitions."""
    def pairs(words):
        return F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                           lambda w, i: F.concat(F.get(words, i), F.lit(" "), w))

    return F.get(F.transform(F.array(title_tokens(title)), lambda words: F.concat(words, pairs(words))), F.lit(0))


@dataclass
class TitleModel:
    """``words``: (gram, weights) with ln(count + 1) by label; ``labels``:
    (position, label, titles, base, unseen), where base is the logarithm of the
    label's share and unseen that of a word's share without a count."""

    words: DataFrame
    labels: DataFrame

    def save(self, path: str) -> None:
        sinks.write_table(self.words, f"{path}/words")
        sinks.write_table(self.labels, f"{path}/labels")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TitleModel":
        return TitleModel(spark.read.parquet(f"{path}/words"), spark.read.parquet(f"{path}/labels"))


def fit(titles: DataFrame, labels: Sequence[str], path: str, *, title: str = "job_title", label: str = "job_title_clean") -> TitleModel:
    """Train on labelled titles (distinct pairs; labels outside ``labels`` are
    left out), store the model below ``path`` and return the stored one.

    Smoothing adds one to each count, over all words seen in training."""
    spark = titles.sparkSession
    places = list(labels)
    known = (titles.select(F.col(title).alias("job_title"), F.col(label).alias("label"))
             .where(F.col("job_title").isNotNull() & F.col("label").isin(places)).distinct())
    counts = (known.select("label", F.explode(grams(F.col("job_title"))).alias("gram"))
              .groupBy("gram", "label").agg(F.count(F.lit(1)).alias("n")))
    sinks.write_table(counts.groupBy("gram").agg(*(F.coalesce(F.sum(F.when(F.col("label") == lab, F.col("n"))), F.lit(0)).alias(f"n{i}")
                                                    for i, lab in enumerate(places))), f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    n = [F.col(f"n{i}") for i in range(len(places))]
    words = counts.select("gram", F.array(*(F.log(c + 1) for c in n)).alias("weights"))
    totals = counts.agg(F.count(F.lit(1)).alias("words"), F.array(*(F.sum(c) for c in n)).alias("sums"))
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("titles"))
    # one row per label of a fixed list, and one row of totals: bounded by construction
    rows = spark.range(len(places)).select(F.col("id").cast("int").alias("position"),
                                           F.element_at(F.array(*(F.lit(x) for x in places)), (F.col("id") + 1).cast("int")).alias("label"))
    whole = known.agg(F.count(F.lit(1))).scalar()
    # a label without titles can't be given
    numbered = (rows.join(sizes, "label").join(F.broadcast(totals))
                .select("position", "label", "titles", F.log(F.col("titles") / whole).alias("base"),
                        (-F.log(F.get("sums", F.col("position")) + F.col("words"))).alias("unseen")))
    model = TitleModel(words, numbered)
    model.save(path)
    return TitleModel.load(spark, path)


def score(titles: DataFrame, model: TitleModel, *, title: str = "job_title") -> DataFrame:
    """(job_title, job_title_clean, n_known, score): the best label of each
    distinct title with a known word, and its logarithmic weight.  Ties go to the
    earlier label."""
    size = len(model.words.select("weights").head(1)[0].weights) if model.words.head(1) else 0
    distinct = titles.select(F.col(title).alias("job_title")).where(F.col("job_title").isNotNull()).distinct()
    found = distinct.select("job_title", F.explode(grams(F.col("job_title"))).alias("gram")).join(model.words, "gram")
    sums = found.groupBy("job_title").agg(F.count(F.lit(1)).alias("n_known"), *(
        F.sum(F.get("weights", F.lit(i))).alias(f"w{i}") for i in range(size)))
    at = {r.position: r for r in model.labels.collect()}  # one row per label of a fixed list
    options = [F.struct(F.round(F.col(f"w{i}") + F.col("n_known") * r.unseen + r.base, DECIMALS).alias("score"),
                        F.lit(-i).alias("neg_pos"), F.lit(r.label).alias("label")) for i, r in sorted(at.items())]
    if not options:
        return distinct.select("job_title", F.lit("").alias("job_title_clean"), F.lit(0).cast("long").alias("n_known"),
                               F.lit(0.0).alias("score")).where(F.lit(False))
    best = F.greatest(*options) if len(options) > 1 else options[0]
    return sums.select("job_title", "n_known", best.alias("_best")).select(
        "job_title", F.col("_best.label").alias("job_title_clean"), "n_known", F.col("_best.score").alias("score"))


def agreement(predicted: DataFrame, labelled: DataFrame) -> DataFrame:
    """(titles, right, accuracy) of predicted labels (job_title,
    job_title_clean) on labelled titles; a title without a label is wrong."""
    said = predicted.select("job_title", F.col("job_title_clean").alias("_said"))
    both = labelled.select("job_title", "job_title_clean").distinct().join(said, "job_title", "left")
    right = F.count_if(F.coalesce(F.col("_said") == F.col("job_title_clean"), F.lit(False)))
    return both.agg(F.count(F.lit(1)).alias("titles"), right.alias("right")).withColumn(
        "accuracy", F.try_divide("right", "titles"))
