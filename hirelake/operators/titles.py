"""T2 title standardiser and A12 title counts.

Each new distinct title is scored against a short, fixed list of labels.
The default scorer is token overlap (shared lower-case word tokens), ties
going to the earlier label; a title sharing no token with any label is
dropped, as a failed classification is in the reference.  With a fixed label
list the scoring is a projection (one expression per label): no join, no
shuffle beyond the distinct.  A model can be plugged in as a pandas scorer,
run batch-wise with ``mapInPandas``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keywords import TITLE_LABELS


def title_counts(fact: DataFrame, title: str = "job_title") -> DataFrame:
    """Distinct titles with COUNT(title) (0 for the NULL title)."""
    return fact.groupBy(title).agg(F.count(title).alias("job_title_count"))


# Common abbreviations in posted titles, expanded before scoring (a design
# choice of the overlap scorer, not reference data).
ABBREVIATIONS = {"sr": "senior", "snr": "senior", "engr": "engineer", "eng": "engineer",
                 "ml": "machine learning", "sw": "software", "sci": "scientist"}


def normalise_title(c: Column) -> Column:
    """Lower-case, non-alphanumerics to single spaces, abbreviations expanded."""
    t = F.concat(F.lit(" "), F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "), F.lit(" "))
    for short, full in ABBREVIATIONS.items():
        t = F.regexp_replace(t, f" {short}(?= )", f" {full}")
    return F.trim(t)


def title_tokens(c: Column) -> Column:
    return F.array_remove(F.split(normalise_title(c), " "), "")


def _label_tokens(label: str) -> list[str]:
    return sorted({w for w in re.split("[^a-z0-9]+", label.lower()) if w})


def _best_label(tok: Column, labels: Sequence[str]) -> Column:
    """(score, neg_pos, label) of the best label by token overlap, earliest on ties."""
    scored = [F.struct(F.size(F.array_intersect(tok, F.array(*[F.lit(w) for w in _label_tokens(lab)])))
                       .alias("score"),
                       F.lit(-i).alias("neg_pos"), F.lit(lab).alias("label"))
              for i, lab in enumerate(labels)]
    return F.greatest(*scored) if len(scored) > 1 else scored[0]


def classify_titles(titles: DataFrame, title: str = "job_title", *,
                    labels: Sequence[str] = TITLE_LABELS,
                    scorer: Callable | None = None) -> DataFrame:
    """(job_title, job_title_clean) for each distinct non-NULL title that got a label.

    ``scorer(pd.Series[str], labels) -> pd.Series[str|None]`` replaces the
    default overlap scorer; it runs in Arrow batches on the executors."""
    distinct = titles.select(F.col(title).alias("job_title")).where(F.col("job_title").isNotNull()).distinct()
    if scorer is None:
        # Step by step, and by explode rather than a filter: a filter would be pushed
        # below the steps and work them all out again.
        best = (distinct.select("job_title", title_tokens(F.col("job_title")).alias("_tok"))
                .select("job_title", _best_label(F.col("_tok"), labels).alias("_best")))
        return best.select("job_title", F.explode(F.when(F.col("_best.score") > 0, F.array("_best.label"))).alias("job_title_clean"))
    else:
        labels = list(labels)

        def run(batches):
            for pdf in batches:
                pdf = pdf.copy()
                pdf["job_title_clean"] = scorer(pdf["job_title"], labels)
                yield pdf

        out = distinct.mapInPandas(run, "job_title string, job_title_clean string")
    return out.where(F.col("job_title_clean").isNotNull())


def new_title_labels(fact: DataFrame, title_dim: DataFrame, **kw) -> DataFrame:
    """T3 for titles: label only titles without a label yet (J5), rows to append."""
    counts = title_counts(fact)
    todo = (counts.join(title_dim.select("job_title", "job_title_clean"), "job_title", "left")
            .where(F.col("job_title_clean").isNull()).select("job_title"))
    return classify_titles(todo, "job_title", **kw)
