"""The daily build by increments (K1-K6, A1-A9 over batches).

A batch of pages is loaded, flattened, enriched, joined and counted on its own;
what earlier batches gave stays as it is.  Every table is a ``BatchTable``, and
each step commits under the batch's name, so a load that is run twice, or again
after it was killed anywhere, gives the tables of one run.

    archive (keyed merge) -> landing, fact rows of the batch -> new salary,
    skill and title rows -> wide rows of the batch -> day-level partials

The marts are sums over the partials.  Typed rows older than the first archived
page (the cut-off) are a batch of their own, which is replaced if a batch brings
an earlier page.  A job id keeps the dimension rows of the first batch that had
it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MONTH_COL, month_of
from ..operators import fact as fact_ops
from ..operators import incremental, partials, public, salary, skills, titles, wide
from ..sources.batches import BatchTable
from .pipeline import Inputs, archive_batch

TYPED = "typed"
#: What a batch adds: how it is counted, its partition column, how batches merge.
PARTIALS = {
    "skills": (partials.skill_partials, MONTH_COL, partials.merged),
    "sizes": (partials.size_partials, MONTH_COL, partials.merged),
    "pay": (partials.pay_partials, MONTH_COL, partials.merged),
    "public": (public.stored_survivors, public.PREFIX,
               lambda stored: public.merged_survivors(stored).withColumn(public.PREFIX, F.lower(F.left(F.hex("_key"), F.lit(2))))),
}


class Increments:
    """The tables of the incremental build below ``out``."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark = spark
        self.archive = BatchTable(spark, f"{out}/archive", [MONTH_COL])
        self.landing = BatchTable(spark, f"{out}/landing", [MONTH_COL])
        self.fact = BatchTable(spark, f"{out}/fact", [MONTH_COL])
        self.dimensions = {name: BatchTable(spark, f"{out}/{name}") for name in ("salary", "skills", "titles")}
        self.wide = BatchTable(spark, f"{out}/wide", [MONTH_COL])
        self.partials = {name: BatchTable(spark, f"{out}/partials/{name}", [part]) for name, (_, part, _) in PARTIALS.items()}

    # ----------------------------------------------------------------- load
    def add(self, batch: str, inputs: Inputs, *, title_labels=None) -> None:
        """Load a batch of pages and all that follows from it."""
        archive_batch(self.archive, self.landing, batch, inputs.pages)
        pages = self.archive.read([batch])
        # a page has rows of its own: only the batch's pages are read
        self._unit(batch, fact_ops.with_flags(fact_ops.json_postings(pages)), inputs, title_labels)
        cutoff = self.archive.read().agg(F.min("search_time").alias("t")).first().t
        name = f"{TYPED}-{'none' if cutoff is None else cutoff.isoformat().replace(':', '')}"
        older = [b for b in self.fact.batches() if b.startswith(f"{TYPED}-") and b != name]
        typed = fact_ops.with_flags(fact_ops.typed_rows(inputs.typed, F.lit(cutoff).cast("timestamp_ntz")))
        self._unit(name, typed, inputs, title_labels, replaces=older)

    def _unit(self, unit: str, rows: DataFrame, inputs: Inputs, title_labels, replaces=()) -> None:
        self.fact.append(unit, rows.withColumn(MONTH_COL, month_of("search_time")), replaces=replaces)
        fact = self.fact.read([unit])
        if fact is None:  # replaced since
            return
        fact = fact.drop(MONTH_COL)
        dims = self.dimensions
        given = {"skills": inputs.skill_dim, "titles": inputs.title_dim}
        for name, made in (("salary", salary.salary_dimension), ("skills", skills.skills_dimension)):
            if not dims[name].has(unit):
                stored = dims[name].read()
                known = given.get(name) if stored is None else stored
                new = made(fact if known is None else incremental.new_keys(fact, known, "job_id"))
                if known is not None:  # the columns of the table; a given one is its first rows
                    new = (known if stored is None else known.limit(0)).unionByName(new, allowMissingColumns=True)
                dims[name].append(unit, new, key="job_id")
        if not dims["titles"].has(unit):
            stored = dims["titles"].read()
            known = given["titles"] if stored is None else stored
            kw = {} if title_labels is None else {"labels": title_labels}
            new = titles.classify_titles(fact, **kw) if known is None else titles.new_title_labels(fact, known, **kw)
            if stored is None and known is not None:
                new = known.unionByName(new)
            dims["titles"].append(unit, new, key="job_title")
        if not self.wide.has(unit):
            rows = wide.build_wide(fact, dims["skills"].read(), inputs.country, dims["salary"].read(), dims["titles"].read())
            self.wide.append(unit, rows.withColumn(MONTH_COL, month_of("search_time")), replaces=replaces)
        for name, (counted, *_) in PARTIALS.items():
            if not self.partials[name].has(unit):
                self.partials[name].append(unit, counted(self.wide.read([unit]).drop(MONTH_COL)), replaces=replaces)

    def compact(self, batch: str) -> None:
        """Merge the partials of all batches into one."""
        for name, (*_, merged) in PARTIALS.items():
            table = self.partials[name]
            if not table.has(batch):
                table.compact(batch, merged(table.read()).select(*table.read().columns))

    # ---------------------------------------------------------------- marts
    def marts(self, as_of) -> dict[str, DataFrame]:
        """The marts, lazily, from the partials alone."""
        part = {name: table.read() for name, table in self.partials.items()}
        return {"skills": partials.skills_by_timeframe(part["skills"], part["sizes"], as_of),
                "slicer": partials.title_country_counts(part["sizes"]),
                "grains": partials.skill_grains(part["skills"], part["sizes"], as_of),
                "skill_trend": partials.skill_trend(part["skills"], part["sizes"]),
                "skill_pay": partials.skill_pay(part["pay"], as_of),
                "public": public.finished(public.merged_survivors(part["public"])),
                **partials.health(part["sizes"])}
