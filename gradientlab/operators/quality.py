"""Checks on cleaned and merged tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import null_safe_join
from ..session import stage_table
from .community import sample_totals
from .reshape import count_by

T = TypeVar("T")


def null_census(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of NULLs per column as (column, n_null), from one pass over the data."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return one.unpivot([], [F.col(f"`{c}`") for c in columns], "column", "n_null")


def missing_members(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``a`` that do not occur in ``b``."""
    return null_safe_join(a.select(*keys).distinct(), b.select(*keys).distinct(), keys, "left_anti")


def merge_audit(dat: DataFrame, meta: DataFrame) -> DataFrame:
    """Four counts that should be 0: unknown sites both ways, missing treatment or relative cover."""
    keys = ["Region", "destSiteID"]
    by_site = dat.groupBy(*keys).agg(
        F.count_if(F.col("Treatment").isNull()).alias("t"), F.count_if(F.col("Rel_Cover").isNull()).alias("r"),
        F.lit(True).alias("in_data"),
    )
    both = null_safe_join(by_site, meta.select(*keys).distinct().withColumn("in_meta", F.lit(True)), keys, "full")
    names = ["sites_without_meta", "meta_without_data", "null_treatment", "null_rel_cover"]
    return both.agg(
        F.count_if(F.col("in_meta").isNull()).alias(names[0]), F.count_if(F.col("in_data").isNull()).alias(names[1]),
        F.coalesce(F.sum("t"), F.lit(0)).alias(names[2]), F.coalesce(F.sum("r"), F.lit(0)).alias(names[3]),
    ).unpivot([], names, "audit", "n")


def rows_per_treatment(dat: DataFrame) -> DataFrame:
    return count_by(dat, "Region", "destSiteID", "Treatment")


def total_cover_audit(df: DataFrame, keys: Sequence[str], below: float = 100.0) -> DataFrame:
    """Samples whose cover adds up to less than ``below``."""
    totals = sample_totals(df, keys, residual=False)
    return totals.select(*keys, F.col("sum_cover").alias("Total_Cover")).filter(F.col("Total_Cover") < below)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: the cause of growth in a join."""
    return count_by(df, *keys).filter(F.col("n") > 1)


def row_growth(steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Number of rows after each step of a derivation, as (step, name, n)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("name"), "n")
        for i, (name, df) in enumerate(steps)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- audits in the pass that writes -----------------------------------------

class Watch:
    """Metrics attached to frames and filled by the action that writes them, so an audit needs no pass of its own.

    ``on`` attaches aggregates to a frame, ``run`` runs an action over the frames watched since the last one.  A map
    stage that runs again after an executor is lost adds its rows a second time; where any stage of the action had more
    than one attempt, the aggregates are calculated anew from the frames.  The same is done where the optimizer removed
    a watched frame from the plan, as it may with an empty one.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.values: list[dict] = []
        self._waiting: list[tuple[Observation, DataFrame, list[Column]]] = []

    def on(self, df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
        seen = Observation()
        named = [column.alias(name) for name, column in metrics.items()]
        self._waiting.append((seen, df, named))
        return df.observe(seen, *named)

    def run(self, action: Callable[[], T]) -> T:
        """The result of ``action``; one dictionary per frame watched since the last run is added to ``values``."""
        context, group = self.spark.sparkContext, f"watch-{uuid.uuid4().hex}"
        kept = {k: context.getLocalProperty(k) for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}
        context.setJobGroup(group, kept["spark.job.description"] or "watched")
        try:
            result = action()
        finally:
            for key, value in kept.items():
                context.setLocalProperty(key, value)
        again = self._ran_again(group)
        for seen, df, named in self._waiting:
            found = None if again else _metrics(seen)
            self.values.append(found or df.agg(*named).first().asDict())
        self._waiting = []
        return result

    def _ran_again(self, group: str) -> bool:
        tracker = self.spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        stages = [tracker.getStageInfo(s) for job in jobs if job for s in job.stageIds]
        return any(stage is not None and stage.currentAttemptId > 0 for stage in stages)


def _metrics(seen: Observation) -> dict | None:
    """What was observed; None where the watched frame wasn't part of the plan that ran."""
    try:
        return seen.get
    except Py4JJavaError:  # a row without names: nothing was observed
        return None


def audited_write(df: DataFrame, write: Callable[[DataFrame], object], audits: Mapping[str, Column]) -> DataFrame:
    """Counts over ``df`` as (audit, n), taken by the one action in which ``write`` writes all of it."""
    watch = Watch(df.sparkSession)
    watched = watch.on(df, audits)
    watch.run(lambda: write(watched))
    return df.sparkSession.createDataFrame([(name, watch.values[0][name]) for name in audits], "audit string, n bigint")


def null_audits(columns: Sequence[str]) -> dict[str, Column]:
    """The counts of ``null_census`` for ``audited_write``."""
    return {c: F.count_if(F.col(f"`{c}`").isNull()) for c in columns}


def growth_of(
    source: DataFrame,
    steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]],
    write: Callable[[DataFrame], object],
    staged: Sequence[str] = (),
) -> DataFrame:
    """Rows after each step of a derivation, as (step, name, n), counted while ``write`` writes its end.

    A step is a function of the frame before it.  A step whose successor reads it more than once is named in
    ``staged``: it is written and counted by that, so that nothing before it runs twice.
    """
    watch, frame = Watch(source.sparkSession), source
    for i, (name, step) in enumerate(steps):
        end = i == len(steps) - 1
        frame = watch.on(step(frame), {"n": F.count(F.lit(1))})
        if end or name in staged:
            frame = watch.run(lambda df=frame, end=end, name=name: write(df) if end else stage_table(df, f"growth/{name}"))
    counts = [(i, name, found["n"]) for i, ((name, _), found) in enumerate(zip(steps, watch.values))]
    return source.sparkSession.createDataFrame(counts, "step int, name string, n bigint")


def plot_layout(df: DataFrame, rows: int | None = None, task_rows: int = 500_000) -> DataFrame:
    """Species by year table of every plot, with the plot title: the data behind turf maps.

    Hardly two records share plot, year and species, so adding them up where they lie would keep them all in memory beside
    what made them.  They are dealt out first, about ``task_rows`` to a task; ``rows`` is their number, if it is known, else
    they are counted.
    """
    keys = ["destSiteID", "destPlotID", "Year", "SpeciesName"]
    records = df.select(*keys, "Cover")
    tasks = max(1, -(-(records.count() if rows is None else rows) // task_rows))
    title = F.format_string("Site %s: plot %s", "destSiteID", "destPlotID")
    return records.repartition(tasks, *keys).groupBy(*keys).agg(F.sum("Cover").alias("Cover")).withColumn("title", title)
