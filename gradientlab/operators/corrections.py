"""Raw-survey corrections and roll-ups that run before the common community steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import (
    na_if,
    null_safe_join,
    pmin,
    pooled_mean,
    ratio,
    row_sum,
    sum_strict,
    sum_zero,
    to_number,
)
from ..functions.text import decimal_comma
from .reshape import gather


# -- sampling effort and observers ------------------------------------------

def correct_effort(
    df: DataFrame,
    usable: str = "notbad",
    value: str = "cover",
    min_usable: int = 10,
    full: int = 25,
    cap: float = 80.0,
) -> DataFrame:
    """Scale cover to the full number of sub-plots, drop trampled samples, cap the result."""
    scaled = pmin(F.col(value) * F.lit(float(full)) / F.col(usable), cap)
    return df.filter(F.col(usable) > min_usable).withColumn(value, scaled)


def correct_observer(
    df: DataFrame,
    factors: Mapping[str, float],
    recorder: str = "recorder",
    value: str = "cover",
    unknown: str = "unknown botanist",
) -> DataFrame:
    """Name missing recorders and multiply the cover of biased ones."""
    who = F.coalesce(F.col(recorder), F.lit(unknown))
    factor = F.lit(1.0)
    for name, f in factors.items():
        factor = F.when(who == name, F.lit(float(f))).otherwise(factor)
    return df.withColumns({recorder: who, value: F.col(value) * factor})


def low_samples(
    totals: DataFrame, keys: Sequence[str], total: str, reference: str, below: float
) -> DataFrame:
    """Distinct keys of samples whose summed cover is low against an independent estimate."""
    return totals.filter(ratio(total, reference) < F.lit(below)).select(*keys).distinct()


def scale_flagged(
    df: DataFrame, flagged: DataFrame, keys: Sequence[str], factor: float, value: str = "cover"
) -> DataFrame:
    """Multiply the value of rows whose key is in ``flagged``."""
    marks = flagged.select(*keys).distinct().withColumn("__hit", F.lit(True))
    joined = null_safe_join(df, marks, list(keys))
    value_col = F.when(F.col("__hit"), F.col(value) * F.lit(float(factor))).otherwise(F.col(value))
    return joined.withColumn(value, value_col).select(*df.columns)


def flag_members(df: DataFrame, keys: Mapping[str, str] | Sequence[str], members: DataFrame, out: str) -> DataFrame:
    """Boolean column telling whether the composite key of a row occurs in ``members``."""
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    marks = members.select(*pairs.values()).distinct().withColumn("__hit", F.lit(True))
    joined = null_safe_join(df, marks, pairs)
    return joined.withColumn(out, F.coalesce("__hit", F.lit(False))).select(*df.columns, out)


@dataclass(frozen=True)
class Fix:
    """A correction of the cover of one turf in one year, for one species or all."""

    turf: str
    year: int
    op: str  # "set" or "times"
    arg: float
    species: str | None = None


def apply_point_fixes(
    df: DataFrame,
    fixes: Sequence[Fix],
    turf: str = "turfID",
    year: str = "year",
    species: str = "species",
    value: str = "cover",
) -> DataFrame:
    """Apply hand-made corrections in order."""
    out = F.col(value).cast("double")
    for fix in fixes:
        hit = (F.col(turf) == fix.turf) & (F.col(year) == fix.year)
        if fix.species is not None:
            hit = hit & (F.col(species) == fix.species)
        new = F.lit(float(fix.arg)) if fix.op == "set" else out * F.lit(float(fix.arg))
        out = F.when(hit, new).otherwise(out)
    return df.withColumn(value, out)


def pool_observers(
    df: DataFrame,
    group: Sequence[str],
    observers: Sequence[str],
    out: str = "Cover",
    missing: Sequence[str] = ("NF", "§"),
) -> DataFrame:
    """Mean over the readings of all observers in a group, put on each of its rows.

    Readings are texts with decimal commas or dashes and missing-value tokens.
    """
    cleaned = df.withColumns({
        c: to_number(F.translate(na_if(F.col(c).cast("string"), *missing), ",-", "..")) for c in observers
    })
    means = cleaned.groupBy(*group).agg(pooled_mean(*observers).alias(out)).filter(F.col(out).isNotNull())
    return null_safe_join(cleaned, means, list(group), "inner").select(*df.columns, out)


# -- counts, quadrats, biomass ----------------------------------------------

def _drop_suffix(name: str) -> F.Column:
    return F.regexp_replace(name, r"\.\.\.\d+$", "")


def pin_counts_wide(
    df: DataFrame, ids: Sequence[str], focal: str = "FOCAL", blank: str = "NA", strict: bool = True
) -> DataFrame:
    """Pin hits per sample and species from sheets with one column per species.

    Columns named after focal individuals are left out, the numbering of
    repeated column names is removed, hits on no plant are called ``Other``.
    """
    types = dict(df.dtypes)
    numeric = ("int", "bigint", "double", "float", "smallint", "tinyint")
    species = [c for c in df.columns if c not in ids and focal not in c and types[c] in numeric and c != blank]
    agg = sum_strict if strict else sum_zero
    summed = df.groupBy(*ids).agg(*[agg(F.col(f"`{c}`").cast("double")).alias(c) for c in species])
    tall = gather(summed, list(ids), "SpeciesName", "cover")
    tall = tall.withColumn("SpeciesName", _drop_suffix("SpeciesName"))
    return (
        tall.groupBy(*ids, "SpeciesName").agg(agg("cover").alias("cover"))
        .withColumn("SpeciesName", F.when(F.col("SpeciesName") == blank, F.lit("Other")).otherwise(F.col("SpeciesName")))
        .filter(F.col("cover").isNotNull())
    )


def pin_counts_rows(
    df: DataFrame, ids: Sequence[str], name: str, pins: Sequence[str], focal: str = "FOCAL", blank: str = "NA"
) -> DataFrame:
    """Pin hits per sample and species from sheets with one row per species and one column per pin."""
    species = F.when(F.col(name) == blank, F.lit("Other")).otherwise(F.col(name))
    return (
        df.filter(F.coalesce(~F.col(name).contains(focal), F.lit(True)))
        .select(*ids, species.alias("SpeciesName"), row_sum(*[F.col(f"`{p}`") for p in pins]).alias("cover"))
        .groupBy(*ids, "SpeciesName").agg(F.sum("cover").alias("cover"))
    )


def retro_correct(
    df: DataFrame, pairs: DataFrame, keys: Sequence[str], old: str, new: str, name: str = "SpeciesName"
) -> DataFrame:
    """Replace names by those learned from the next survey.

    ``pairs`` holds (keys, old name, new name).  A name that was split into two
    gives a row for each.
    """
    known = pairs.filter(F.col(old).isNotNull()).select(*keys, F.col(old), F.col(new)).distinct()
    joined = null_safe_join(df, known, {**{k: k for k in keys}, name: old})
    return joined.withColumn(name, F.coalesce(new, name)).select(*df.columns)


def quadrat_rollup(
    df: DataFrame, keys: Sequence[str], focal: str = "is_focal", value: str = "cover_cm2", out: str = "cover"
) -> DataFrame:
    """Add up the quadrats of a plot, focal individuals left out."""
    return df.filter(~F.col(focal)).groupBy(*keys).agg(sum_strict(value).alias(out))


def biomass_rollup(
    df: DataFrame,
    keys: Sequence[str],
    treatment: str = "treatment",
    keep: str = "ctrl",
    value: str = "bm",
    out: str = "biomass",
) -> DataFrame:
    """Add up the biomass (decimal-comma text) of the control rows per key."""
    rows = df.filter(F.col(treatment) == keep).withColumn(value, decimal_comma(value))
    return rows.groupBy(*keys).agg(sum_zero(value).alias(out))


def greenness(df: DataFrame, ids: Sequence[str], vascular: str = "VascCover") -> DataFrame:
    """Vascular cover and its complement as two rows per sample.

    The relative value is 100 for both classes, as published.
    """
    both = df.select(
        *ids,
        F.col(vascular).cast("double").alias("VascCover"),
        (F.lit(100.0) - F.col(vascular).cast("double")).alias("OtherCover"),
    )
    tall = gather(both, list(ids), "CoverClass", "Value").withColumnRenamed("Value", "OtherCover")
    return tall.withColumn("Rel_OtherCover", F.lit(100.0))


def stem_relative(df: DataFrame, keys: Sequence[str], value: str = "Individuals") -> DataFrame:
    """Relative abundance from stem counts; a missing count is 0, zero rows are dropped."""
    counted = df.withColumn(value, F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    totals = counted.groupBy(*keys).agg(F.sum(value).alias("Total_Cover"))
    joined = null_safe_join(counted, totals, list(keys))
    out = joined.select(*df.columns, "Total_Cover", ratio(value, "Total_Cover").alias("Rel_Cover"))
    return out.filter(F.col("Rel_Cover") > 0)
