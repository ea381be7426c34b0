"""Field traits: tidying, derived values, site means, gap filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import null_safe_join, ratio
from .community import union_tagged
from .reshape import gather, spread

SITE_TRAITS = ["Plant_Veg_Height_cm", "Leaf_Area_cm2", "SLA_cm2_g", "C_percent", "N_percent"]
# Columns of the trait database and their names in the merged table.
DATABASE_TRAITS = {
    "leaf_area": "TLeaf_Area_cm2", "leaf_C": "TC_percent", "leaf_N": "TN_percent",
    "leaf_P": "TP_percent", "plant_height": "TPlant_Veg_Height_cm", "seed_mass": "TSeed_Mass",
    "SLA": "TSLA_cm2_g", "stem_density": "TStem_density",
}
DATABASE_ONLY = {"P_percent": "TP_percent", "Seed_Mass": "TSeed_Mass", "Stem_density": "TStem_density"}


def derive_traits(df: DataFrame, specs: Mapping[str, Column]) -> DataFrame:
    """Add derived traits given as expressions (see the helpers below)."""
    return df.withColumns(dict(specs))


def ldmc(dry: str = "Dry_Mass_g", wet: str = "Wet_Mass_g") -> Column:
    """Leaf dry matter content, NULL unless both masses are known and the wet one is not 0."""
    return ratio(dry, wet)


def sla(area: str = "Leaf_Area_cm2", dry: str = "Dry_Mass_g") -> Column:
    """Specific leaf area."""
    return ratio(area, dry)


def cn_ratio(c: str = "C_percent", n: str = "N_percent") -> Column:
    return ratio(c, n)


def tidy_traits(
    df: DataFrame,
    rename: Mapping[str, str],
    values: Mapping[str, Column],
    ids: Sequence[str],
    constants: Mapping[str, str] | None = None,
    plant_id: Column | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Wide field sheet to one row per plant and trait, missing values dropped.

    ``values`` gives each trait as an expression over the renamed columns, in
    which earlier traits may be used by name.
    """
    df = df.withColumnsRenamed(dict(rename))
    for name, expr in values.items():
        df = df.withColumn(name, expr.cast("double"))
    df = df.withColumns({k: F.lit(v) for k, v in (constants or {}).items()})
    if plant_id is not None:
        df = df.withColumn("PlantID", plant_id)
    keep = [*(constants or {}), *ids] + (["PlantID"] if plant_id is not None else [])
    tall = gather(df.select(*keep, *values), keep, "Trait", "Value", list(values))
    out = tall.filter(F.col("Value").isNotNull())
    for c in required:
        out = out.filter(F.col(c).isNotNull())
    return out


def merge_site_traits(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Tall union of the trait tables of all regions that have one."""
    types = {"Value": "double", "Year": "int", "Individual_number": "string"}
    return union_tagged(frames, "Region", types)


def mean_of_means(traits: DataFrame) -> DataFrame:
    """Mean per plant, then mean over plants per region, site, species and trait."""
    site = ["Region", "destSiteID", "SpeciesName", "Trait"]
    plants = traits.groupBy(*site, "PlantID").agg(F.avg("Value").alias("mValue"))
    return plants.groupBy(*site).agg(F.avg("mValue").alias("siteValue"), F.count(F.lit(1)).alias("nRep"))


def spread_traits(means: DataFrame, names: Sequence[str] = SITE_TRAITS) -> DataFrame:
    return spread(means, ["Region", "destSiteID", "SpeciesName"], "Trait", "siteValue", names)


def gapfill_traits(site_wide: DataFrame, database: DataFrame) -> DataFrame:
    """Site means where measured, else database values; every database row is kept."""
    db = database.withColumnsRenamed(DATABASE_TRAITS)
    joined = null_safe_join(
        site_wide.select("Region", "destSiteID", "SpeciesName", *SITE_TRAITS),
        db,
        {"Region": "Region", "destSiteID": "destSiteID", "SpeciesName": "accepted_name"},
        "right",
    )
    filled = {t: F.coalesce(t, f"T{t}") for t in SITE_TRAITS}
    return joined.withColumns({**filled, **{k: F.col(v) for k, v in DATABASE_ONLY.items()}})
