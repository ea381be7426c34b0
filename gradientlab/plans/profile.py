"""Regional profiles: what a region measures, and the common steps that clean it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import community as C
from ..operators import corrections as K
from ..session import stage_table

Tables = Mapping[str, DataFrame]

SAMPLE_COLUMNS = [
    "Year", "originSiteID", "originBlockID", "destSiteID", "destBlockID", "destPlotID", "turfID",
    "UniqueID", "Treatment",
]


@dataclass(frozen=True)
class SiteBundle:
    """The five cleaned tables of a region; ``trait`` is None where no traits were measured."""

    community: DataFrame
    cover: DataFrame
    meta: DataFrame
    taxa: DataFrame
    trait: DataFrame | None = None


@dataclass(frozen=True)
class Profile:
    """Everything that is particular to one region.

    ``prepare`` turns the raw tables into records with sample columns,
    ``SpeciesName`` and ``Cover`` (or stem counts in ``Individuals``, in which
    case ``cover`` builds the cover-class table); the remaining fields steer
    the common steps.
    """

    region: str
    country: str
    established: int
    plot_size: float
    sites: Mapping[str, tuple[float, float, float]]  # site -> elevation, longitude, latitude
    prepare: Callable[[Tables], DataFrame]
    residual: bool = True
    dedupe: str = "none"  # "none", "distinct" or "collapse"
    classes: Sequence[str] = (C.OTHER,)
    relabel: Mapping[str, str] = field(default_factory=dict)
    cover_grain: Sequence[str] = ("UniqueID",)
    compat_grain: Sequence[str] | None = None
    cover: Callable[[Tables], DataFrame] | None = None
    traits: Callable[[Tables], DataFrame] | None = None
    taxa: Callable[[Tables], DataFrame] | None = None
    meta: Callable[[Tables], DataFrame] | None = None


def sample_keys(df: DataFrame) -> list[str]:
    return [c for c in SAMPLE_COLUMNS if c in df.columns]


def finish_community(
    records: DataFrame, profile: Profile, compat: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Records of a region to (community, cover-class summary).

    With ``compat`` one missing cover makes the total of its sample missing and
    the published summary grain is used; otherwise missing covers are left out.
    """
    keys = sample_keys(records)
    if profile.dedupe == "distinct":
        records = records.distinct()
    elif profile.dedupe == "collapse":
        records = C.collapse_duplicates(records, [*keys, "SpeciesName"])
    records = records.select(*keys, "SpeciesName", F.col("Cover").cast("double").alias("Cover"))
    if not compat:
        records = records.filter(F.col("Cover").isNotNull())
    rel = C.relative_cover(records, keys, residual=profile.residual, strict=compat)
    community, cover = C.split_community(rel, profile.classes, profile.relabel)
    if profile.residual:
        cover = cover.unionByName(C.residual_rows(records, keys))
    grain = profile.compat_grain if compat and profile.compat_grain else profile.cover_grain
    return community, C.cover_summary(cover, grain)


def build_bundle(profile: Profile, raw: Tables, compat: bool = False, stage: bool = False) -> SiteBundle:
    """All cleaned tables of one region from its raw tables.

    The prepared records feed both the sample totals and the rows they divide.
    With ``stage`` they are written once to the shared folder and read back, so
    that a costly preparation does not run twice.
    """
    records = profile.prepare(raw)
    if stage:
        records = stage_table(records, f"records/{profile.region}")
    if "Individuals" in records.columns:
        keys = sample_keys(records)
        community = K.stem_relative(records, keys)
        cover = profile.cover(raw)
    else:
        community, cover = finish_community(records, profile, compat)
    if profile.meta is not None:
        meta = profile.meta(raw)
    else:
        meta = C.site_meta(
            community, profile.sites, profile.region, profile.country, profile.established, profile.plot_size
        )
    taxa = profile.taxa(raw) if profile.taxa is not None else C.taxa_list(community)
    trait = profile.traits(raw) if profile.traits is not None and "trait" in raw else None
    return SiteBundle(community, cover, meta, taxa, trait)
