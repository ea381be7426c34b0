"""The three products: merged community, resolved taxonomy, merged traits; and site climate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import climate as Cl
from ..operators import community as C
from ..operators import taxonomy as T
from ..operators import traits as Tr
from ..operators.names import resolve_with_ranks
from ..operators.reshape import union_all
from ..session import stage_table
from ..sources.readers import write_table
from .profile import SiteBundle, Tables, build_bundle
from .regions import NORWAY_GRADIENTS, PROFILES, norway_records

META_TYPES = {
    "Elevation": "double", "Longitude": "double", "Latitude": "double", "YearEstablished": "int", "YearMin": "int",
    "YearMax": "int", "YearRange": "int", "PlotSize_m2": "double",
}


def build_bundles(raw: Mapping[str, Tables], compat: bool = False, stage: bool = False) -> dict[str, SiteBundle]:
    """Bundles of the regions whose raw tables are given, as lazy plans.

    With ``stage``, the corrected records of Norway are written once for all
    gradients that share their raw tables.
    """
    raw = dict(raw)
    norway = [r for r in raw if r in NORWAY_GRADIENTS]
    if stage and len(norway) > 1:
        country = stage_table(norway_records(raw[norway[0]]), "records/norway")
        for region in norway:
            if raw[region]["turfs"] is raw[norway[0]]["turfs"]:
                raw[region] = {**raw[region], "country_records": country}
    return {region: build_bundle(PROFILES[region], tables, compat, stage) for region, tables in raw.items()}


def stage_bundle(region: str, bundle: SiteBundle) -> SiteBundle:
    """The bundle with every table written to the shared folder and read back.

    The products below each read the cleaned tables of all regions; stage the
    bundles first so that no region is cleaned more than once.
    """
    tables = {f.name: getattr(bundle, f.name) for f in fields(bundle)}
    return SiteBundle(**{
        name: df if df is None else stage_table(df, f"bundles/{region}/{name}") for name, df in tables.items()
    })


def all_communities(bundles: Mapping[str, SiteBundle]) -> DataFrame:
    return C.union_tagged({r: C.canonical_community(b.community).drop("Region") for r, b in bundles.items()})


def all_meta(bundles: Mapping[str, SiteBundle]) -> DataFrame:
    return C.union_tagged({r: b.meta for r, b in bundles.items()}, types=META_TYPES)


def site_elevations(bundles: Mapping[str, SiteBundle]) -> DataFrame:
    """Elevation per region and site.

    Regions with published site constants give literal rows, whose size the
    optimizer knows, so the community is not shuffled to look them up; the
    others give their metadata table.
    """
    spark = next(iter(bundles.values())).community.sparkSession
    known = [
        (region, site, float(place[0])) for region in bundles for site, place in PROFILES[region].sites.items()
    ]
    parts = []
    if known:
        parts.append(spark.createDataFrame(known, "Region string, destSiteID string, Elevation double"))
    parts += [
        b.meta.select(F.lit(r).alias("Region"), "destSiteID", F.col("Elevation").cast("double").alias("Elevation"))
        for r, b in bundles.items() if not PROFILES[r].sites
    ]
    return union_all(parts)


def dat(bundles: Mapping[str, SiteBundle]) -> DataFrame:
    """Community of all regions with site elevation."""
    return C.merge_community(all_communities(bundles), site_elevations(bundles))


def cleaned_species(
    bundles: Mapping[str, SiteBundle],
    codebooks: Sequence[tuple[Sequence[str], DataFrame]],
    backbone: DataFrame,
    edits: int = 2,
    compat: bool = False,
    by_rank: bool = False,
) -> DataFrame:
    """Species of every site with their resolved names.

    Names without a match are labelled ``Region_NID_k``; with ``compat`` the
    labelled rows are added to the unlabelled ones instead of replacing them.
    With ``by_rank``, names that stay unresolved as a whole are resolved by their
    canonical form, from the lowest rank up.
    """
    # distinct per region, so that no relative cover is joined for it, and staged, as what follows reads it several times
    census = stage_table(
        union_all([C.site_species(all_communities({r: b})) for r, b in bundles.items()]), "names/census")
    named = T.attach_names(census, T.merge_codebooks(codebooks)) if codebooks else census.withColumn(
        "original_name", F.col("SpeciesName")
    )
    submitted = T.apply_synonyms(named)
    resolved = (resolve_with_ranks if by_rank else T.resolve_names)(submitted, backbone, edits)
    taxa = T.attach_resolution(submitted, resolved).select(
        "Region", "destSiteID", "SpeciesName", "original_name", "submitted_name", "gni_uuid", "score", "matched_name"
    )
    return T.number_unresolved(taxa, row_no=None, append=compat)


def all_traits(
    bundles: Mapping[str, SiteBundle],
    cleaned: DataFrame,
    species: DataFrame,
    categorical: DataFrame,
    numeric: DataFrame,
) -> DataFrame:
    """Traits per region, site and species: field means, gap-filled from the trait database."""
    field_traits = Tr.merge_site_traits({r: b.trait for r, b in bundles.items() if b.trait is not None})
    matched = T.match_hierarchy(cleaned, species)
    _, database = T.attach_trait_db(matched, species, categorical, numeric)
    return Tr.gapfill_traits(Tr.spread_traits(Tr.mean_of_means(field_traits)), database)


def site_climate(meta: DataFrame, grid: DataFrame, x0: float, y0: float, res: float) -> DataFrame:
    """Seasonal climate of every site, temperatures moved to the site's elevation.

    ``grid`` is long: lon, lat, month, var, value, with the cell's elevation as
    variable ``elevation``.
    """
    sites = meta.select(*C.META_COLUMNS)
    sampled = Cl.sample_grid(sites, grid, x0, y0, res)
    elevation = F.max(F.when(F.col("var") == "elevation", F.col("value"))).alias("Elevation_st")
    return Cl.lapse_correct(Cl.seasonal_stats(sampled, C.META_COLUMNS, extra=[elevation]))


def save(df: DataFrame, path: str, partition: Sequence[str] = ("Region",)) -> str:
    """Store a product as a table partitioned by region."""
    return write_table(df, path, partition)
