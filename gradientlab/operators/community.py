"""Plot-community operators: treatments, cover classes, sample keys, relative cover."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import (
    all_but,
    as_col,
    column_or_null,
    not_in,
    null_safe_join,
    paste,
    pmax,
    ratio,
    recode,
    recode_to,
    sum_strict,
    sum_zero,
    to_number,
)

OTHER = "Other"
COMMUNITY_COLUMNS = [
    "Region", "Year", "originSiteID", "originBlockID", "destSiteID", "destBlockID", "destPlotID",
    "Treatment", "turfID", "UniqueID", "SpeciesName", "Cover", "Rel_Cover",
]
COMMUNITY_TYPES = {"Year": "int", "Cover": "double", "Rel_Cover": "double"}
META_COLUMNS = [
    "Gradient", "destSiteID", "Longitude", "Latitude", "Elevation", "YearEstablished", "YearMin",
    "YearMax", "YearRange", "PlotSize_m2", "Country",
]


# -- treatments -------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """One treatment rule; every given part must hold.

    ``relation`` compares the rank of the origin site with that of the
    destination: ``same``, ``down`` (origin above destination) or ``up``.
    """

    treatment: str
    label: tuple[str, ...] = ()
    origin: tuple[str, ...] = ()
    dest: tuple[str, ...] = ()
    relation: str | None = None


def assign_treatment(
    df: DataFrame,
    rules: Sequence[Rule],
    label: str | Column | None = None,
    origin: str | Column = "originSiteID",
    dest: str | Column = "destSiteID",
    ranks: Mapping[str, float] | None = None,
    origin_rank: str | Column | None = None,
    dest_rank: str | Column | None = None,
    out: str = "Treatment",
) -> DataFrame:
    """First matching rule gives the treatment; no rule gives NULL.

    Rules are a short fixed list, so they become one ``CASE`` expression inside
    the projection: no join and no exchange.
    """
    o, d = as_col(origin), as_col(dest)
    if ranks is not None:
        origin_rank, dest_rank = recode_to(o, ranks), recode_to(d, ranks)
    chain = None
    for rule in rules:
        tests = []
        if rule.label:
            tests.append(as_col(label).isin(list(rule.label)))
        if rule.origin:
            tests.append(o.isin(list(rule.origin)))
        if rule.dest:
            tests.append(d.isin(list(rule.dest)))
        if rule.relation:
            a, b = as_col(origin_rank), as_col(dest_rank)
            tests.append({"same": a == b, "down": a > b, "up": a < b}[rule.relation])
        cond = reduce(lambda x, y: x & y, tests, F.lit(True))
        value = F.lit(rule.treatment)
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)
    return df.withColumn(out, chain if chain is not None else F.lit(None).cast("string"))


# -- cover classes ----------------------------------------------------------

# Percent mid-point of each ordinal cover class.
SCALE_10 = {1: 0.5, 2: 1.0, 3: 3.5, 4: 8.0, 5: 15.5, 6: 25.5, 7: 35.5, 8: 45.5, 9: 55.5, 10: 80.0}
SCALE_11 = {1: 0.5, 2: 1.0, 3: 3.5, 4: 8.0, 5: 15.5, 6: 25.5, 7: 35.5, 8: 45.5, 9: 55.5, 10: 70.0, 11: 90.0}
SCALE_13 = {
    1: 0.5, 2: 1.0, 3: 3.5, 4: 8.0, 5: 15.5, 6: 25.5, 7: 35.5, 8: 45.5, 9: 55.5,
    10: 65.5, 11: 75.5, 12: 85.5, 13: 95.5,
}
SCALE_LETTERS = {"+": 0.5, "r": 0.1, "1": 3.5, "2a": 10.0, "2b": 20.0, "3": 37.5, "4": 62.5, "5": 87.5}
SCALE_PLUS = {"+": 0.5}


def decode_cover(
    df: DataFrame, scale: Mapping, col: str = "Cover", out: str = "Cover", numeric_rest: bool = False
) -> DataFrame:
    """Replace an ordinal class by its percent mid-point.

    Numbered classes are looked up by their exact number.  What is outside the
    scale stays as it is in a column of numbers and becomes NULL in a column of
    texts; with ``numeric_rest`` such texts are read as numbers instead.
    """
    source = F.col(f"`{col}`")
    text = dict(df.select(source.alias("c")).dtypes)["c"] == "string"
    if isinstance(next(iter(scale)), str):
        value = recode_to(source.cast("string"), dict(scale))
    else:
        value = recode_to(to_number(source), {float(k): v for k, v in scale.items()})
    if numeric_rest or not text:
        value = F.coalesce(value, to_number(source))
    return df.withColumn(out, value)


# -- keys -------------------------------------------------------------------

def build_ids(df: DataFrame, recipes: Mapping[str, Sequence[str]], sep: str = "_") -> DataFrame:
    """Composite text keys; later recipes may use the keys of earlier ones."""
    for name, parts in recipes.items():
        df = df.withColumn(name, paste(*[F.col(f"`{p}`") for p in parts], sep=sep))
    return df


def collapse_duplicates(df: DataFrame, keys: Sequence[str], value: str = "Cover") -> DataFrame:
    """Drop repeated rows, then add up what is left per key (NULL counts as 0)."""
    return df.distinct().groupBy(*keys).agg(sum_zero(value).alias(value))


# -- relative abundance -----------------------------------------------------

def sample_totals(
    df: DataFrame, keys: Sequence[str], value: str = "Cover", residual: bool = True, strict: bool = False
) -> DataFrame:
    """One row per sample: summed cover and the total used as divisor.

    With a residual row the total of a sample is max(100, sum of cover), so the
    divisor is known without building the residual rows.  ``strict`` makes the
    total NULL when any cover of the sample is missing.
    """
    total = F.coalesce(F.sum(value), F.lit(0.0))
    aggs = [total.alias("sum_cover"), F.count(value).alias("n_cover")]
    if strict:
        aggs.append(F.count_if(F.col(value).isNull()).alias("n_missing"))
    out = df.groupBy(*keys).agg(*aggs)
    divisor = F.col("sum_cover")
    if residual:
        divisor = F.when(F.col("n_cover") > 0, F.greatest(F.lit(100.0), divisor)).otherwise(divisor)
    if strict:
        divisor = F.when(F.col("n_missing") == 0, divisor)
    return out.select(*keys, "sum_cover", "n_cover", divisor.alias("Total_Cover"))


def hashed_keys(df: DataFrame, keys: Sequence[str], name: str = "__sample") -> tuple[DataFrame, list[str]]:
    """The table with a hash of its keys, and the keys with that hash in front; a single key stays as it is."""
    if len(keys) < 2:
        return df, list(keys)
    return df.withColumn(name, F.xxhash64(*[F.col(f"`{k}`") for k in keys])), [name, *keys]


def relative_cover(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    value: str = "Cover",
    residual: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Add ``Total_Cover`` and ``Rel_Cover`` = cover / sample total.

    The totals are a grouped aggregate (combined on the map side) joined back
    on the sample key, not a window: a window would pull every row of one
    sample into one task, whatever the size of that sample.  The join matches
    missing keys and so gets the totals through an exchange of their own, which
    lets a hot sample be split.  A hash of several keys comes first among them, so
    that sorting compares numbers and hardly ever the texts of the keys.
    """
    keys = list(keys) if keys is not None else all_but(df, "SpeciesName", value)
    rows, by = hashed_keys(df, keys)
    totals = sample_totals(rows, by, value, residual, strict).select(*by, "Total_Cover")
    joined = null_safe_join(rows, totals, by)
    return joined.select(*df.columns, "Total_Cover", ratio(value, "Total_Cover").alias("Rel_Cover"))


def residual_rows(df: DataFrame, keys: Sequence[str] | None = None, value: str = "Cover") -> DataFrame:
    """Per sample with any cover, one row ``Other`` holding max(100 - sum, 0)."""
    keys = list(keys) if keys is not None else all_but(df, "SpeciesName", value)
    totals = sample_totals(df, keys, value).filter("n_cover > 0")
    left_over = pmax(F.lit(100.0) - F.col("sum_cover"), 0)
    return totals.select(
        *keys,
        F.lit(OTHER).alias("SpeciesName"),
        left_over.alias(value),
        "Total_Cover",
        ratio(left_over, "Total_Cover").alias("Rel_Cover"),
    )


def residual_cover(df: DataFrame, keys: Sequence[str] | None = None, value: str = "Cover") -> DataFrame:
    """The input with its residual rows appended."""
    extra = residual_rows(df, keys, value).drop("Total_Cover", "Rel_Cover")
    return df.unionByName(extra, allowMissingColumns=True)


def split_community(
    df: DataFrame,
    classes: Iterable[str],
    relabel: Mapping[str, str] | None = None,
    abundance: str = "Cover",
) -> tuple[DataFrame, DataFrame]:
    """Split into species rows with positive abundance and non-plant cover classes."""
    classes = list(classes)
    community = df.filter(not_in("SpeciesName", classes)).filter(F.col(abundance) > 0)
    cover = df.filter(F.col("SpeciesName").isin(classes)).withColumn(
        "SpeciesName", recode("SpeciesName", relabel or {})
    )
    return community, cover


def tag_community(
    df: DataFrame,
    classes: Iterable[str],
    relabel: Mapping[str, str] | None = None,
    abundance: str = "Cover",
    tag: str = "part",
) -> DataFrame:
    """Both parts of ``split_community`` in one table and one pass, told apart by ``tag``."""
    is_class = F.coalesce(F.col("SpeciesName").isin(list(classes)), F.lit(False))
    kept = df.filter(is_class | (F.col(abundance) > 0))
    return kept.select(
        F.when(is_class, "cover").otherwise("community").alias(tag),
        *[F.when(is_class, recode("SpeciesName", relabel or {})).otherwise(F.col(c)).alias(c) if c == "SpeciesName"
          else F.col(f"`{c}`") for c in df.columns],
    )


def cover_summary(cover: DataFrame, grain: Sequence[str] = ("UniqueID",)) -> DataFrame:
    """Summed cover and relative cover per sample and cover class."""
    return (
        cover.groupBy(*grain, F.col("SpeciesName").alias("CoverClass"))
        .agg(
            sum_strict("Cover").alias("OtherCover"),
            sum_strict("Rel_Cover").alias("Rel_OtherCover"),
        )
    )


# -- lists and site metadata ------------------------------------------------

def taxa_list(df: DataFrame, name: str = "SpeciesName") -> DataFrame:
    return df.select(name).distinct()


def site_meta(
    df: DataFrame,
    sites: Mapping[str, tuple[float, float, float]],
    gradient: str,
    country: str,
    established: int,
    plot_size: float,
) -> DataFrame:
    """Survey span per site plus its fixed elevation, longitude and latitude.

    ``sites`` maps a site to (elevation, longitude, latitude).
    """
    spans = df.groupBy("destSiteID").agg(F.min("Year").alias("YearMin"), F.max("Year").alias("YearMax"))
    place = {
        name: recode_to("destSiteID", {s: float(v[i]) for s, v in sites.items()})
        for i, name in enumerate(("Elevation", "Longitude", "Latitude"))
    }
    return (
        spans.withColumns(place)
        .withColumns({
            "Gradient": F.lit(gradient),
            "Country": F.lit(country),
            "YearEstablished": F.lit(established),
            "PlotSize_m2": F.lit(float(plot_size)),
            "YearRange": F.col("YearMax") - F.lit(established),
        })
        .select(*META_COLUMNS)
    )


# -- unions and the merged product ------------------------------------------

def union_tagged(
    frames: Mapping[str, DataFrame], tag: str = "Region", types: Mapping[str, str] | None = None
) -> DataFrame:
    """Union by column name with the mapping key as id; absent columns are NULL.

    Columns named in ``types`` are cast on every side first, because a silent
    type promotion would change values.
    """
    types = dict(types or {})
    parts = []
    for key, df in frames.items():
        cols = [F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
        parts.append(df.select(F.lit(key).alias(tag), *cols))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def canonical_community(df: DataFrame) -> DataFrame:
    """Project to the canonical community columns; absent ones are typed NULLs."""
    return df.select(
        *[column_or_null(df, c, COMMUNITY_TYPES.get(c, "string")).alias(c) for c in COMMUNITY_COLUMNS]
    )


def merge_community(
    community: DataFrame,
    meta: DataFrame,
    drop_treatments: Sequence[str] = ("NettedControl", "Cold", "Control"),
) -> DataFrame:
    """The merged community table with site elevation.

    ``community`` and ``meta`` are tall tables with a ``Region`` column.  Rows
    without a treatment are kept; the named treatments are dropped.
    """
    kept = canonical_community(community.filter(not_in("Treatment", drop_treatments)))
    places = meta.select("Region", "destSiteID", "Elevation").distinct()
    return null_safe_join(kept, places, ["Region", "destSiteID"]).select(*COMMUNITY_COLUMNS, "Elevation")


def site_species(community: DataFrame) -> DataFrame:
    """Distinct species per region and site."""
    return community.select("Region", "destSiteID", "SpeciesName").distinct()
