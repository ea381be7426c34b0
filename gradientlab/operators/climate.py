"""Gridded climate: sampling at sites, seasonal statistics, proximity."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import as_col
from ..session import stage_table
from .reshape import gather, separate

EARTH_KM = 6371.0088
LAPSE_RATE = 0.0098
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
SUMMER = ["Jun", "Jul", "Aug"]
WINTER_HALF = (10, 11, 12, 1, 2, 3)
# Variable -> (output prefix, aggregate, months of the summer season).
SEASONS = {
    "tavg": ("T", "avg", (5, 6, 7, 8, 9)),
    "vapr": ("V", "avg", (4, 5, 6, 7, 8, 9)),
    "prec": ("P", "sum", (4, 5, 6, 7, 8, 9)),
}


def cell_keys(lon: str | Column, lat: str | Column, x0: float, y0: float, res: float) -> tuple[Column, Column]:
    """Column and row number of the grid cell that holds a point; (x0, y0) is the top left corner."""
    col = F.floor((as_col(lon) - F.lit(x0)) / F.lit(res))
    row = F.floor((F.lit(y0) - as_col(lat)) / F.lit(res))
    return col, row


def sample_grid(
    sites: DataFrame, grid: DataFrame, x0: float, y0: float, res: float, lon: str = "Longitude", lat: str = "Latitude"
) -> DataFrame:
    """Grid values of the cell around each site, as an equi-join on cell numbers.

    ``grid`` is long: lon, lat (cell centres) and any value columns.  A site
    outside the grid keeps NULL values.
    """
    sx, sy = cell_keys(lon, lat, x0, y0, res)
    gx, gy = cell_keys("lon", "lat", x0, y0, res)
    left = sites.withColumns({"__cx": sx, "__cy": sy})
    right = grid.withColumns({"__cx": gx, "__cy": gy}).drop("lon", "lat")
    return left.join(right, ["__cx", "__cy"], "left").drop("__cx", "__cy")


def tolerance_match(
    sites: DataFrame, grid: DataFrame, tolerance: float, lon: str = "Longitude", lat: str = "Latitude"
) -> DataFrame:
    """All grid points closer than ``tolerance`` to a site on both axes.

    Space is cut into buckets of twice the tolerance.  A site asks for the at
    most four buckets its window touches, a grid point lies in one; the exact
    test follows the equi-join.
    """
    width = 2.0 * tolerance

    def touched(c: str) -> Column:
        lo = F.floor((F.col(c) - F.lit(tolerance)) / F.lit(width))
        hi = F.floor((F.col(c) + F.lit(tolerance)) / F.lit(width))
        return F.explode(F.sequence(lo, hi))

    left = sites.withColumn("__bx", touched(lon)).withColumn("__by", touched(lat))
    right = grid.withColumns({
        "__bx": F.floor(F.col("lon") / F.lit(width)),
        "__by": F.floor(F.col("lat") / F.lit(width)),
    })
    near = (F.abs(F.col("lat") - F.col(lat)) < tolerance) & (F.abs(F.col("lon") - F.col(lon)) < tolerance)
    return left.join(right, ["__bx", "__by"]).filter(near).drop("__bx", "__by")


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = (
        F.pow(F.sin((p2 - p1) / 2), 2)
        + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def stations_within(
    sites: DataFrame,
    stations: DataFrame,
    km: float,
    lon: str = "Longitude",
    lat: str = "Latitude",
    station_lon: str = "st_lon",
    station_lat: str = "st_lat",
) -> DataFrame:
    """Stations within ``km`` of each site, with their distance.

    Points are placed on the unit sphere and bucketed in cubes as wide as the
    chord of the search radius, which works across the date line and at the
    poles.  A site asks for its 27 neighbouring cubes, a station lies in one.
    With ``km`` 0 stations at the very place are found, below 0 none.
    """
    chord = max(2.0 * math.sin(min(max(km, 0.0) / EARTH_KM, math.pi) / 2.0), 1e-9)

    def xyz(lo: str, la: str) -> list[Column]:
        l, p = F.radians(F.col(lo)), F.radians(F.col(la))
        return [F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p)]

    def cube(v: Column) -> Column:
        return F.floor(v / F.lit(chord))

    left = sites
    for name, v in zip(("__x", "__y", "__z"), xyz(lon, lat)):
        left = left.withColumn(name, F.explode(F.sequence(cube(v) - 1, cube(v) + 1)))
    right = stations.withColumns(
        {n: cube(v) for n, v in zip(("__x", "__y", "__z"), xyz(station_lon, station_lat))}
    )
    distance = haversine_km(F.col(lon), F.col(lat), F.col(station_lon), F.col(station_lat))
    joined = left.join(right, ["__x", "__y", "__z"]).withColumn("distance_km", distance)
    return joined.filter(F.col("distance_km") <= km).drop("__x", "__y", "__z")


def nearest_stations(
    sites: DataFrame,
    stations: DataFrame,
    k: int,
    site: str = "siteID",
    station: str = "station",
    within_km: float | None = None,
    start_km: float | None = None,
    **columns: str,
) -> DataFrame:
    """The ``k`` nearest stations of each site with their rank and distance; fewer where ``within_km`` holds fewer.

    Rings: stations are looked for within a radius, and sites that have ``k`` of them are done, since whatever lies
    outside is farther away.  The others ask again with twice the radius, so sparse regions cost no one else.  The
    first radius is that of a circle which holds ``k`` stations on average.  Of each site's stations only
    the best ``k`` are kept before and after the shuffle.  Equal distances (to the millimetre) rank by ``station``;
    ``site`` is unique; sites and stations without a position take no part.  ``columns`` as in ``stations_within``.
    """
    lon, lat = columns.get("lon", "Longitude"), columns.get("lat", "Latitude")
    far = min(math.pi * EARTH_KM if within_km is None else within_km, math.pi * EARTH_KM)
    known = stations.dropna(subset=[columns.get("station_lon", "st_lon"), columns.get("station_lat", "st_lat")])
    km = start_km or 2.0 * EARTH_KM * math.sqrt(k / max(known.count(), 1))
    todo = stage_table(sites.dropna(subset=[lon, lat]), "stations/sites")
    order = Window.partitionBy(site).orderBy(F.round("distance_km", 6), station)
    found = None
    while True:
        km = min(km, far)
        near = stations_within(todo, known, km if km < far or within_km is not None else 2 * far, **columns)
        ranked = stage_table(near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "stations/ranked")
        last = km >= far
        done = ranked.filter(F.col("rank") == k).select(site)
        part = ranked if last else ranked.join(done, site, "left_semi")
        found = part if found is None else found.unionByName(part)
        if last:
            return found
        todo = stage_table(todo.join(done, site, "left_anti"), "stations/sites")
        if todo.isEmpty():
            return found
        km *= 2


def seasonal_stats(
    grid: DataFrame,
    keys: Sequence[str],
    seasons: Mapping[str, tuple[str, str, tuple[int, ...]]] = SEASONS,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Annual, summer and winter value of each variable per site, in one aggregate.

    ``grid`` is long with month, var, value; ``extra`` aggregates are added.
    """
    aggs = list(extra)
    for var, (prefix, how, summer) in seasons.items():
        f = F.avg if how == "avg" else F.sum
        mine = F.col("var") == var
        aggs += [
            f(F.when(mine, F.col("value"))).alias(f"{prefix}_ann"),
            f(F.when(mine & F.col("month").isin(list(summer)), F.col("value"))).alias(f"{prefix}_sum"),
            f(F.when(mine & F.col("month").isin(list(WINTER_HALF)), F.col("value"))).alias(f"{prefix}_win"),
        ]
    return grid.groupBy(*keys).agg(*aggs)


def lapse_correct(
    df: DataFrame,
    columns: Sequence[str] = ("T_ann", "T_sum", "T_win"),
    grid_elevation: str = "Elevation_st",
    site_elevation: str = "Elevation",
    rate: float = LAPSE_RATE,
) -> DataFrame:
    """Temperatures moved from the mean elevation of the cell to that of the site."""
    step = F.lit(rate) * (F.col(grid_elevation) - F.col(site_elevation))
    return df.withColumns({f"{c}_cor": F.col(c) + step for c in columns})


def monthly_long(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str] | None = None, after: int = 2000
) -> DataFrame:
    """``YYYY_Mon`` columns to rows of year, month, value; only years after ``after``.

    The year test is made on the column names, so dropped months are never read.
    """
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in ids]
    wanted = [c for c in columns if int(c.split("_")[0]) > after]
    tall = gather(df, ids, "name", "value", wanted, "double")
    out = separate(tall, "name", ["year", "month"], "_")
    return out.withColumn("year", F.col("year").cast("int"))


def summer_climate(
    grid: DataFrame, keys: Sequence[str], temperature: str = "tmp", rain: str = "pre", months: Sequence = SUMMER
) -> DataFrame:
    """Mean summer temperature and summed summer rain per site and year.

    Both series come out of one aggregate.  A site-year without temperature
    rows is left out; without rain rows its rain is NULL.
    """
    is_t, is_p = F.col("var") == temperature, F.col("var") == rain
    out = (
        grid.filter(F.col("month").isin(list(months)))
        .groupBy(*keys, "year")
        .agg(
            F.count_if(is_t).alias("__nt"),
            F.count_if(is_p).alias("__np"),
            F.avg(F.when(is_t, F.col("value"))).alias("avetemp"),
            F.sum(F.when(is_p, F.col("value"))).alias("__rain"),
        )
        .filter(F.col("__nt") > 0)
    )
    rain_col = F.when(F.col("__np") > 0, F.coalesce("__rain", F.lit(0.0)))
    return out.select(*keys, "year", "avetemp", rain_col.alias("sumprec"))


def site_coords(meta: DataFrame) -> DataFrame:
    """Mean position and years per gradient and site, with the span of years."""
    means = ["lat", "long", "yearn", "year1", "elev"]
    out = meta.groupBy("gradient", "site").agg(
        *[F.avg(F.col(c).try_cast("double")).alias(c) for c in means]
    )
    return out.withColumn("Yearrange", F.col("yearn") - F.col("year1"))
