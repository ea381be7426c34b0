"""Gridded values stored in tiles, of which a question reads only those that its sites touch."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .climate import cell_keys


@dataclass(frozen=True)
class Tiling:
    """Square tiles of ``cells`` by ``cells`` grid cells of ``res`` degrees; (x0, y0) is the top left corner of the grid.

    The number of tiles is fixed by the extent, not by the data: 1,152 of 7.5 degrees for the whole globe, for example.
    """

    x0: float = -180.0
    y0: float = 90.0
    res: float = 1 / 12
    cells: int = 90
    width: float = 360.0
    height: float = 180.0

    def across(self) -> tuple[int, int]:
        side = self.res * self.cells
        return math.ceil(round(self.width / side, 9)), math.ceil(round(self.height / side, 9))

    def keys(self, lon: str | Column, lat: str | Column) -> dict[str, Column]:
        """Tile and cell numbers of a point; the tile is NULL outside the grid.

        The tile key interleaves the bits of its column and row, so neighbouring tiles mostly have neighbouring keys.
        """
        cx, cy = cell_keys(lon, lat, self.x0, self.y0, self.res)
        tx, ty = F.floor(cx / F.lit(self.cells)), F.floor(cy / F.lit(self.cells))
        columns, rows = self.across()
        bits = max(columns, rows).bit_length()
        inside = tx.between(0, columns - 1) & ty.between(0, rows - 1)
        spread = lambda c, at: [
            F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1)), 2 * i + at) for i in range(bits)]
        mixed = reduce(lambda a, b: a.bitwiseOR(b), spread(tx, 0) + spread(ty, 1))
        return {"tile": F.when(inside, mixed).cast("int"), "cell_x": cx, "cell_y": cy}


def write_tiles(grid: DataFrame, path: str, tiling: Tiling, lon: str = "lon", lat: str = "lat") -> str:
    """Store a long grid (cell centres ``lon``, ``lat`` and any values) as a table partitioned by tile.

    Cells outside the grid or without a position are no part of it.  The rebalance hint gathers a tile into few files and
    splits one that is too large for a task; tiles that the table holds and ``grid`` lacks stay.
    """
    placed = grid.withColumns(tiling.keys(lon, lat)).filter(F.col("tile").isNotNull())
    placed.hint("rebalance", "tile").sortWithinPartitions("tile", "cell_y", "cell_x").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("tile").parquet(path)
    return path


def sample_tiles(
    sites: DataFrame, tiles: DataFrame, tiling: Tiling, values: Sequence[str], lon: str = "Longitude", lat: str = "Latitude"
) -> DataFrame:
    """Values of the cell around each site, a row for each that the cell has; NULL for sites without one.

    ``tiles`` is a table of ``write_tiles``.  The tiles that the sites touch are staged: a list no longer than the
    tiling has tiles, whatever the number of sites.  The optimizer makes of the join with it a dynamic
    filter on partitions, so other tiles are neither listed for reading nor opened.
    """
    names = {"tile": "__tile", "cell_x": "__cx", "cell_y": "__cy"}
    placed = sites.withColumns({names[k]: c for k, c in tiling.keys(lon, lat).items()})
    inside = placed.filter(F.col("__tile").isNotNull())
    touched = stage_table(inside.select(F.col("__tile").alias("tile")).distinct(), "tiles/touched")
    read = tiles.join(touched.filter(F.col("tile") >= 0), "tile", "left_semi")
    cells = read.select(*[F.col(k).alias(f"{n}2") for k, n in names.items()], *[F.col(v).alias(f"__v{i}") for i, v in enumerate(values)])
    same = reduce(lambda a, b: a & b, [F.col(n) == F.col(f"{n}2") for n in names.values()])
    joined = placed.join(cells, same, "left")
    return joined.select(*[F.col(f"`{c}`") for c in sites.columns], *[F.col(f"__v{i}").alias(v) for i, v in enumerate(values)])
