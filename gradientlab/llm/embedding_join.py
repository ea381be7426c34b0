"""Near-duplicate vectors by an exact metric range join.

Cosine is a distance between vectors of length 1: cosine >= c means a distance of
at most e = sqrt(2 - 2 c).  Pivots, spread over a bounded sample, partition the
vectors; a vector's home is the cell of its nearest pivot.  It is also sent as a
guest to every other cell that may be home to a vector within e of it.  By the
triangle inequality that needs

    d(x, other pivot) - d(x, own pivot) <= 2 e    and    d(x, other pivot) <= radius of the other cell + e,

and, the space being Euclidean, a distance of at most e to the plane midway
between both pivots.  Every cell then joins its home vectors with all its
vectors, without looking at other cells: a home vector meets all its partners in
its own cell, so links are counted once and none is missed.

A cell of many vectors is dealt into blocks of home vectors and of guests, one
task for each pair of blocks, so no task holds more than two blocks.  Within a
task single-precision products screen the pairs, and those within 1e-4 of the
threshold are computed in double precision.  A task returns counts of links and,
of the graph of links, a spanning set of edges, not the links themselves.

Vectors with equal components are one item with a number of copies; they link
with each other and share all other links.  Vectors that are null, empty, zero or
hold null or non-finite components link with nothing; vectors of different
lengths don't link either.  Components are taken in single precision, as stored.  Repeated ids are vectors of their own under one id.
An empty table gives no rows; other columns are left out.

Where vectors lie so far apart that no pivot tells them apart (independent
directions in many dimensions), guests go to nearly all cells: the join is then
one in blocks, and its work grows with the square of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import bounded_sample
from .components import connected_components

_SLACK = 1e-6
_UNIT = "unit bigint, home boolean, item bigint, copies bigint, vector array<{}>"
#: Bytes of doubles in either block of a unit.
BLOCK_BYTES = 1 << 26


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _unit_rows(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # by a power of two, which changes no digit: squares of very large or small numbers would be no numbers
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the unit rows, each the farthest from those before it."""
    chosen = [0]
    nearest = sample @ sample[0]
    for _ in range(min(count, len(sample)) - 1):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    return sample[chosen]


class Cells:
    """Pivots of one vector length, and where vectors go."""

    def __init__(self, pivots: np.ndarray, reach: float):
        self.pivots, self.reach = pivots, reach
        gaps = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
        self.gaps = np.where(gaps < 1e-9, np.inf, gaps)  # equal pivots: nothing to gain from the plane between them
        self.radius = np.full(len(pivots), np.inf)
        self.home_blocks = np.ones(len(pivots), dtype=np.int64)
        self.guest_blocks = np.ones(len(pivots), dtype=np.int64)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home cell, distance to its pivot, matrix of the cells that each unit row goes to)."""
        dots = x @ self.pivots.T
        home = dots.argmax(1)
        rows = np.arange(len(x))
        distance = np.sqrt(np.maximum(2 - 2 * dots, 0))
        own = distance[rows, home]
        plane = (dots[rows, home][:, None] - dots) / self.gaps[home]
        reach = self.reach + _SLACK
        to = (distance - own[:, None] <= 2 * reach) & (distance <= self.radius + reach) & (plane <= reach)
        to[rows, home] = True
        return home, own, to


def _join_block(homes: np.ndarray, guests: np.ndarray, home_items: np.ndarray, guest_items: np.ndarray,
                guest_copies: np.ndarray, least: float, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(linked copies of each home row, spanning edges as pairs of items)."""
    a64, b64 = _unit_rows(homes), _unit_rows(guests)
    a32, b32 = a64.astype(np.float32), b64.astype(np.float32)
    links = np.zeros(len(homes), dtype=np.int64)
    label = guest_items.copy()
    edges = [np.zeros((0, 2), dtype=np.int64)]
    for start in range(0, len(homes), rows):
        part = slice(start, min(start + rows, len(homes)))
        near = a32[part] @ b32.T
        mask = near >= least - 1e-4
        r, c = np.nonzero(mask & (near < least + 1e-4))
        for k in range(0, len(r), 100_000):
            i, j = r[k : k + 100_000], c[k : k + 100_000]
            mask[i, j] = (a64[part][i] * b64[j]).sum(1) >= least
        mask &= home_items[part][:, None] != guest_items[None, :]
        hit_rows = np.flatnonzero(mask.any(1))
        if not len(hit_rows):
            continue
        hit = np.flatnonzero(mask.any(0))
        mask = mask[np.ix_(hit_rows, hit)]
        links[part][hit_rows] = mask @ guest_copies[hit]
        own, theirs = home_items[part][hit_rows].copy(), label[hit]
        top = np.iinfo(np.int64).max
        while True:
            new_own = np.minimum(own, np.where(mask, theirs[None, :], top).min(1))
            new_theirs = np.minimum(theirs, np.where(mask, new_own[:, None], top).min(0))
            if (new_own == own).all() and (new_theirs == theirs).all():
                break
            own, theirs = new_own, new_theirs
        edges.append(np.stack([home_items[part][hit_rows], own], 1))
        moved = theirs != label[hit]
        edges.append(np.stack([label[hit][moved], theirs[moved]], 1))
        label[hit] = theirs
    pairs = np.concatenate(edges)
    return links, np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)


def near_duplicates(
    vectors: DataFrame, least: float = 0.95, home_rows: int = 8192, guest_rows: int = 32_768, most_pivots: int = 1024,
) -> DataFrame:
    """vec_id, n_links and component_id of every row (vec_id, embedding)."""
    spark = vectors.sparkSession
    sound = (
        F.col("embedding").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        & F.exists("embedding", lambda v: v != 0)
    )
    # single precision is kept as it is, all else compared as doubles
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("embedding")).withColumn("sound", F.coalesce(sound, F.lit(False)))
    # the ids of items are fixed by writing them
    items = stage_table(
        rows.filter("sound").groupBy(F.col("embedding").alias("vector"))
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("item"), "first_id", "copies", "vector"), "vectors/items",
    )
    count = items.count()
    wanted = int(min(most_pivots, max(8, -(-count // home_rows))))
    sample = bounded_sample(items, F.col("item"), 8 * wanted).select("vector").toPandas()["vector"]
    by_width: dict[int, list[np.ndarray]] = {}
    for v in sample:
        by_width.setdefault(len(v), []).append(v)
    reach = float(np.sqrt(max(2 - 2 * least, 0)))
    cells = {w: Cells(spread(_unit_rows(np.stack(v)), wanted), reach) for w, v in by_width.items()}

    def lone(width: int) -> Cells:
        return Cells(np.eye(1, width), reach)  # a width that the sample lacks: one cell

    def by_length(batch: pa.RecordBatch, known: dict[int, Cells]) -> Iterator[tuple[int, Cells, pa.RecordBatch]]:
        sizes = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
        for width in np.unique(sizes).tolist():
            yield width, known.get(width) or lone(width), batch.take(pa.array(np.flatnonzero(sizes == width)))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, own, part in by_length(batch, cells):
                home, distance, to = own.place(_unit_rows(_matrix(part.column("vector"), width)))
                radius = np.zeros(to.shape[1])
                np.maximum.at(radius, home, distance)
                n = to.shape[1]
                yield pa.RecordBatch.from_pydict({
                    "width": pa.array([width] * n, pa.int32()), "cell": pa.array(range(n), pa.int32()),
                    "homes": pa.array(np.bincount(home, minlength=n), pa.int64()),
                    "guests": pa.array(to.sum(0), pa.int64()), "radius": pa.array(radius),
                })

    tallied = items.select("vector").mapInArrow(tally, "width int, cell int, homes bigint, guests bigint, radius double")
    # one row a cell: at most most_pivots rows for each vector length
    for r in tallied.groupBy("width", "cell").agg(
        F.sum("homes").alias("homes"), F.sum("guests").alias("guests"), F.max("radius").alias("radius")
    ).collect():
        own = cells.setdefault(r["width"], lone(r["width"]))
        own.radius[r["cell"]] = r["radius"] + _SLACK
        most = max(1, BLOCK_BYTES // (8 * r["width"]))
        own.home_blocks[r["cell"]] = max(1, -(-r["homes"] // min(home_rows, most)))
        own.guest_blocks[r["cell"]] = max(1, -(-r["guests"] // min(guest_rows, most)))
    # units of work: the pairs of blocks of every cell, numbered through
    first, total = {}, 0
    for width, own in cells.items():
        pairs = own.home_blocks * own.guest_blocks
        first[width] = total + np.cumsum(pairs) - pairs
        total += int(pairs.sum())
    shared = spark.sparkContext.broadcast((cells, first))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, begin = shared.value
        for batch in batches:
            for width, own, part in by_length(batch, known):
                ids = part.column("item").to_numpy()
                draw = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                home, _, to = own.place(_unit_rows(_matrix(part.column("vector"), width)))
                for is_home in (True, False):
                    row, cell = (np.arange(len(ids)), home) if is_home else np.nonzero(to)
                    mine = own.home_blocks[cell] if is_home else own.guest_blocks[cell]
                    others = own.guest_blocks[cell] if is_home else own.home_blocks[cell]
                    block = draw[row] % mine
                    again = np.repeat(np.arange(len(row)), others)
                    other = np.arange(len(again)) - np.repeat(np.cumsum(others) - others, others)
                    cell, block, row = cell[again], block[again], row[again]
                    h, g = (block, other) if is_home else (other, block)
                    unit = begin[width][cell] + h * own.guest_blocks[cell] + g
                    for k in range(0, len(row), 8192):
                        take = pa.array(row[k : k + 8192])
                        yield pa.RecordBatch.from_arrays([
                            pa.array(unit[k : k + 8192]), pa.array([is_home] * len(take)),
                            part.column("item").take(take), part.column("copies").take(take), part.column("vector").take(take),
                        ], names=["unit", "home", "item", "copies", "vector"])

    def join(unit: pa.Table) -> pa.Table:
        home = unit.column("home").to_numpy()
        x = unit.column("vector").combine_chunks()
        width = len(x[0])
        vectors, item = _matrix(x, width), unit.column("item").to_numpy()
        links, edges = _join_block(
            vectors[home], vectors[~home], item[home], item[~home], unit.column("copies").to_numpy()[~home], least)
        some = np.flatnonzero(links)
        return pa.table({
            "a": pa.array(np.concatenate([item[home][some], edges[:, 0]]), pa.int64()),
            "b": pa.array(np.concatenate([some, edges[:, 1]]), pa.int64(), mask=np.arange(len(some) + len(edges)) < len(some)),
            "links": pa.array(np.concatenate([links[some], np.zeros(len(edges), dtype=np.int64)]), pa.int64()),
        })

    dealt = items.select("item", "copies", "vector").mapInArrow(deal, _UNIT.format(kind))
    found = stage_table(dealt.groupBy("unit").applyInArrow(join, "a bigint, b bigint, links bigint"), "vectors/found")
    links = found.filter("b IS NULL").groupBy(F.col("a").alias("item")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    parts = items.select("item", "first_id").join(parts.withColumnRenamed("node", "item"), "item", "left").select(
        "item", "first_id", F.coalesce("component", "item").alias("component"))
    parts = stage_table(parts, "vectors/parts")
    names = parts.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stage_table(parts.join(names, "component").select("item", "component_id"), "vectors/named")
    linked = stage_table(
        items.join(links, "item", "left").join(named, "item").select(
            "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id",
        ), "vectors/linked")
    return rows.filter("sound").join(linked, F.col("embedding") == F.col("vector")).select(
        "vec_id", "n_links", "component_id"
    ).unionByName(rows.filter("not sound").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    ))
