"""Sharding by Karmarkar-Karp differencing.

Documents with equal texts are one item, which no shard boundary cuts (a null
text counts as an empty one here; its size has no text bytes).  Differencing
keeps partial partitions, tuples of k part sums: at first one per item, with
the item in one part.  It takes the two with the largest spread, adds the
largest part of one to the smallest of the other, and so on down, until one
partition is left.

Differencing is sequential, so it runs on a bounded number of items at a time,
in levels.  At each level the large items (above a fixed share of all bytes, so
boundedly many) and ``fill`` small ones, picked by hash, go up as they are.  The
rest is dealt into blocks of about ``block`` items; each block is differenced into
``parts`` parts, and those parts go up as items.  Each level makes the rest
``block / parts`` times fewer.  Once all items fit into one run, the last
differencing makes the shards.  The small items of each level are finer than
the parts made from it, so they even out what the coarser ones leave.

Sums of items are exact integers.  Equal spreads are taken in order of the
items' ids, so equal inputs give equal shards.  Null ids and repeated rows are
rows like others and get slots of their own; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage_table


def differencing(sizes: np.ndarray, parts: int) -> np.ndarray:
    """Part (0 to ``parts`` - 1) of each item."""
    n = len(sizes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    # a node is an item or a merge of two; a merge says which part each part of its two nodes became
    sums: dict[int, np.ndarray] = {}
    left, right = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    order_left = np.zeros((max(n - 1, 0), parts), dtype=np.int32)
    order_right = np.zeros((max(n - 1, 0), parts), dtype=np.int32)
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    for step in range(n - 1):
        nodes = [heapq.heappop(heap)[1], heapq.heappop(heap)[1]]
        pair = []
        for node in nodes:
            if node in sums:
                pair.append(sums.pop(node))
            else:
                one = np.zeros(parts, dtype=np.int64)
                one[0] = sizes[node]
                pair.append(one)
        joined = pair[0] + pair[1][::-1]  # one falls, the other rises
        order = np.argsort(-joined, kind="stable")
        joined = joined[order]
        place = np.empty(parts, dtype=np.int32)
        place[order] = np.arange(parts, dtype=np.int32)
        left[step], right[step] = nodes
        order_left[step], order_right[step] = place, place[::-1]
        sums[n + step] = joined
        heapq.heappush(heap, (-int(joined[0] - joined[-1]), n + step))
    place_of: dict[int, np.ndarray] = {2 * n - 2: np.arange(parts, dtype=np.int32)}
    out = np.zeros(n, dtype=np.int64)
    for step in range(n - 2, -1, -1):
        final = place_of.pop(n + step)
        for node, places in ((left[step], order_left[step]), (right[step], order_right[step])):
            if node < n:
                out[node] = final[places[0]]
            else:
                place_of[int(node)] = final[places]
    return out


def _blocks(items: DataFrame, level: int, blocks: int, parts: int) -> DataFrame:
    """(item, size, parent): each block's items with the part that they become."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "item"], ascending=[False, True])
        part = differencing(rows["size"].to_numpy(dtype=np.int64), parts)
        parent = [f"{level}:{b}:{p}" for b, p in zip(rows["block"], part)]
        return pd.DataFrame({"item": rows["item"], "size": rows["size"], "parent": parent})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(run, "item string, size bigint, parent string")


def _last(items: DataFrame, shards: int) -> DataFrame:
    """(item, shard) of boundedly many items, in one run."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [f for f in frames if len(f)]
        if got:
            rows = pd.concat(got).sort_values(["size", "item"], ascending=[False, True])
            yield pd.DataFrame({"item": rows["item"], "shard": differencing(rows["size"].to_numpy(dtype=np.int64), shards)})

    return items.coalesce(1).mapInPandas(run, "item string, shard int")


def assign(items: DataFrame, shards: int, limit: int = 30_000, block: int = 4096, parts: int = 64, fill: int = 6000) -> DataFrame:
    """(item, shard) for distinct items (item string, size bigint)."""
    levels: list[DataFrame] = []
    rest = items.select("item", F.col("size").cast("bigint").alias("size"))
    level = 0
    while True:
        rest = stage_table(rest, f"shards/items{level}")
        count, total = rest.agg(F.count(F.lit(1)), F.sum("size")).first()
        if count <= limit:
            break
        large = total // (shards * 64) + 1  # at most shards * 64 items reach it
        draw = F.pmod(F.xxhash64("item", F.lit(99)), F.lit(1 << 40))
        up = (F.col("size") >= large) | (draw < int(fill / count * (1 << 40)))
        if level:
            up = up | ~F.col("item").startswith(f"{level - 1}:")  # what came up as it was stays so
        marked = rest.withColumn("up", up)
        blocks = -(-count // block)
        lower = _blocks(marked.filter("not up").drop("up"), level, blocks, parts)
        lower = stage_table(lower, f"shards/parts{level}")
        levels.append(lower.select("item", "parent"))
        rest = marked.filter("up").drop("up").unionByName(
            lower.groupBy("parent").agg(F.sum("size").alias("size")).withColumnRenamed("parent", "item")
        )
        level += 1
    found = stage_table(_last(rest, shards), "shards/last")
    for k in range(len(levels) - 1, -1, -1):
        parents = found.filter(F.col("item").startswith(f"{k}:"))
        inner = levels[k].join(parents.withColumnRenamed("item", "parent"), "parent").select("item", "shard")
        found = stage_table(found.filter(~F.col("item").startswith(f"{k}:")).unionByName(inner), f"shards/found{k}")
    return found


def numbered(df: DataFrame, group: str, key: str, slot: str = "slot", rows: int = 100_000) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each group, without a gap.

    Rows of a group are split by hash of the key into buckets of about ``rows``
    rows; a bucket's numbers start behind the rows of the buckets before it.
    """
    buckets = max(1, -(-df.count() // rows))
    split = df.withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    counts = split.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "__bucket", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__start"))
    within = Window.partitionBy(group, "__bucket").orderBy(key)
    return (
        split.join(starts, [group, "__bucket"])
        .withColumn(slot, F.col("__start") + F.row_number().over(within) - 1).drop("__bucket", "__start")
    )


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document; sizes of shards near equal."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + F.lit(overhead)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("item"),
    )
    rows = stage_table(rows, "shards/rows")
    placed = assign(rows.groupBy("item").agg(F.sum("size").alias("size")), shards)
    sharded = rows.join(placed, "item").select("doc_id", "size", "text_crc32", "shard")
    return numbered(stage_table(sharded, "shards/rows_placed"), "shard", "doc_id")
