"""Near-duplicate documents by HyperMinHash sketches.

Words are the runs of characters other than ASCII white space, with A-Z in lower
case.  A document's set holds its different shingles of five words, as 64-bit
hashes; with fewer words the whole sequence is its only shingle, without words
the set is empty and linked with nothing.

Documents with equal sets are one item.  An item's sketch has ``REGISTERS``
buckets; of the smallest hash in a bucket it keeps the number of leading zeros (5
bits) and the 3 bits behind the first one.  An empty bucket borrows the register
of a filled one, the first in an order of its own, so that registers agree
independently of each other in small sets too.  The sketch is cut into bands of
registers spread over it; items that share a band are candidates.  Bands are as
long as they can be while a pair at the threshold misses all of them with a
probability of at most 1e-5 (9 registers at 0.85: 4e-7; 8 at 0.8: 8e-6).

Candidates are compared by the share of equal registers, corrected for the
registers that agree by chance; what may reach the threshold is verified on the
full sets.  The first round compares each item with one item of every bucket that it
is in, the hub: that which shares most buckets with others.  Copies that were edited
independently of each other are far from each other, but near to their base, and the
base is the one that shares a bucket with nearly all of them.  Links give components;
a bucket whose members are in one component is done, as is one of two members.  In
the others, further hub rounds compare what isn't in the bucket's largest component
with that component's hub, until a round adds no link.  Then exact rounds compare
it with all members of other components (a pair in the first bucket that both share):
each item with the most similar ones first, more in each round, until a round has
left no pair out that is in different components and may reach the threshold.  A shingle that
no other item of the open buckets has cannot be common to a pair: items with too many of
these for any link are left out before, and an item whose similar ones have all been given
asks no more.  So no link between components is
lost, and a group of many copies doesn't produce all its pairs.  Large buckets are
dealt into blocks, one task for each pair of blocks.

Null and empty texts have empty sets; very long texts are used whole.  Repeated
ids are documents of their own under one id; a component's id is its smallest.
An empty table gives no rows; other columns are left out (``keep_one`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import fresh
from .components import connected_components
from .ngrams import scrambled, slice_hashes

SHINGLE = 5
REGISTER_BITS = 9
REGISTERS = 1 << REGISTER_BITS
MISS = 1e-5
MANTISSA = 3
#: Bytes of text that are hashed at a time (or one text, if longer).
RUN = 1 << 17
#: Sketches say little about sets smaller than this; such pairs go straight to verification.
SMALL_SET = 32
#: As many ids at most are sent to all tasks to fetch their texts; more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Pairs at most that a task of the exact rounds lists.
UNIT_PAIRS = 1 << 21
#: Shingles in a batch of those that are counted (or one text, if longer).
BATCH_SHINGLES = 1 << 16
#: Shingles on either side of a unit in which pairs of the exact rounds are verified (or one text, if longer).
UNIT_SHINGLES = 1 << 20

SIGNATURE = "doc_id bigint, n_shingles bigint, key1 bigint, key2 bigint, sketch binary"


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted different shingle hashes of each text."""
    encoded = [t.encode() if t else b"" for t in texts]
    at = 0
    while at < len(encoded):
        end, size = at, 0
        while end < len(encoded) and (end == at or size + len(encoded[end]) <= RUN):
            size += len(encoded[end]) + 1
            end += 1
        yield from _run_sets(encoded[at:end])
        at = end


def _run_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends = _words(data)
    words = slice_hashes(data, starts, ends)
    factors = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k, 1 << 64)) for k in range(SHINGLE)]
    n = len(words)
    joined = np.zeros(max(n - SHINGLE + 1, 0), dtype=np.uint64)
    for k in range(SHINGLE if n >= SHINGLE else 0):
        joined += words[k : n - SHINGLE + 1 + k] * factors[k]
    joined = scrambled(joined)
    heads = np.cumsum([0, *[len(t) + 1 for t in texts]])
    bounds = np.searchsorted(starts, heads)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= SHINGLE:
            found = np.sort(joined[a : b - SHINGLE + 1])
            yield found[np.append(True, found[1:] != found[:-1])]
        elif b > a:
            yield scrambled((words[a:b] * np.array(factors[: b - a])).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone, as two signed numbers."""
    with np.errstate(over="ignore"):
        one = scrambled(hashes ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
        two = np.bitwise_xor.reduce(scrambled(hashes + np.uint64(0xE7037ED1A0B428DB)), initial=np.uint64(0))
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a non-empty sorted set."""
    shift = np.uint64(64 - REGISTER_BITS)
    bucket = (hashes >> shift).astype(np.int64)
    first = np.append(True, bucket[1:] != bucket[:-1])  # sorted, so the first of a bucket is its smallest
    filled, least = bucket[first], hashes[first] << np.uint64(REGISTER_BITS)
    # a double's exponent is exact for the position of the top bit once the low bits that could round up are gone
    top = np.frexp((least & ~(least >> np.uint64(1))).astype(np.float64))[1]  # bits in use
    zeros = np.minimum(64 - top, 31)
    mantissa = (least << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    value = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.int64)
    out = np.zeros(REGISTERS, dtype=np.uint8)
    out[filled] = value
    if len(filled) < REGISTERS:
        empty = np.flatnonzero(np.bincount(filled, minlength=REGISTERS) == 0)
        out[empty] = value[_preference()[np.ix_(empty, filled)].argmin(1)]
    return out


@lru_cache(maxsize=1)
def _preference() -> np.ndarray:
    """For each bucket the rank in which it would borrow from every other, at random but always the same."""
    draws = scrambled(np.arange(1, REGISTERS * REGISTERS + 1, dtype=np.uint64)).reshape(REGISTERS, REGISTERS)
    return draws.argsort(1).argsort(1).astype(np.uint16)


def band_size(least: float) -> int:
    """Registers in a band: the most at which a pair of similarity ``least`` is missed with probability ``MISS`` at most."""
    sizes = [r for r in range(2, 13) if (1 - least**r) ** (REGISTERS // r) <= MISS]
    return max(sizes, default=1)


@lru_cache(maxsize=4)
def _layout(size: int) -> np.ndarray:
    """Which registers make each band."""
    order = np.argsort(scrambled(np.arange(1, REGISTERS + 1, dtype=np.uint64)), kind="stable")
    return order[: REGISTERS // size * size].reshape(-1, size)


def band_hashes(sketches: np.ndarray, size: int) -> np.ndarray:
    """(rows, bands) hashes; equal registers in another band hash otherwise."""
    picked = sketches[:, _layout(size)].astype(np.uint64)
    out = np.broadcast_to(np.arange(1, picked.shape[1] + 1, dtype=np.uint64), picked.shape[:2]).copy()
    for k in range(size):
        out = scrambled(out * np.uint64(0x9E3779B97F4A7C15) + picked[:, :, k])
    return out.view(np.int64)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of unrelated sets of n and m shingles agree."""
    level = np.arange(32)
    load = lambda x: np.maximum(np.asarray(x, dtype=np.float64) / REGISTERS, 1)[..., None]

    def zeros(x: np.ndarray) -> np.ndarray:
        beyond = (1 - 0.5 ** level) ** load(x)  # the least is below 2**-level: 1 minus this
        return (1 - beyond) - np.append((1 - beyond)[..., 1:], np.zeros((*beyond.shape[:-1], 1)), axis=-1)

    return (zeros(n) * zeros(m)).sum(-1) / (1 << MANTISSA)


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, less those that agree by chance."""
    by_chance = chance(n, m)
    return (equal / REGISTERS - by_chance) / (1 - by_chance)


def may_link(equal: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """Whether a pair may reach the similarity: sizes allow it, and the estimate is not five deviations below.

    The deviation is that of independent registers, and a quarter more for those that are borrowed.
    """
    small, large = np.minimum(n, m), np.maximum(n, m)
    margin = 5 * 1.25 * np.sqrt(least * (1 - least) / REGISTERS)
    return (small >= least * large - 1e-9) & ((small < SMALL_SET) | (estimate(equal, n, m) >= least - margin))


def signatures(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ones, twos, sketches = [], [], [], []
            for found in shingle_sets(batch.column("text").to_pylist()):
                one, two = set_key(found)
                counts.append(len(found))
                ones.append(one)
                twos.append(two)
                sketches.append(sketch(found).tobytes() if len(found) else b"")
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ones, pa.int64()),
                pa.array(twos, pa.int64()), pa.array(sketches, pa.binary()),
            ], names=["doc_id", "n_shingles", "key1", "key2", "sketch"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SIGNATURE)


def _bands(items: DataFrame, size: int) -> DataFrame:
    """(band, item) for every item and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                found = band_hashes(_sketch_rows(batch.column("sketch")), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.ravel()), pa.array(np.repeat(batch.column("item").to_numpy(), found.shape[1]))], names=["band", "item"])

    return items.select("item", "sketch").mapInArrow(run, "band bigint, item bigint")


def _sketch_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, REGISTERS)


def _estimated(pairs: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sketches allow the similarity."""
    side = lambda k: items.select(
        F.col("item").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("sketch").alias(f"sketch_{k}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                equal = (_sketch_rows(batch.column("sketch_a")) == _sketch_rows(batch.column("sketch_b"))).sum(1)
                keep = may_link(equal, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), least)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).filter(pa.array(keep)) for k in ("a", "b")], names=["a", "b"])

    return rows.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a bigint, b bigint")


def _texts(items: DataFrame, docs: DataFrame) -> DataFrame:
    """(item, text) of each item."""
    wanted = items.select("item", "first_id", "key1", "key2")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("first_id")))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a repeated id has several texts; the item's are those with its set
        for batch in batches:
            keys = zip(batch.column("key1").to_pylist(), batch.column("key2").to_pylist())
            keep = pa.array([set_key(s) == k for s, k in zip(shingle_sets(batch.column("text").to_pylist()), keys)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in ("item", "text")], names=["item", "text"])

    return rows.select("item", "text", "key1", "key2").mapInArrow(own, "item bigint, text string")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs that the full sets of both texts link."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(shingle_sets(batch.column("text_a").to_pylist()), shingle_sets(batch.column("text_b").to_pylist())):
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common) and common > 0)
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in ("a", "b")], names=["a", "b"])

    side = lambda k: texts.select(F.col("item").alias(k), F.col("text").alias(f"text_{k}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(compare, "a bigint, b bigint")


def _verified_in_units(pairs: DataFrame, items: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (x, y) that the full sets of both texts link.

    Where few items x are compared with many y each, the pairs are dealt into units of about ``UNIT_SHINGLES`` shingles on
    either side, so that a text is sent once to a unit, not once for each of its pairs.
    """
    weight = lambda k: items.join(pairs.select(F.col(k).alias("item")).distinct(), "item").agg(F.sum("n_shingles")).first()[0] or 0
    units = {k: max(1, -(-weight(k) // UNIT_SHINGLES)) for k in ("x", "y")}
    dealt = pairs.withColumns({f"{k}_unit": F.pmod(F.xxhash64(k, F.lit(3)), F.lit(n)) for k, n in units.items()})
    unit = ["x_unit", "y_unit"]
    side = lambda k: texts.select(F.col("item").alias(k), F.col("text").alias(f"text_{k}"))
    known = dealt.select(F.col("x_unit").alias("u"), F.col("y_unit").alias("v"), "x").distinct().join(side("x"), "x")
    asked = dealt.groupBy(*unit, "y").agg(F.collect_list("x").alias("xs")).join(side("y"), "y")

    def compare(known: pa.Table, asked: pa.Table) -> pa.Table:
        sets = dict(zip(known.column("x").to_pylist(), shingle_sets(known.column("text_x").to_pylist())))
        a, b = [], []
        for y, xs, own in zip(asked.column("y").to_pylist(), asked.column("xs").to_pylist(), shingle_sets(asked.column("text_y").to_pylist())):
            for x in xs:
                common = len(np.intersect1d(sets[x], own, assume_unique=True))
                if common > 0 and 100 * common >= percent * (len(sets[x]) + len(own) - common):
                    a.append(x)
                    b.append(y)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return known.groupBy("u", "v").cogroup(asked.groupBy(*unit)).applyInArrow(compare, "a bigint, b bigint")


def _hubs(rows: DataFrame) -> DataFrame:
    """(band, hub): of each bucket the item that shares most buckets."""
    hubs = rows.groupBy("band").agg(F.max(F.struct("degree", "item")).alias("top")).select("band", F.col("top.item").alias("hub"))
    return stage_table(hubs, "minhash/hubs")  # written, so that the optimizer may split a bucket that is joined with its hub


def _with_hubs(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """The different pairs (a, b) of an item and the hub of one of its buckets."""
    return rows.join(hubs, "band").filter("item <> hub").select(
        F.least("item", "hub").alias("a"), F.greatest("item", "hub").alias("b")).distinct()


def _still_open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (band, item, degree) of buckets with members in different components.

    With the item's component, the bucket's ``largest`` component, its members (``n``) and those outside of it (``rest``).
    """
    held = rows.join(labels, "item")
    sizes = held.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = sizes.groupBy("band").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("parts"))
    buckets = stage_table(buckets.filter("parts > 1").select(
        "band", F.col("top.component").alias("largest"), "n", (F.col("n") - F.col("top.n")).alias("rest")), "minhash/buckets")
    return stage_table(held.join(buckets, "band"), "minhash/open")


def _shingles(texts: DataFrame) -> DataFrame:
    """(item, shingle) of each shingle hash in an item's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            ids = np.repeat(np.array(items, dtype=np.int64), [len(x) for x in sets])
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets).view(np.int64))], names=["item", "shingle"])

        for batch in batches:
            items, sets, size = [], [], 0
            for item, found in zip(batch.column("item").to_pylist(), shingle_sets(batch.column("text").to_pylist())):
                items.append(item)
                sets.append(found)
                size += len(found)
                if size >= BATCH_SHINGLES:
                    yield rows()
                    items, sets, size = [], [], 0
            if items:
                yield rows()

    return texts.select("item", "text").mapInArrow(run, "item bigint, shingle bigint")


def _enough(least: float, fewest: Column) -> Column:
    """Whether an item may reach the similarity with one that has at least ``fewest`` shingles of its own."""
    return F.col("n_shingles") - F.col("own") >= least * (F.col("n_shingles") + fewest) - 1e-9


def _with_bucket(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """The rows with what is known of their band; written first, so that the optimizer may split a bucket's rows."""
    return rows.join(stage_table(buckets, "minhash/bounds"), "band")


def _beside(rows: DataFrame, least: float) -> DataFrame:
    """The rows of buckets in which some ask: those that ask, and those that may link with one by its size and own shingles."""
    asking = rows.filter("asks").groupBy("band").agg(
        F.min("own").alias("fewest"), F.min("n_shingles").alias("smallest"), F.max("n_shingles").alias("greatest"))
    fits = _enough(least, F.col("fewest")) & (F.col("n_shingles") >= least * F.col("smallest") - 1e-9) & (
        least * F.col("n_shingles") <= F.col("greatest") + 1e-9)
    return _with_bucket(rows, asking).filter(F.col("asks") | fits).drop("fewest", "smallest", "greatest")


def _linkable(open_rows: DataFrame, items: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The open rows (band, item, component, n_shingles, own, asks, n) that a link between components may need.

    ``own`` counts the item's shingles that no other item of the open rows has.  A pair has at most the other
    shingles of either in common, and at least these and the own ones of both in its union.  In each bucket,
    what fails this with the fewest own shingles of any member has no link there; ``asks`` are those outside of the
    largest component that pass, and what fails with the fewest of those that ask needs no place beside them.
    A pair that passes does so in every bucket that both share.  ``n`` are the rows that stay in the bucket.
    """
    asked = open_rows.select("item").distinct()
    single = _shingles(texts.join(asked, "item")).groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("item").alias("item")).filter("n = 1")
    own = stage_table(single.groupBy("item").agg(F.count(F.lit(1)).alias("own")), "minhash/own")
    sized = asked.join(items.select("item", "n_shingles"), "item").join(own, "item", "left").select(
        "item", "n_shingles", F.coalesce("own", F.lit(0)).alias("own"))
    sized = stage_table(sized.filter(_enough(least, F.lit(0))), "minhash/sized")
    rows = stage_table(open_rows.select("band", "item", "component", "largest").join(sized, "item"), "minhash/sized")
    rows = _with_bucket(rows, rows.groupBy("band").agg(F.min("own").alias("fewest"))).select(
        "band", "item", "component", "n_shingles", "own",
        ((F.col("component") != F.col("largest")) & _enough(least, F.col("fewest"))).alias("asks"))
    rows = stage_table(_beside(stage_table(rows, "minhash/bounded"), least), "minhash/beside")
    return stage_table(_with_bucket(rows, rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"))), "minhash/linkable")


def _asking(rows: DataFrame, near: DataFrame, least: float) -> DataFrame:
    """The rows of ``_linkable`` that are still needed where those alone ask that ``near`` says there is more for."""
    more = near.filter("more_a").select(F.col("a").alias("item")).unionByName(
        near.filter("more_b").select(F.col("b").alias("item"))).distinct().withColumn("again", F.lit(True))
    again = rows.join(more, "item", "left").withColumn("asks", F.col("asks") & F.coalesce("again", F.lit(False))).drop("again")
    return stage_table(_beside(stage_table(again, "minhash/again"), least), "minhash/asking")


def _across(
    open_rows: DataFrame, labels: DataFrame, items: DataFrame, least: float, given: int, most: int, block: int = 4096
) -> DataFrame:
    """(a, b, x, more_a, more_b) of items that share a bucket, are in different components and may be similar enough.

    ``open_rows`` are those of ``_linkable``, later without what no asking item may link with, so that the order in which
    one is given the others stays the same in all rounds; ``labels`` are the components by now.  Each item that asks is given with its
    ``most`` most similar ones (of each block) but the first ``given``, which an earlier round has
    given, and those that have come into its component; ``more_a`` and ``more_b`` say that there are others for a or b,
    ``x`` is the item that was given the other.
    A pair is given in the first band that both share.
    """
    size = band_size(least)
    asking = max(1, min(block, UNIT_PAIRS // min(most, block)))  # items of a unit, each with up to ``most`` pairs
    named = open_rows.join(labels.withColumnRenamed("component", "current"), "item")
    parts = named.groupBy("band").agg(
        F.min("current").alias("low"), F.max("current").alias("high"), F.count_if("asks").alias("rest"))
    still = parts.filter("low < high and rest > 0").select("band", "rest")
    named = named.join(stage_table(still, "minhash/bands"), "band")  # still open
    rows = named.join(items.select("item", "sketch"), "item").withColumns({
        "blocks": F.ceil(F.col("n") / block).cast("int"), "rest_blocks": F.ceil(F.col("rest") / asking).cast("int")})
    draw = lambda n: F.pmod(F.xxhash64("item", "band"), n).cast("int")
    columns = ["band", "item", "component", "current", "n_shingles", "own", "sketch"]
    asks = rows.filter("asks").select(
        *columns, draw(F.col("rest_blocks")).alias("row_block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("column_block"), F.lit(True).alias("asks"))
    told = rows.select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("row_block"),
        draw(F.col("blocks")).alias("column_block"), F.lit(False).alias("asks"))

    def run(unit: pa.Table) -> pa.Table:
        asks = unit.column("asks").to_numpy()
        item, component, current = (unit.column(c).to_numpy() for c in ("item", "component", "current"))
        n, sketches = unit.column("n_shingles").to_numpy(), _sketch_rows(unit.column("sketch").combine_chunks())
        open_ones = n - unit.column("own").to_numpy()  # what they may have in common with others
        band = int(np.flatnonzero(band_hashes(sketches[:1], size)[0] == unit.column("band")[0].as_py())[0])
        earlier = _layout(size)[:band]
        theirs = np.flatnonzero(~asks)
        ones, others, more = [], [], []
        for i in np.flatnonzero(asks).tolist():
            apart = theirs[component[theirs] != component[i]]
            common = np.minimum(open_ones[apart], open_ones[i])
            apart = apart[common >= least * (n[apart] + n[i] - common) - 1e-9]
            equal = np.concatenate([
                (sketches[apart[k : k + 1024]] == sketches[i]).sum(1) for k in range(0, len(apart), 1024)] or [np.zeros(0, dtype=int)])
            may = np.flatnonzero(may_link(equal, n[apart], np.full(len(apart), n[i]), least))
            best = may[np.argsort(-equal[may], kind="stable")]
            if band:
                first = ~(sketches[apart[best]] == sketches[i])[:, earlier].all(2).any(1)
                best = best[first]
            told = apart[best[given:most]]
            told = told[current[told] != current[i]]
            left = apart[best[most:]]
            left = left[current[left] != current[i]]
            if not len(told):  # so that some row says there are more
                told = left[:1]
            ones.append(np.full(len(told), item[i]))
            others.append(item[told])
            more.append(np.full(len(told), len(left) > 0))
        one, other = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (ones, others))
        return pa.table({
            "a": pa.array(np.minimum(one, other)), "b": pa.array(np.maximum(one, other)), "x": pa.array(one),
            "more": pa.array(np.concatenate([np.zeros(0, dtype=bool), *more])),
        })

    found = asks.unionByName(told).groupBy("band", "row_block", "column_block").applyInArrow(
        run, "a bigint, b bigint, x bigint, more boolean")
    return found.groupBy("a", "b").agg(F.min("x").alias("x"), *[
        F.max(F.col("more") & (F.col("x") == F.col(k))).alias(f"more_{k}") for k in ("a", "b")])


def near_duplicates(docs: DataFrame, percent: int = 80, most: int = 4) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; ``percent`` is the least similarity of a link."""
    least = percent / 100
    size = band_size(least)
    rows = stage_table(signatures(docs), "minhash/rows")
    keys = ["key1", "key2", "n_shingles"]
    # the ids of items are fixed by writing them
    items = stage_table(
        rows.filter("n_shingles > 0").groupBy(*keys).agg(F.min("doc_id").alias("first_id"), F.min("sketch").alias("sketch"))
        .select(F.monotonically_increasing_id().alias("item"), "first_id", *keys, "sketch"), "minhash/items")
    bands = _bands(items, size)
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stage_table(bands.join(sizes, "band"), "minhash/members")
    degrees = members.groupBy("item").agg(F.sum(F.col("n") - 1).alias("degree"))
    members = stage_table(members.join(degrees, "item"), "minhash/ranked")
    # sketches and texts of what shares a bucket with something are fetched once
    shared = stage_table(items.join(members.select("item").distinct(), "item"), "minhash/shared")
    texts = stage_table(_texts(shared, docs), "minhash/texts")
    compared = stage_table(_estimated(_with_hubs(members, _hubs(members)), shared, least), "minhash/pairs")
    parts = connected_components(_verified(compared, texts, percent))

    def labelled() -> DataFrame:
        return stage_table(
            shared.select("item").join(parts.withColumnRenamed("node", "item"), "item", "left")
            .select("item", F.coalesce("component", "item").alias("component")), "minhash/labels")

    def linked(links: DataFrame) -> DataFrame:
        return connected_components(links.unionByName(parts.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    now = members.filter("n > 2").select("band", "item", "degree")  # a bucket of two has the pair with its hub alone
    hubs_left, given = True, 0
    while True:
        labels = labelled()
        if not given:  # components only grow: buckets that are done stay so
            now = _still_open(now.select("band", "item", "degree"), labels)
        if hubs_left:
            found = _with_hubs(now.filter("component <> largest"), _hubs(now.filter("component = largest")))
            new = stage_table(_estimated(found.join(compared, ["a", "b"], "left_anti"), shared, least), "minhash/new")
            links = _verified(new, texts, percent)
        else:
            if not given:
                now = _linkable(now, shared, texts, least)
            near = stage_table(_across(now, labels, shared, least, given, most), "minhash/near")
            new = stage_table(near.join(compared, ["a", "b"], "left_anti"), "minhash/new")
            pairs = new.select("x", F.when(F.col("x") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("y"))
            links = _verified_in_units(pairs, shared, texts, percent)
        links = stage_table(links, "minhash/links")
        compared = stage_table(compared.unionByName(new.select("a", "b")), "minhash/pairs")
        some = not links.isEmpty()
        if some:
            parts = linked(links)
        if not hubs_left:
            if near.filter("more_a or more_b").isEmpty():
                break
            now = _asking(now, near, least)
            given, most = most, most * 128
        hubs_left = hubs_left and some
    named = items.select("item", "first_id", *keys).join(parts.withColumnRenamed("node", "item"), "item", "left").select(
        "first_id", *keys, F.coalesce("component", "item").alias("component"))
    named = stage_table(named, "minhash/named")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = stage_table(named.join(smallest, "component").select(*keys, "component_id"), "minhash/ids")
    return rows.filter("n_shingles > 0").select("doc_id", *keys).join(ids, keys).select(
        "doc_id", "n_shingles", "component_id"
    ).unionByName(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: that of the smallest id.

    Of rows that share an id and are kept, one stays if they share their text.
    """
    key, tie = fresh(docs, "other_id", "other_text")
    found = near_duplicates(docs, percent).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    ids = stage_table(found.groupBy(F.col("doc_id").alias(key)).agg(
        F.count_if("kept").alias("kept")).filter("kept <> 1"), "minhash/ids")  # fewer than the ids that one row keeps
    dropped, many = ids.filter("kept = 0").select(key), ids.filter("kept > 1").select(key)
    rows = docs.join(dropped, docs["doc_id"].eqNullSafe(dropped[key]), "left_anti")
    if many.isEmpty():
        return rows
    once = rows.join(many, rows["doc_id"].eqNullSafe(many[key]), "left_anti")
    again = rows.join(many, rows["doc_id"].eqNullSafe(many[key]), "left_semi")
    again = again.withColumn(tie, F.xxhash64("text")).dropDuplicates(["doc_id", tie]).drop(tie)
    return once.unionByName(again)
