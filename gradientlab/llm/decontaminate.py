"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

Tokens are the runs of letters and numbers of the lower-cased text.  A document
overlaps an item if, at some alignment, 12 consecutive tokens of it agree with
the item's in at least 10 places.  Shorter items are held to their length: one of 8
to 11 tokens must occur whole with at most one substitution, one of 6 or 7 tokens
whole and unchanged.  An item of up to 5 tokens says little inside a sentence; it must
be the whole of a line.

Masks look at some positions and ignore the rest:

    111111
    111000111
    111000000111
    1111            for items of 8 to 11 tokens

Cut 12 tokens into four threes: two substitutions leave at least two threes
untouched, and whichever two those are, one of the first masks fits them at some
position.  One substitution in 8 to 11 tokens leaves the first four or the last four
untouched, so the last mask is put there alone.  So no overlap escapes the seeds.
Documents and items are joined on the hashes of their seeds, hits are reduced to
(document, item, alignment), and each is verified on the whole item.  Lines are
joined with the shortest items on the hash of their tokens, and compared.  What only
short items need is left out where the benchmark has none.

The benchmark's seeds are sent to all tasks only if they are at most
``BROADCAST_ROWS``; more are joined by shuffle.  Documents are exploded into
(id, place, seed) only, and hits are made distinct before they are shuffled.

Null texts count as empty; empty texts and texts without tokens overlap nothing.
Items with equal tokens count once, under their smallest id; null item ids
count as any other.  Rows with a null or a repeated doc_id are judged by
themselves and reported under their id: an id is contaminated if one of its rows
is.  An empty benchmark leaves everything clean, an empty table gives no rows.
Other columns are left out of the findings and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import fresh

MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 6, 7, 8), (0, 1, 2, 9, 10, 11))
SHORT_MASK = (0, 1, 2, 3)
#: Items of so many tokens at least overlap by a window, with one substitution, anywhere; shorter ones as a line.
WINDOW, TOLERANT, SHORTEST = 12, 8, 6
AGREE = 10
BROADCAST_ROWS = 500_000


def token_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` (or a lambda in it) names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _seeds(tokens: Column, mask: tuple[int, ...], number: int) -> Column:
    """(place, seed) wherever the mask fits."""
    places = F.size(tokens) - mask[-1]
    return F.when(places > 0, F.transform(
        F.sequence(F.lit(0), places - 1),
        lambda i: F.struct(
            i.alias("place"), F.xxhash64(F.lit(number), *[F.get(tokens, i + F.lit(k)) for k in mask]).alias("seed")
        ),
    )).otherwise(F.array().cast("array<struct<place:int,seed:bigint>>"))


def seeded(df: DataFrame, key: str, tokens: Column, short: bool) -> DataFrame:
    """(key, place, seed): one row per mask and place; with ``short`` for the mask of shorter items, too."""
    masks = (*MASKS, SHORT_MASK) if short else MASKS
    every = once(tokens, lambda t: F.concat(*[_seeds(t, m, k) for k, m in enumerate(masks)]))
    return df.select(key, F.explode(every).alias("s")).select(key, "s.place", "s.seed")


def _agreeing(doc: Column, item: Column, shift: Column) -> Column:
    """Places of the item at which the document, from ``shift`` on, has the same token."""
    return once(F.struct(doc.alias("d"), item.alias("i")), lambda x: F.filter(
        F.sequence(F.lit(0), F.size(x["i"]) - 1), lambda j: F.get(x["d"], shift + j) == F.get(x["i"], j)
    ))


def _overlaps(same: Column, length: Column) -> Column:
    """Whether enough of the agreeing places stand close together."""
    need = F.when(length < TOLERANT, length).when(length < WINDOW, length - 1).otherwise(F.lit(AGREE))
    return once(same, lambda p: F.struct(F.size(p).alias("agreeing"), F.when(F.size(p) >= need, F.exists(
        F.sequence(F.lit(0), F.size(p) - need), lambda k: F.get(p, k + need - 1) - F.get(p, k) < F.lit(WINDOW)
    )).otherwise(F.lit(False)).alias("close")))


def _item_seeds(items: DataFrame) -> DataFrame:
    """(item, item_place, seed) by which documents find items of at least ``SHORTEST`` tokens."""
    size = F.size("item_tokens")
    long = seeded(items.filter(~size.between(TOLERANT, WINDOW - 1)), "item", F.col("item_tokens"), False)
    short = items.filter(size.between(TOLERANT, WINDOW - 1)).select("item", F.explode(F.filter(
        _seeds(F.col("item_tokens"), SHORT_MASK, len(MASKS)),
        lambda s: s["place"].isin(0) | (s["place"] == size - len(SHORT_MASK)))).alias("s")).select("item", "s.place", "s.seed")
    return long.unionByName(short).withColumnRenamed("place", "item_place")


def _as_lines(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, shift, agreeing) of the lines that are the whole of an item of fewer than ``SHORTEST`` tokens."""
    lines = docs.select("doc_id", F.explode(F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"), token_hashes)).alias("line"))
    lines = lines.filter(F.size("line").between(1, SHORTEST - 1)).withColumn("item", F.xxhash64("line"))
    same = lines.join(items, "item").filter(F.col("line") == F.col("item_tokens"))
    return same.select("doc_id", "item_id", F.lit(None).cast("int").alias("shift"), F.size("line").alias("agreeing")).distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, shift (place of the item's start in the document) and agreeing (number of equal tokens).

    Items that are a whole line have no shift.
    """
    items = (
        benchmark.select("item_id", token_hashes(F.col("text")).alias("item_tokens"))
        .filter(F.size("item_tokens") > 0).groupBy("item_tokens").agg(F.min("item_id").alias("item_id"))
        .withColumn("item", F.xxhash64("item_tokens"))
    )
    every = stage_table(items, "benchmark/items")
    items = every.filter(F.size("item_tokens") >= SHORTEST)
    kinds = every.agg(
        F.count_if(F.size("item_tokens") < SHORTEST).alias("lines"),
        F.count_if(F.size("item_tokens").between(TOLERANT, WINDOW - 1)).alias("short")).first()
    seeds = stage_table(_item_seeds(items), "benchmark/seeds")
    small = seeds.count() <= BROADCAST_ROWS
    send = F.broadcast if small else (lambda df: df)

    hits = (
        seeded(docs.select("doc_id", "text"), "doc_id", token_hashes(F.col("text")), kinds["short"] > 0).join(send(seeds), "seed")
        .select("doc_id", "item", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    )
    hits = stage_table(hits, "benchmark/hits").withColumnRenamed("doc_id", "hit_id")
    found = (
        docs.select("doc_id", "text").join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id"))).drop("hit_id")
        .join(send(items), "item")
        .select("doc_id", "item_id", "shift", _overlaps(
            _agreeing(token_hashes(F.col("text")), F.col("item_tokens"), F.col("shift")), F.size("item_tokens")
        ).alias("found"))
    )
    found = found.filter("found.close").select("doc_id", "item_id", "shift", "found.agreeing")
    if kinds["lines"]:
        found = found.unionByName(_as_lines(docs, every.filter(F.size("item_tokens") < SHORTEST)))
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated id: doc_id, n_items, first_item, most_agreeing."""
    return overlaps(docs, benchmark).groupBy("doc_id").agg(
        F.countDistinct(F.struct("item_id")).alias("n_items"), F.min("item_id").alias("first_item"),
        F.max("agreeing").cast("bigint").alias("most_agreeing"),
    )


def flag(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, first_item and most_agreeing of every row."""
    found = stage_table(contaminated(docs, benchmark), "benchmark/found").withColumnRenamed("doc_id", "found_id")
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "first_item", "most_agreeing",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose id is not contaminated, with all their columns."""
    (key,) = fresh(docs, "found_id")
    found = stage_table(contaminated(docs, benchmark).select(F.col("doc_id").alias(key)), "benchmark/found")
    return docs.join(found, docs["doc_id"].eqNullSafe(found[key]), "left_anti")
