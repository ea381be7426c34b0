"""Joins with a declared cardinality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import null_safe_join, paste

CARDINALITIES = ("one-to-one", "many-to-one", "one-to-many", "many-to-many")


def once_per_key(df: DataFrame, keys: Sequence[str], side: str = "table") -> DataFrame:
    """The rows of ``df``, whose keys must be unique: a key that occurs twice raises an error that names it.

    The check is part of the plan.  Rows of a key are combined before the shuffle, also those of a hot key, and a join
    on the same keys finds its exchange made.  NULL is a key like any other.  Keys that a later filter drops
    aren't checked.
    """
    rest = [c for c in df.columns if c not in keys]
    row = [F.first(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__row")] if rest else []
    quoted = [F.col(f"`{k}`") for k in keys]
    grouped = df.groupBy(*quoted).agg(F.count(F.lit(1)).alias("__n"), *row)
    message = F.concat(
        F.lit(f"{side} has "), F.col("__n").cast("string"), F.lit(f" rows for ({', '.join(keys)}) = ("),
        paste(*quoted, sep=", "), F.lit(")"))
    checked = grouped.filter(F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`").alias(c) for c in df.columns])


def declared_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str] | Mapping[str, str], cardinality: str, how: str = "left"
) -> DataFrame:
    """``null_safe_join`` whose sides declared to be "one" must have unique keys, else an error names a key with its count.

    ``cardinality`` reads left to right: many-to-one has unique keys in ``right``.  Every key of such a side is checked, also
    one without a partner.  No job but that of the join is run.  See ``fan_out`` for many-to-many.
    """
    if cardinality not in CARDINALITIES:
        raise ValueError(f"cardinality {cardinality!r} is none of {', '.join(CARDINALITIES)}")
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    if cardinality.startswith("one"):
        left = once_per_key(left, list(pairs), "left")
    if cardinality.endswith("one"):
        right = once_per_key(right, list(pairs.values()), "right")
    return null_safe_join(left, right, pairs, how)


def fan_out(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys by which an inner join grows on both sides, as (keys, n_left, n_right, n_rows); no row of the join is made."""
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_left"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_right"))
    both = null_safe_join(a.filter("n_left > 1"), b.filter("n_right > 1"), keys, "inner")
    return both.withColumn("n_rows", F.col("n_left") * F.col("n_right"))
