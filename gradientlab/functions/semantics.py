"""Missing-value semantics of statistical data frames as Spark column expressions.

The survey data were defined in an environment where a missing value is a value
of its own: it survives ``not in`` filters, prints as ``NA`` in pasted keys,
poisons plain sums and equals itself in joins.  Spark follows SQL.  Every place
where the two differ is covered by one helper here.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- sums and means ---------------------------------------------------------

def sum_strict(c: ColumnLike) -> Column:
    """Aggregate sum that is NULL as soon as one input is NULL."""
    c = as_col(c)
    return F.when(F.count_if(c.isNull()) == 0, F.sum(c))


def sum_zero(c: ColumnLike) -> Column:
    """Aggregate sum that skips NULL and is 0 for all-NULL groups."""
    c = as_col(c)
    return F.coalesce(F.sum(c), F.lit(0).cast("double"))


def pooled_mean(*cols: ColumnLike) -> Column:
    """Aggregate mean over the values of several columns taken together."""
    total = reduce(lambda a, b: a + b, [sum_zero(c) for c in cols])
    n = reduce(lambda a, b: a + b, [F.count(as_col(c)) for c in cols])
    return F.try_divide(total, n)


def row_sum(*cols: ColumnLike) -> Column:
    """Horizontal sum, NULL counted as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_mean(*cols: ColumnLike) -> Column:
    """Horizontal mean that is NULL when any input is NULL."""
    return reduce(lambda a, b: a + b, [as_col(c).cast("double") for c in cols]) / F.lit(float(len(cols)))


# -- predicates -------------------------------------------------------------

def not_in(c: ColumnLike, values: Iterable) -> Column:
    """``not in`` that keeps NULL rows."""
    c = as_col(c)
    values = list(values)
    if not values:
        return F.lit(True)
    return c.isNull() | ~c.isin(values)


# -- scalars ----------------------------------------------------------------

def paste(*cols: ColumnLike, sep: str = "_") -> Column:
    """Join texts with ``sep``; a NULL part prints as ``NA`` and the result is never NULL."""
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("NA")) for c in cols])


def number_text(c: ColumnLike) -> Column:
    """Text of a number without a trailing ``.0`` and without an exponent."""
    text = as_col(c).cast("string")
    whole, exact = text.try_cast("double"), text.try_cast("decimal(38,18)")
    bare = F.regexp_replace(F.regexp_replace(exact.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    plain = F.coalesce(F.when(F.abs(whole) < 1e19, bare), whole.try_cast("decimal(38,0)").cast("string"), text)
    return F.when(text.rlike(r"[eE][+-]?\d+$") & whole.isNotNull(), plain).otherwise(F.regexp_replace(text, r"\.0+$", ""))


def pmax(c: ColumnLike, low: float) -> Column:
    """Lower bound that keeps NULL."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(float(low))))


def pmin(c: ColumnLike, high: float) -> Column:
    """Upper bound that keeps NULL."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.least(c, F.lit(float(high))))


def to_number(c: ColumnLike) -> Column:
    """Double value of a text, NULL when it is not a number."""
    value = F.trim(as_col(c).cast("string")).try_cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    """``a / b``, NULL on a zero or missing divisor."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def literal_map(mapping: Mapping) -> Column:
    parts = []
    for key, value in mapping.items():
        parts += [F.lit(key), F.lit(value)]
    return F.create_map(*parts)


def recode(c: ColumnLike, mapping: Mapping) -> Column:
    """Replace mapped values and keep all others."""
    c = as_col(c)
    if not mapping:
        return c
    return F.coalesce(F.try_element_at(literal_map(mapping), c), c)


def recode_to(c: ColumnLike, mapping: Mapping) -> Column:
    """Look values up; unmapped values become NULL (a recode that changes type)."""
    return F.try_element_at(literal_map(mapping), as_col(c))


def na_if(c: ColumnLike, *tokens: str) -> Column:
    c = as_col(c)
    return F.when(~c.isin(list(tokens)), c)


# -- optional columns -------------------------------------------------------

def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The named column if present, else a typed NULL."""
    return F.col(f"`{name}`").cast(dtype) if name in df.columns else F.lit(None).cast(dtype)


def all_but(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c not in names]


# -- null-safe joins --------------------------------------------------------

def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    how: str = "left",
    nulls_match: bool = True,
) -> DataFrame:
    """Equi-join in which NULL keys match each other (unless ``nulls_match`` is off).

    ``keys`` is a list of shared names or a mapping left name -> right name.
    The key columns appear once, under the left name.  No broadcast hint is
    given: the optimizer broadcasts a side only when its measured size is below
    the session threshold and otherwise hash-partitions both sides, where AQE
    splits skewed partitions.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    renamed = {r: f"__key_{i}" for i, r in enumerate(pairs.values())}
    rhs = right.withColumnsRenamed(renamed)
    cond = reduce(
        lambda a, b: a & b,
        [
            left[f"`{l}`"].eqNullSafe(rhs[f"`{renamed[r]}`"]) if nulls_match
            else left[f"`{l}`"] == rhs[f"`{renamed[r]}`"]
            for l, r in pairs.items()
        ],
    )
    joined = left.join(rhs, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return joined
    if how in ("right", "right_outer"):
        key_cols = [rhs[f"`{renamed[r]}`"].alias(l) for l, r in pairs.items()]
    elif how in ("full", "outer", "full_outer"):
        key_cols = [
            F.coalesce(left[f"`{l}`"], rhs[f"`{renamed[r]}`"]).alias(l) for l, r in pairs.items()
        ]
    else:
        key_cols = [left[f"`{l}`"] for l in pairs]
    rest_left = [left[f"`{c}`"] for c in left.columns if c not in pairs]
    rest_right = [rhs[f"`{c}`"] for c in rhs.columns if c not in renamed.values()]
    return joined.select(*key_cols, *rest_left, *rest_right)


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all shared column names, NULL equal to NULL."""
    shared = [c for c in left.columns if c in set(right.columns)]
    return null_safe_join(left, right, shared, "left")
