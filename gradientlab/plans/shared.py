"""Rules used by both the community and the trait sheets of a region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..operators import community as C
from ..operators.community import Rule

LAUTARET_RULES = [
    Rule("Warm", label=("TP", "B"), dest=("L",)),
    Rule("Cold", label=("TP", "B"), dest=("G",)),
    Rule("LocalControl", label=("CP", "CTRL"), dest=("L", "G")),
]


def lautaret_sites(df: DataFrame, label: str) -> DataFrame:
    """Treatment and origin: transplants come from the other of the two sites."""
    df = C.assign_treatment(df, LAUTARET_RULES, label=label, origin=F.lit(None))
    other = S.recode_to("destSiteID", {"L": "G", "G": "L"})
    moved = F.col("Treatment").isin("Warm", "Cold")
    return df.withColumn("originSiteID", F.when(moved, other).when(F.col("Treatment").isNotNull(), F.col("destSiteID")))
