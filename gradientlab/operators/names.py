"""Grammar of taxon names, and resolution by canonical form from the lowest rank up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extract, squish
from ..session import stage_table
from .taxonomy import resolve_names

# Marks of ranks below the species and the form they are given here.
RANK_MARKS = {
    "subsp": "subsp", "ssp": "subsp", "subvar": "subvar", "var": "var", "forma": "f", "fo": "f", "f": "f", "cv": "cv",
}
# Lower-case words of a name that are no epithets.
NO_EPITHETS = [
    *RANK_MARKS, "sp", "spp", "spec", "species", "indet", "ex", "et", "and", "in", "fil", "de", "del", "der", "van", "von",
]
_EPITHET = r"(?!(?:" + "|".join(NO_EPITHETS) + r")(?:[\s.]|$))\p{Ll}[\p{Ll}-]+(?=[\s,]|$)"
_MARKED = r"(?:^|\s)(" + "|".join(RANK_MARKS) + r")\.?\s+(" + _EPITHET + ")"
_DOUBT = r"(?i)(?:^|\s)(cf|aff)\.?(?=\s)"
_OPEN = r"^(?:spp|sp|species|spec|indet)(?:\.|(?=\s)|$)\s*"


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def parse_names(df: DataFrame, col: str, out: str = "parsed") -> DataFrame:
    """Add a struct with the parts of the name in ``col``.

    Fields: ``genus``; ``epithets`` from the species down; ``ranks``, one for the genus and for each epithet (``infra``
    where a third word has no mark); ``authors`` as written; ``hybrid``; ``qualifier`` (cf or aff); ``canonical``; and
    ``forms``, the lower-case canonical forms from the lowest rank up to the genus.

    ``cf.`` keeps the epithet it doubts.  ``aff.`` denies it, ``sp.`` has none, and a formula of two parents has two, so
    these three stand for the genus; the authors of aff. and of a formula are not told.  A text whose first word isn't made of letters (an empty one too) and a missing name
    have no genus and no forms.
    """
    text = squish(F.regexp_replace(F.regexp_replace(F.col(f"`{col}`"), r"(^|\s)[xX](?=\s)", "$1×"), "×", " × "))
    df1 = df.withColumn("__text", text)
    bare = squish(F.regexp_replace(F.regexp_replace("__text", "×", " "), _DOUBT, ""))
    df2 = df1.withColumns({
        "__hybrid": F.col("__text").contains("×"),
        "__formula": F.col("__text").rlike(r"\S × \p{Lu}"),
        "__doubt": F.lower(extract(F.regexp_replace("__text", "×", " "), _DOUBT, 1)),
        "__bare": bare,
    })
    df3 = df2.withColumns({
        "__genus": extract("__bare", r"^\p{L}[\p{L}-]+(?=\s|$)"),
        # a subgenus in brackets counts for nothing
        "__rest": F.regexp_replace(F.regexp_replace("__bare", r"^\S+\s*", ""), r"^\([^)]*\)\s+(?=" + _EPITHET + ")", ""),
    })
    named = ~F.col("__formula") & ~_or_empty(F.col("__doubt")).eqNullSafe("aff") & F.col("__genus").isNotNull()
    df4 = df3.withColumn("__species", F.when(named, extract("__rest", "^" + _EPITHET)))
    df5 = df4.withColumn("__after", F.when(F.col("__species").isNotNull(), F.regexp_replace("__rest", r"^\S+\s*", "")))
    df6 = df5.withColumns({
        "__third": extract("__after", "^" + _EPITHET),
        "__marks": F.regexp_extract_all(_or_empty(F.col("__after")), F.lit(_MARKED), F.lit(1)),
        "__lower": F.regexp_extract_all(_or_empty(F.col("__after")), F.lit(_MARKED), F.lit(2)),
    })
    third = F.array_compact(F.array("__third"))
    mark = F.create_map(*[F.lit(x) for pair in RANK_MARKS.items() for x in pair])
    left_over = F.when(
        F.col("__species").isNotNull(), F.regexp_replace(F.regexp_replace("__after", "^" + _EPITHET, ""), _MARKED, " "),
    ).when(named, F.regexp_replace("__rest", _OPEN, ""))
    df7 = df6.withColumns({
        "__epithets": F.concat(F.array_compact(F.array("__species")), third, "__lower"),
        "__ranks": F.concat(
            F.array(F.lit("genus")), F.transform(F.array_compact(F.array("__species")), lambda _: F.lit("species")),
            F.transform(third, lambda _: F.lit("infra")), F.transform("__marks", lambda m: mark[m])),
        "__authors": F.when(F.col("__genus").isNotNull(), squish(left_over)),
    })
    whole = F.concat(F.array("__genus"), F.col("__epithets"))
    forms = F.transform(
        F.sequence(F.size("__epithets") + 1, F.lit(1), F.lit(-1)), lambda n: F.lower(F.array_join(F.slice(whole, 1, n), " ")))
    known = F.col("__genus").isNotNull()
    return df7.select(*[F.col(f"`{c}`") for c in df.columns], F.struct(
        F.col("__genus").alias("genus"), F.col("__epithets").alias("epithets"), F.when(known, F.col("__ranks")).alias("ranks"),
        F.when(F.col("__authors") != "", F.col("__authors")).alias("authors"), F.col("__hybrid").alias("hybrid"),
        F.col("__doubt").alias("qualifier"), F.when(known, F.array_join(whole, " ")).alias("canonical"),
        F.when(known, forms).alias("forms"),
    ).alias(out))


def resolve_ranked(names: DataFrame, backbone: DataFrame, col: str = "submitted_name") -> DataFrame:
    """Each distinct name with the listed name of its lowest rank that the backbone holds.

    ``backbone`` has ``gni_uuid`` and ``matched_name``, which is parsed as well, so authors and marks on either side
    don't matter.  Of listed names with one canonical form the alphabetically first counts.  ``matched_rank`` tells the rank;
    the score is the share of the name's ranks, genus included, that the match covers.  Names without a match keep NULL.

    Both sides are distinct names before they are parsed, which costs far more than the rest, and every form of a name meets
    at most one listed form: an equi-join whose output is bounded by the ranks of the names.
    """
    asked = stage_table(
        parse_names(names.select(F.col(f"`{col}`").alias("name")).filter(F.col("name").isNotNull()).distinct(), "name"),
        "names/parsed")
    once = backbone.filter(F.col("matched_name").isNotNull()).groupBy("matched_name").agg(
        F.when(F.count_if(F.col("gni_uuid").isNull()) == 0, F.min("gni_uuid")).alias("gni_uuid"))
    # staged, as filters on parsed parts would parse again
    listed = stage_table(parse_names(once, "matched_name"), "names/listed")
    # a doubtful or unnamed listed plant must not stand for its whole genus
    sure = listed.filter(F.col("parsed.qualifier").isNull() & ~F.col("matched_name").rlike(r"\S\s*×\s*\p{Lu}"))
    offered = sure.filter(F.col("parsed.canonical").isNotNull()).groupBy(F.col("parsed.forms")[0].alias("form")).agg(
        F.min(F.struct("matched_name", "gni_uuid")).alias("listed"))
    tried = asked.select("name", F.posexplode("parsed.forms").alias("step", "asked_form"))
    best = tried.join(offered, tried["asked_form"] == offered["form"]).groupBy("name").agg(
        F.min(F.struct("step", "listed")).alias("best"))
    levels = F.size("parsed.ranks")
    at = levels - F.col("best.step")
    return asked.join(best, "name", "left").select(
        F.col("name").alias("user_supplied_name"), F.col("parsed.canonical").alias("canonical"),
        F.col("best.listed.gni_uuid").alias("gni_uuid"),
        F.when(F.col("best").isNotNull(), at / levels).alias("score"),
        F.col("best.listed.matched_name").alias("matched_name"),
        F.when(F.col("best").isNotNull(), F.try_element_at("parsed.ranks", at)).alias("matched_rank"),
    )


def resolve_with_ranks(names: DataFrame, backbone: DataFrame, edits: int = 2, col: str = "submitted_name") -> DataFrame:
    """``resolve_names``, and by rank the names that it leaves without a match."""
    whole = resolve_names(names, backbone, edits, col)
    left = whole.filter(F.col("gni_uuid").isNull())
    ranked = resolve_ranked(left, backbone, "user_supplied_name")
    return stage_table(
        whole.filter(F.col("gni_uuid").isNotNull()).unionByName(ranked.select(*whole.columns)), "names/with_ranks")
