"""Species names: codes, code books, synonyms, resolution, matching to a trait list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import ColumnLike, as_col, not_in, null_safe_join, paste, recode
from ..functions.text import genus, squish
from ..session import stage_table
from .reshape import sequence_by_hash, sequence_in_group

# Names written by hand in the surveys and what they stand for.
SYNONYMS = {
    "Stellaria umbellata": "Stellaria umbellata",
    "Stellaria_wide_leaf": "Stellaria umbellata",
    "Entire Meconopsis": "Meconopsis",
    "Leuc. Vulg.": "Leucanthemum vulgare",
    "unknown aster serrated": "Aster",
    "Unknown aster serrated": "Aster",
    "Haemarocalus fulva": "Hemerocallis fulva",
    "Dracophaleum": "Dracocephalum",
    "Antoxanthum alpinum": "Anthoxanthum odoratum nipponicum",
    "Anthoxanthum alpinum": "Anthoxanthum odoratum nipponicum",
    "Vaccinium gaultherioides": "Vaccinium uliginosum",
    "Listera ovata": "Neottia ovata",
    "Gentiana tenella": "Gentianella tenella",
    "Nigritella nigra": "Gymnadenia nigra",
    "Hieracium lactucela": "Pilosella lactucella",
    "Agrostis schraderiana": "Agrostis agrostiflora",
    "Festuca pratense": "Festuca pratensis",
    "Ran. acris subsp. Friesianus": "Ranunculus acris subsp. friesianus",
    "Symphyothricum_sp.": "Symphyotrichum",
    "Orchidacea spec": "Orchidaceae",
    "Carex biggelowii": "Carex bigelowii",
    "Carex spec": "Carex",
    "Potentilla stenophylla": "Potentilla stenophylla",
    "Hol.lan": "Holcus lanatus",
    "Dia.med": "Dianthus deltoides",
}

# Species-marker patterns removed from Norwegian epithets, in this order.
SP_MARKERS = ["sp?", "sp.", "sp??", "sp1?", "spp", "spp.", "spp1?"]

# Norwegian codes after marker removal and the codes used in the field.
NORWAY_CODES = {
    "Aco.spe": "Aco.sep", "Car.spx": "Car.sax", "Car.car": "Caru.car", "Gal.spx": "Gal.sax",
    "Ger.spl": "Ger.syl", "Hup.spl": "Hup.sel", "Kob.spm": "Kob.sim", "Luz.spc": "Luz.spi",
    "Mel.spl": "Mel.syl", "Nar.spr": "Nar.str", "Oma.spn": "Oma.sup", "Oma.spl": "Oma.syl",
    "Pim.spx": "Pim.sax", "Pin.spl": "Pin.syl", "Sel.spl": "Sel.sel", "Val.spm": "Val.sam",
    "Ver.spr": "Ver.ser",
}
# Codes shared by two Norwegian species, told apart by the full name.
NORWAY_CLASHES = {
    ("Hyp.mac", "Hypericum maculatum"): "Hype.mac",
    ("Hyp.mac", "Hypochaeris maculata"): "Hypo.mac",
    ("Rum.ace", "Rumex acetosella"): "Rum.acl",
}
# Swedish codes as derived and as used in the field.
SWEDEN_CODES = {
    "Hie alp": "Hie sect. Alp", "Luz mul": "Luz mul (subsp fri)", "Luz wah": "Luz wal",
    "Rum ace": "Rum ace subsp lap", "Cry fra": "Cys fra", "Epi lac": "Epi lac",
    "Equ pal": "Equ pal/pra", "Ste nem": "Ste nem", "Tri spi": "Tri spi", "Ver fru": "Ver fru",
    "Ver sp.": "Ver spe",
}
NORWAY_REGIONS = ["NO_Ulvhaugen", "NO_Lavisdalen", "NO_Gudmedalen", "NO_Skjellingahaugen"]


# -- codes ------------------------------------------------------------------

def species_code(
    first: ColumnLike,
    second: ColumnLike,
    sep: str = " ",
    overrides: Mapping[str, str] | None = None,
    clashes: Mapping[tuple[str, str], str] | None = None,
    name: ColumnLike | None = None,
) -> Column:
    """Three letters of the genus and three of the epithet, then the fix-up tables."""
    code = paste(F.substring(as_col(first), 1, 3), F.substring(as_col(second), 1, 3), sep=sep)
    code = recode(code, overrides or {})
    out = code
    for (c, taxon), value in (clashes or {}).items():
        out = F.when((code == c) & (as_col(name) == taxon), F.lit(value)).otherwise(out)
    return out


def epithet_core(name: ColumnLike) -> Column:
    """Everything after the genus without species markers, blanks and punctuation."""
    rest = F.coalesce(F.try_element_at(F.split(as_col(name), " ", 2), F.lit(2)), F.lit(""))
    for pattern in SP_MARKERS:
        rest = F.regexp_replace(rest, pattern, "sp")
    return F.regexp_replace(rest, r"[\p{Punct} ]+", "")


def norway_codebook(taxon: DataFrame, name: str = "speciesName") -> DataFrame:
    names = taxon.select(F.col(name).alias("taxa")).distinct()
    code = species_code(
        genus("taxa"), epithet_core("taxa"), ".", NORWAY_CODES, NORWAY_CLASHES, "taxa"
    )
    return names.select(code.alias("code"), "taxa")


def sweden_codebook(listed: DataFrame, later: DataFrame) -> DataFrame:
    """Codes of the first species list plus codes derived from the later one.

    ``listed`` has ``code`` and ``taxa``; ``later`` has ``species``.
    """
    first = listed.select("code", "taxa").dropna()
    words = F.split("species", " ")
    a, b = F.try_element_at(words, F.lit(1)), F.try_element_at(words, F.lit(2))
    second = (
        later.filter(not_in(a, ["moss", "litter", "lichen"]))
        .select(species_code(a, b, " ").alias("code"), paste(a, b, sep=" ").alias("taxa"))
    )
    both = first.unionByName(second).filter(not_in("taxa", ["Lichen", "Litter", "Moss"])).distinct()
    return both.withColumn("code", recode("code", SWEDEN_CODES))


def arizona_codebook(listed: DataFrame) -> DataFrame:
    return listed.select(F.col("Code").alias("code"), paste("Genus", "Species", sep=" ").alias("taxa"))


def merge_codebooks(books: Sequence[tuple[Sequence[str], DataFrame]]) -> DataFrame:
    """Tall code book; a book shared by several regions is repeated for each.

    Every book has ``code`` and ``taxa``.  Rows without a name are dropped.
    """
    parts = [
        book.select(F.explode(F.array(*[F.lit(r) for r in regions])).alias("Region"), "code", "taxa")
        for regions, book in books
    ]
    tall = reduce(lambda x, y: x.unionByName(y), parts)
    return tall.filter(F.col("taxa").isNotNull() & (F.col("taxa") != "NA NA"))


def attach_names(census: DataFrame, codes: DataFrame) -> DataFrame:
    """Full name of coded species; a code with several names gives a row for each."""
    joined = null_safe_join(census, codes, {"Region": "Region", "SpeciesName": "code"})
    return joined.select(*census.columns, "taxa").withColumn(
        "original_name", F.coalesce("taxa", "SpeciesName")
    )


def apply_synonyms(
    df: DataFrame, synonyms: Mapping[str, str] = SYNONYMS, col: str = "original_name", out: str = "submitted_name"
) -> DataFrame:
    """Exact replacement of known typos and synonyms; a short literal map, no join."""
    return df.withColumn(out, recode(squish(col), synonyms))


# -- resolution -------------------------------------------------------------

def _segments(length: Column, number: int | Column, edits: int) -> tuple[Column, Column]:
    """Start (from 0) and length of a segment of a text cut into ``edits`` + 1 near equal ones."""
    start = F.floor(length * number / (edits + 1)).cast("int")
    return start, F.floor(length * (number + 1) / (edits + 1)).cast("int") - start


def _key(length: Column, number: int, text: Column) -> Column:
    return F.xxhash64(length, F.lit(number), text)


def segment_keys(text: ColumnLike, edits: int) -> Column:
    """One key per segment of a listed name.

    With at most ``edits`` edits, one of ``edits`` + 1 segments stays untouched,
    shifted by at most ``edits``; so these keys and ``probe_keys`` turn a distance
    search into an equi-join.  Their number doesn't depend on the length.
    """
    text = as_col(text)
    length = F.length(text)
    keys = []
    for k in range(edits + 1):
        start, size = _segments(length, k, edits)
        keys.append(_key(length, k, F.substring(text, start + 1, size)))
    return F.array(*keys)


def probe_keys(text: ColumnLike, edits: int) -> Column:
    """Keys of every segment that a listed name within ``edits`` edits may share with this one."""
    text = as_col(text)
    own = F.length(text)
    tried = F.array(*[
        F.struct(F.lit(change).alias("change"), F.lit(k).alias("k"), F.lit(shift).alias("shift"))
        for change in range(-edits, edits + 1) for k in range(edits + 1) for shift in range(-edits, edits + 1)
    ])

    def key(p: Column) -> Column:
        length = own + p["change"]
        start, size = _segments(length, p["k"], edits)
        at = start + p["shift"]
        fits = (length >= 0) & (at >= 0) & (at + size <= own)
        return F.when(fits, F.xxhash64(length, p["k"], F.substring(text, at + 1, size)))

    return F.array_distinct(F.array_compact(F.transform(tried, key)))


def resolve_names(names: DataFrame, backbone: DataFrame, edits: int = 2, col: str = "submitted_name") -> DataFrame:
    """Best backbone match of each distinct name: exact, else within ``edits`` edits.

    ``backbone`` has ``gni_uuid`` and ``matched_name``.  The score is
    1 - distance / length of the longer name; ties go to the alphabetically
    first name.  Names without a match keep NULL.  Both sides are reduced to
    distinct names first, so the frequency of a name in the surveys plays no
    role, and only names without an exact match enter the fuzzy join.
    """
    # staged, as the list and the names are each used several times
    distinct = stage_table(
        names.select(F.col(col).alias("name")).filter(F.col(col).isNotNull()).distinct(), "names/asked")
    known = stage_table(backbone.groupBy("matched_name").agg(F.min("gni_uuid").alias("gni_uuid")), "names/known")
    exact = distinct.join(known, distinct["name"] == known["matched_name"], "left")
    miss = exact.filter(F.col("matched_name").isNull()).select("name")

    left = miss.withColumn("k", F.explode(probe_keys("name", edits)))
    right = known.withColumn("k2", F.explode(segment_keys("matched_name", edits)))
    near = left.join(right, left["k"] == right["k2"]).withColumn(
        "distance", F.levenshtein("name", "matched_name", edits)
    ).filter(F.col("distance") >= 0)
    best = near.groupBy("name").agg(
        F.min(F.struct("distance", "matched_name", "gni_uuid")).alias("b")
    )
    length = F.greatest(F.length("name"), F.length("b.matched_name"))
    fuzzy = best.select(
        "name",
        F.col("b.gni_uuid").alias("near_id"),
        (F.lit(1.0) - F.col("b.distance") / length).alias("near_score"),
        F.col("b.matched_name").alias("near_name"),
    )
    score = F.when(F.col("matched_name").isNotNull(), F.lit(1.0)).otherwise(F.col("near_score"))
    return stage_table(exact.join(fuzzy, "name", "left").select(
        F.col("name").alias("user_supplied_name"),
        F.coalesce("gni_uuid", "near_id").alias("gni_uuid"),
        score.alias("score"),
        F.coalesce("matched_name", "near_name").alias("matched_name"),
    ), "names/resolved")


def attach_resolution(census: DataFrame, resolved: DataFrame, col: str = "submitted_name") -> DataFrame:
    joined = null_safe_join(census, resolved, {col: "user_supplied_name"})
    return joined.select(*census.columns, "gni_uuid", "score", "matched_name")


def number_unresolved(df: DataFrame, row_no: str | None = "row_no", append: bool = False) -> DataFrame:
    """Give names without an id the label ``Region_NID_k``, k counting per region.

    k follows ``row_no``, or a fixed arbitrary order where no row number exists.
    With ``append`` the labelled rows are added and the originals kept as well.
    """
    missing = F.col("gni_uuid").isNull()
    order = ["destSiteID", "SpeciesName", "original_name"]
    number = lambda rows, group: (
        sequence_in_group(rows, group, row_no, "__k") if row_no else sequence_by_hash(rows, group, order, "__k"))
    label = paste("Region", F.lit("NID"), "__k")
    relabelled = {c: F.when(F.col("__k").isNotNull(), label).otherwise(F.col(c)) for c in ("submitted_name", "matched_name")}
    if append:
        out = df.unionByName(number(df.filter(missing), ["Region"]).withColumns(relabelled).select(*df.columns))
    else:
        numbered = number(df.withColumn("__missing", missing), ["Region", "__missing"])
        out = numbered.withColumn("__k", F.when(F.col("__missing"), F.col("__k"))).withColumns(relabelled).select(*df.columns)
    return out.filter(F.col("submitted_name").isNotNull())


# -- matching to the trait list ---------------------------------------------

# Species-level keys in order of trust (left column, right column), then genus keys.
SPECIES_KEYS = [
    ("gni_uuid", "gni_uuid"),
    ("matched_name", "accepted_name"),
    ("submitted_name", "accepted_name"),
    ("original_name", "accepted_name"),
    ("matched_name", "submitted_name"),
    ("submitted_name", "submitted_name"),
    ("original_name", "submitted_name"),
]
GENUS_KEYS = ["matched_name", "submitted_name", "original_name"]


def match_hierarchy(
    cleaned: DataFrame, species: DataFrame, row: str = "species_row", nulls_match: bool = True
) -> DataFrame:
    """Row of the trait species list for each cleaned name, by a hierarchy of keys.

    Adds ``species_match`` and ``genus_match`` (the species match, else the best
    genus match).  All keys of a name are exploded and looked up in one join on
    (kind, key) against the first list row of every key, instead of one join
    per key pair; a missing key matches a missing key in the list.
    """
    key_cols = ["gni_uuid", "matched_name", "submitted_name", "original_name"]
    distinct = stage_table(cleaned.select(*key_cols).distinct(), "names/keys")
    probes = [
        F.struct(F.lit(p).alias("priority"), F.lit(right).alias("kind"), F.col(left).cast("string").alias("key"))
        for p, (left, right) in enumerate(SPECIES_KEYS)
    ] + [
        F.struct(F.lit(100 + p).alias("priority"), F.lit("genus").alias("kind"), genus(left).alias("key"))
        for p, left in enumerate(GENUS_KEYS)
    ]
    asked = distinct.select(*key_cols, F.inline(F.array(*probes)))
    kinds = ["gni_uuid", "accepted_name", "submitted_name", "genus"]
    offered = (
        species.select(
            row,
            F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in kinds])),
        )
        .groupBy("kind", "key").agg(F.min(row).alias(row))
    )
    hits = null_safe_join(asked, offered, ["kind", "key"], "inner", nulls_match)
    is_species = F.col("priority") < 100
    best = hits.groupBy(*key_cols).agg(
        F.min_by(F.when(is_species, F.col(row)), F.when(is_species, F.col("priority"))).alias("species_match"),
        F.min_by(row, "priority").alias("genus_match"),
    )
    return null_safe_join(cleaned, best, key_cols).select(*cleaned.columns, "species_match", "genus_match")


def attach_trait_rows(
    matched: DataFrame, species: DataFrame, categorical: DataFrame, numeric: DataFrame, row: str = "species_row"
) -> DataFrame:
    """Trait values of the matched list rows, ``part`` telling species matches from those with genus matches.

    The three list tables are aligned by ``row``; the list is joined once.
    """
    names = species.withColumnRenamed("accepted_name", "try_name").drop("gni_uuid", "submitted_name")
    db = null_safe_join(null_safe_join(names, categorical, [row]), numeric, [row])
    parts = [F.struct(F.lit(p).alias("part"), F.col(f"{p}_match").alias("__row")) for p in ("species", "genus")]
    asked = matched.select(
        "Region", "destSiteID", "original_name", "submitted_name", F.col("matched_name").alias("accepted_name"),
        F.inline(F.array(*parts)),
    )
    joined = asked.join(db, asked["__row"] == db[row], "left").drop("__row", row)
    return joined.select("part", *[c for c in joined.columns if c != "part"])


def attach_trait_db(
    matched: DataFrame, species: DataFrame, categorical: DataFrame, numeric: DataFrame, row: str = "species_row"
) -> tuple[DataFrame, DataFrame]:
    """``attach_trait_rows`` as two tables: species matches only, and with genus matches."""
    rows = attach_trait_rows(matched, species, categorical, numeric, row)
    return tuple(rows.filter(F.col("part") == p).drop("part") for p in ("species", "genus"))
