"""The surveyed regions: raw layouts, treatment rules, classes and site constants.

Raw tables are DataFrames by name; ``community`` is the main one of most regions.
The rule, class, label and site tables below are fixed values: they define the
surveys and are written as published.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..functions import text as X
from ..operators import community as C
from ..operators import corrections as K
from ..operators import reshape as R
from ..operators.community import Rule
from ..sources.relational import TURF_RECORDS, TURF_RECORDS_NAMED, recorder_totals, run_sql
from . import trait_sheets as TS
from .profile import Profile, Tables
from .shared import lautaret_sites

UNIQUE = {"UniqueID": ["Year", "originSiteID", "destSiteID", "destPlotID"]}


def no_block(df: DataFrame) -> DataFrame:
    return df.withColumn("destBlockID", F.lit(None).cast("string"))


def text(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


# ---------------------------------------------------------------------------
# Norway: four gradients out of one national database
# ---------------------------------------------------------------------------

# The three sites of each Norwegian gradient.
NORWAY_GRADIENTS = {
    "NO_Ulvhaugen": ["Ulvhaugen", "Alrust", "Fauske"],
    "NO_Lavisdalen": ["Lavisdalen", "Hogsete", "Vikesland"],
    "NO_Gudmedalen": ["Gudmedalen", "Rambera", "Arhelleren"],
    "NO_Skjellingahaugen": ["Skjellingahaugen", "Veskre", "Ovstedal"],
}
# Observer factors and the threshold for under-recorded turfs.
NORWAY_OBSERVERS = {"PM": 1.20}
NORWAY_LOW_RECORDER, NORWAY_LOW_RATIO, NORWAY_LOW_FACTOR = "Siri", 1.35, 1.3
# Corrections of single turfs.
NORWAY_FIXES = [
    K.Fix("111 TT2 137", 2011, "set", 25.0, "Agr.cap"),
    K.Fix("32 TT3 109", 2009, "times", 1 / 2),
    K.Fix("32 TT3 109", 2012, "times", 2 / 3),
    K.Fix("33 TT2 58", 2009, "times", 2 / 3),
    K.Fix("34 TT1 32", 2009, "times", 1 / 2),
    K.Fix("40 TT2 62", 2011, "times", 2 / 3),
]


def norway_records(raw: Tables) -> DataFrame:
    """Turf records of the whole country with all cover corrections."""
    spark = raw["turfs"].sparkSession
    df = K.correct_effort(run_sql(spark, TURF_RECORDS, raw))
    df = K.correct_observer(df, NORWAY_OBSERVERS)
    low = K.low_samples(
        recorder_totals(raw, NORWAY_LOW_RECORDER), ["turfID", "year"], "SumOfCover", "totalVascular",
        NORWAY_LOW_RATIO,
    )
    df = K.scale_flagged(df, low, ["turfID", "year"], NORWAY_LOW_FACTOR)
    return K.apply_point_fixes(df, NORWAY_FIXES)


def prepare_norway(sites: list[str]):
    """One gradient.  ``country_records`` among the raw tables, if given, are the
    corrected records of the country (``norway_records``, staged once for all gradients)."""
    def prepare(raw: Tables) -> DataFrame:
        records = raw["country_records"] if "country_records" in raw else norway_records(raw)
        df = records.filter(F.col("destSiteID").isin(sites))
        df = df.withColumnsRenamed({
            "siteID": "originSiteID", "blockID": "originBlockID", "cover": "Cover", "species": "SpeciesName",
            "year": "Year",
        })
        df = C.assign_treatment(
            df, [Rule("LocalControl", label=("TTC",)), Rule("Warm", label=("TT2",))], label="TTtreat"
        )
        df = df.filter(F.col("Treatment").isNotNull() & (F.col("Year") != 2016))
        return C.build_ids(df, {"destPlotID": ["destBlockID", "originBlockID", "turfID"], **UNIQUE}).withColumn(
            "destBlockID", text("destBlockID")
        )

    return prepare


def norway_meta(region: str, sites: list[str]):
    def meta(raw: Tables) -> DataFrame:
        df = raw["meta"].withColumn("destSiteID", S.recode("Site", TS.NORWAY_SITES))
        return df.filter(F.col("destSiteID").isin(sites)).select(
            F.lit(region).alias("Gradient"), "destSiteID", "Longitude", "Latitude",
            S.to_number("Elevation").alias("Elevation"), F.lit(2009).alias("YearEstablished"),
            F.lit(2009).alias("YearMin"), F.lit(2017).alias("YearMax"), F.lit(8).alias("YearRange"),
            F.lit(0.0625).alias("PlotSize_m2"), F.lit("Norway").alias("Country"),
        )

    return meta


def norway_profile(region: str, sites: list[str]) -> Profile:
    return Profile(
        region, "Norway", 2009, 0.0625, {}, prepare_norway(sites),
        cover_grain=("UniqueID", "destSiteID"),
        traits=TS.norway(sites), meta=norway_meta(region, sites),
        taxa=lambda raw: raw["taxon"].select(F.col("speciesName").alias("SpeciesName")).distinct(),
    )


# ---------------------------------------------------------------------------
# Switzerland
# ---------------------------------------------------------------------------

# Fixed values, as published: calanda rules.
CALANDA_RULES = [
    Rule("Warm", label=("veg_away",), dest=("Cal", "Nes")),
    Rule("LocalControl", label=("veg_home",), dest=("Nes", "Pea", "Cal")),
]


def prepare_calanda(raw: Tables) -> DataFrame:
    group = ["year", "Treatment", "Block", "plot_id", "Site", "turf_type", "Species_Name"]
    df = raw["community"].select(*group, "Cov_Rel1", "Cov_Rel2")
    df = K.pool_observers(df, group, ["Cov_Rel1", "Cov_Rel2"])
    df = C.assign_treatment(df, CALANDA_RULES, label="Treatment", dest="Site")
    df = df.withColumnsRenamed({
        "Site": "destSiteID", "turf_type": "originSiteID", "year": "Year", "Species_Name": "SpeciesName",
        "plot_id": "destPlotID", "Block": "destBlockID",
    })
    df = df.filter(F.col("Treatment").isNotNull() & (text("destPlotID") != "CalNA.NA"))
    df = df.withColumns({"destPlotID": text("destPlotID"), "destBlockID": text("destBlockID")})
    return C.build_ids(df, UNIQUE).drop("Cov_Rel1", "Cov_Rel2")


CALANDA2_RULES = [
    Rule("Warm", label=("1", "3"), dest=("Nes",)),
    Rule("LocalControl", label=("8", "9"), dest=("Nes",)),
    Rule("LocalControl", dest=("Cal",)),
]


def prepare_calanda2(raw: Tables) -> DataFrame:
    df = K.quadrat_rollup(raw["community"], ["year", "site", "block", "plot", "plot_id", "species"])
    df = df.withColumnsRenamed({
        "site": "destSiteID", "cover": "Cover", "year": "Year", "species": "SpeciesName", "block": "destBlockID",
    })
    df = C.assign_treatment(df, CALANDA2_RULES, label=text("plot"))
    origin = F.when(F.col("destSiteID") == "Cal", "Cal").when(F.col("Treatment") == "Warm", "Cal").when(
        F.col("Treatment") == "LocalControl", "Nes"
    )
    df = df.withColumns({
        "originSiteID": origin, "destPlotID": text("plot_id"), "destBlockID": text("destBlockID"),
        "Cover": S.to_number("Cover"),
    })
    return C.build_ids(df.filter(F.col("Cover").isNotNull()), UNIQUE)


# Fixed values, as published: lavey sites.
LAVEY_SITES = ["CRE_CRE", "CRE_RIO", "MAR_MAR", "MAR_RIO", "PRA_PRA", "PRA_RIO", "RIO_RIO"]
# Fixed values, as published: lavey rules.
LAVEY_RULES = [
    Rule("LocalControl", label=("CRE_CRE", "RIO_RIO", "MAR_MAR", "PRA_PRA")),
    Rule("Warm", label=("CRE_RIO", "MAR_RIO", "PRA_RIO")),
]
# Cover classes that are not plants, and their common labels.
LAVEY_CLASSES = [
    "Other", "Dead", "Bare ground", "bare ground", "Bryophyta", "Stone", "Fungi", "Vegetation %",
    "Bare ground %", "Litter %", "Rocks %",
]
# Fixed values, as published: lavey labels.
LAVEY_LABELS = {
    "Fungi": "Lichen", "bare ground": "Bareground", "Bare ground": "Bareground", "Bryophyta": "Moss",
    "Stone": "Rock", "Vegetation %": "Vegetation", "Bare ground %": "Bareground", "Litter %": "Litter",
    "Rocks %": "Rock",
}


def lavey_letters(df: DataFrame, first: str = "Vegetation %", last: str = "Biscutella laevigata") -> DataFrame:
    """Third survey year: one row per plot, letter classes per species, plot name in the first column."""
    name = df.columns[0]
    tall = R.gather(df.withColumnRenamed(name, "id"), ["id"], "SpeciesName", "cover", R.column_range(df, first, last), "string")
    tall = C.decode_cover(tall, C.SCALE_LETTERS, "cover", "cover").filter(F.col("cover").isNotNull())
    tall = tall.filter(~F.col("SpeciesName").contains("FOCAL"))
    padded = F.regexp_replace("id", "RIO_", "RIO_RIOturf_")
    return tall.select(
        F.substring(padded, 1, 7).alias("siteID"), F.concat(F.lit("T"), X.tail(padded, 14)).alias("turfID"),
        F.regexp_replace("SpeciesName", r"\.\.\.\d+$", "").alias("SpeciesName"), "cover",
    )


def lavey_records(raw: Tables) -> DataFrame:
    """The three survey years: pins per species column, pins per row, letter classes."""
    first = K.pin_counts_wide(raw["pins_2017"], ["siteID", "turfID"]).withColumn("year", F.lit(2017))
    second = raw["pins_2018"]
    pins = [c for c, t in second.dtypes if t in ("int", "bigint", "double", "float")]
    pairs = second.select(F.lit(2017).alias("year"), "siteID", "turfID", "sp_2017", "sp_2018")
    first = K.retro_correct(first, pairs, ["year", "siteID", "turfID"], "sp_2017", "sp_2018")
    counted = K.pin_counts_rows(second, ["siteID", "turfID"], "sp_2018", pins).withColumn("year", F.lit(2018))
    third = lavey_letters(raw["letters_2019"]).withColumn("year", F.lit(2019))
    return R.union_all([first, counted, third])


def prepare_lavey(raw: Tables) -> DataFrame:
    df = C.assign_treatment(lavey_records(raw), LAVEY_RULES, label="siteID")
    df = df.filter(F.col("Treatment").isNotNull())
    df = R.separate(df, "siteID", ["destSiteID", "originSiteID"], "_")
    df = df.withColumnsRenamed({"cover": "Cover", "year": "Year", "turfID": "plotID"})
    df = C.build_ids(df, {
        "UniqueID": ["Year", "originSiteID", "destSiteID", "plotID"],
        "destPlotID": ["originSiteID", "destSiteID", "plotID"],
    })
    return no_block(df)


# ---------------------------------------------------------------------------
# United States
# ---------------------------------------------------------------------------

# Treatment code inside a turf name.
COLORADO_TREATMENTS = {
    "c1": "Cold", "c2": "Cold", "w1": "Warm", "w2": "Warm", "nu": "NettedControl", "u_": "Control",
    "ws": "LocalControl",
}
# Fixed values, as published: colorado classes.
COLORADO_CLASSES = [
    "Other", "Bare Soil", "Bare soil", "bare soil", "Litter", "LItter", "litter", "rock", "Rock", "moss",
]
# Fixed values, as published: colorado labels.
COLORADO_LABELS = {
    "Bare Soil": "Bareground", "Bare soil": "Bareground", "bare soil": "Bareground", "LItter": "Litter",
    "litter": "Litter", "moss": "Moss", "rock": "Rock",
}


def prepare_colorado(raw: Tables) -> DataFrame:
    """Site, block, treatment and origin are read off fixed places of the turf name."""
    df = raw["community"].select(
        F.col("year").try_cast("int").alias("Year"), F.col("turfID").alias("destPlotID"),
        S.recode("species", {"Rock": "rock", "Moss": "moss"}).alias("SpeciesName"),
        S.to_number("percentCover").alias("Cover"),
        X.between("turfID", 1, 2).alias("destSiteID"), X.between("turfID", 3, 3).alias("destBlockID"),
        S.recode(X.between("turfID", 7, 8), COLORADO_TREATMENTS).alias("Treatment"),
        X.from_end("turfID", 4, 2).alias("originSiteID"), X.from_end("turfID", 2, 1).alias("originBlockID"),
    )
    df = df.filter(F.col("Cover").isNotNull() & F.col("Treatment").isNotNull())
    return C.build_ids(df, {"UniqueID": ["Year", "originSiteID", "destSiteID", "destBlockID", "destPlotID"]})


# Fixed values, as published: montana rules.
MONTANA_RULES = [
    Rule("LocalControl", label=("lowland_community",), dest=("low",)),
    Rule("Warm", label=("Alpine_community",), dest=("low",)),
    Rule("LocalControl", label=("Alpine_community",), dest=("mid",)),
]
# Fixed values, as published: montana classes.
MONTANA_CLASSES = ["Other", "Bare", "Litter", "bareground", "rock", "litter", "moss", "Moss", "Rock"]
# Fixed values, as published: montana labels.
MONTANA_LABELS = {"litter": "Litter", "bareground": "Bareground", "bare": "Bareground", "moss": "Moss", "rock": "Rock"}


def prepare_montana(raw: Tables) -> DataFrame:
    df = raw["community"].filter(~F.coalesce(F.col("Disturb_treat").contains("soil"), F.lit(False)))
    df = C.assign_treatment(df, MONTANA_RULES, label="Disturb_treat", dest="Elevation")
    df = df.filter(F.col("Treatment").isNotNull() & F.col("Cover").isNotNull())
    df = df.select(
        "Year", "Treatment", F.col("Species").alias("SpeciesName"), S.to_number("Cover").alias("Cover"),
        S.recode("Disturb_treat", {"lowland_community": "Low", "Alpine_community": "High"}).alias("originSiteID"),
        S.recode("Elevation", {"low": "Low", "mid": "High"}).alias("destSiteID"), F.col("Plot").alias("plotID"),
    )
    df = C.build_ids(df, {
        "UniqueID": ["Year", "originSiteID", "destSiteID", "plotID"],
        "destPlotID": ["originSiteID", "destSiteID", "plotID"],
    })
    return no_block(df)


# Fixed values, as published: arizona keys.
ARIZONA_KEYS = {"Date Collected": "Date", "Ecosystem": "originSiteID", "Warming.Treat": "Treatment", "Plot": "plotID"}
# Fixed values, as published: arizona treatments.
ARIZONA_TREATMENTS = {"Warming": "Warm", "Control": "LocalControl"}
# Fixed values, as published: arizona ids.
ARIZONA_IDS = {
    "destPlotID": ["originSiteID", "destSiteID", "plotID"],
    "UniqueID": ["Year", "originSiteID", "destSiteID", "plotID"],
}


def _arizona_keys(df: DataFrame, ignored: Sequence[str]) -> DataFrame:
    """``ignored`` are the columns of the sheets that belong to other projects."""
    df = df.drop("Teabag number", *ignored).withColumnsRenamed(ARIZONA_KEYS)
    df = df.withColumns({
        "destSiteID": X.extract("plotID", "^.{2}"), "Treatment": S.recode("Treatment", ARIZONA_TREATMENTS),
    })
    return C.build_ids(df, ARIZONA_IDS).drop("plotID")


def prepare_arizona(raw: Tables) -> DataFrame:
    df = _arizona_keys(raw["community"], raw.get("ignored_columns", ()))
    ids = ["Year", "Date", "originSiteID", "destSiteID", "Treatment", "destPlotID", "UniqueID"]
    return no_block(R.gather(df, ids, "SpeciesName", "Individuals", dtype="double"))


def greenness_table(df: DataFrame, ignored: Sequence[str] = ()) -> DataFrame:
    df = _arizona_keys(df, ignored).withColumnRenamed("% cover at peak biomass", "VascCover")
    ids = ["Year", "Date", "originSiteID", "destSiteID", "Treatment", "destPlotID", "UniqueID"]
    return K.greenness(df, ids)


# ---------------------------------------------------------------------------
# Asia
# ---------------------------------------------------------------------------

# Treatment codes of the survey database.
GONGGA_CODES = {
    "C": "control", "O": "local", "1": "warm1", "2": "cool1", "3": "warm3", "4": "cool3", "OTC": "OTC",
}
# Fixed values, as published: gongga treatments.
GONGGA_TREATMENTS = {
    "control": "Control", "local": "LocalControl", "warm1": "Warm", "cool1": "Cold", "warm3": "Warm", "cool3": "Cold",
}


def prepare_gongga(raw: Tables) -> DataFrame:
    df = run_sql(raw["turfs"].sparkSession, TURF_RECORDS_NAMED, raw)
    label = S.recode_to("TTtreat", GONGGA_CODES)
    df = df.withColumn("Treatment", S.recode_to(label, GONGGA_TREATMENTS)).filter(F.col("Treatment").isNotNull())
    name = S.recode("speciesName", {"Potentilla stenophylla var. emergens": "Potentilla stenophylla"})
    df = df.withColumn("SpeciesName", name).withColumnsRenamed({"year": "Year", "cover": "Cover"})
    df = df.filter(F.col("Cover").isNotNull() & (F.col("Cover") != 0))
    df = C.build_ids(df, {"UniqueID": [
        "Year", "originSiteID", "destSiteID", "destBlockID", "Treatment", "destPlotID", "turfID",
    ]})
    return df.withColumns({"destPlotID": text("destPlotID"), "destBlockID": text("destBlockID")})


# Fixed values, as published: turf rules.
TURF_RULES = [
    Rule("LocalControl", label=("low_turf",), dest=("LOW",)),
    Rule("Warm", label=("high_turf",), dest=("LOW",)),
    Rule("LocalControl", label=("high_turf",), dest=("HIGH",)),
]
# Fixed values, as published: damxung classes.
DAMXUNG_CLASSES = ["Other", "Litter", "litter", "moss", "rock", "bareground", "Bare", "Moss", "Rock"]
# Fixed values, as published: damxung labels.
DAMXUNG_LABELS = {"litter": "Litter", "bareground": "Bareground", "Bare": "Bareground", "moss": "Moss", "rock": "Rock"}


def turf_origin(label: str) -> Column:
    """Origin site in capitals: the label without its last part."""
    return F.upper(F.regexp_replace(label, "^(.*)_.*$", "$1"))


def prepare_damxung(raw: Tables) -> DataFrame:
    df = raw["community"].withColumnsRenamed({
        "Species name": "SpeciesName", "cover class": "Cover", "SITE": "destSiteID", "BLOCK": "destBlockID",
        "PLOT.ID": "destPlotID", "TREATMENT": "label", "YEAR": "Year",
    }).withColumn("originSiteID", turf_origin("label"))
    df = C.decode_cover(C.assign_treatment(df, TURF_RULES, label="label"), C.SCALE_10)
    df = df.withColumns({"destPlotID": text("destPlotID"), "destBlockID": text("destBlockID")})
    return C.build_ids(df, UNIQUE)


# Fixed values, as published: heibei ranks.
HEIBEI_RANKS = {"3200": 3200, "3400": 3400, "3800": 3800}
# Fixed values, as published: rank rules.
RANK_RULES = [
    Rule("LocalControl", relation="same"), Rule("Warm", relation="down"), Rule("Cold", relation="up"),
]


def prepare_heibei(raw: Tables) -> DataFrame:
    df = raw["community"].filter(~((F.col("away") == 3600) | (F.col("home") == 3600))).select(
        F.col("species").alias("SpeciesName"), F.col("`Coverage(%)`").alias("Cover"),
        S.number_text("away").alias("destSiteID"), S.number_text("home").alias("originSiteID"),
        F.col("year").alias("Year"), F.col("replicate").alias("plotNo"),
    )
    df = C.assign_treatment(df, RANK_RULES, ranks=HEIBEI_RANKS)
    df = C.build_ids(df, {"destPlotID": ["originSiteID", "destSiteID", "plotNo"], "UniqueID": ["Year", "destPlotID"]})
    return no_block(df.drop("plotNo"))


# Spellings of names in the field sheets.
KASHMIR_NAMES = {
    "Fragaria spp": "Fragaria sp.", "Ranunculus spp": "Ranunculus sp.", "Pinus spp": "Pinus sp.",
    "CYANODON dACTYLON": "Cyanodon dactylon", "Hordeum spp": "Hordeum sp.", "Rubus spp": "Rubus sp.",
    "Cyanodondactylon": "Cyanodon dactylon",
}


def prepare_kashmir(raw: Tables) -> DataFrame:
    """Two yearly sheets; the year of the second one is fixed because its column was filled wrongly."""
    both = R.union_all([raw["sheet_2014"], raw["sheet_2015"].withColumn("YEAR", F.lit(2015))])
    df = C.build_ids(both, {"destPlot": ["REGION", "SITE", "BLOCK", "PLOT"]}, sep=".").drop("PLOT", "REGION")
    df = df.withColumnsRenamed({
        "Species name": "SpeciesName", "cover class": "Cover", "SITE": "destSiteID", "BLOCK": "destBlockID",
        "TREATMENT": "label", "YEAR": "Year",
    }).withColumns({
        "SpeciesName": S.recode("SpeciesName", KASHMIR_NAMES), "originSiteID": turf_origin("label"),
        "destBlockID": text("destBlockID"),
    })
    df = C.decode_cover(C.assign_treatment(df, TURF_RULES, label="label"), C.SCALE_11)
    return C.build_ids(df, {
        "destPlotID": ["originSiteID", "destSiteID", "destBlockID"], "UniqueID": ["destPlotID", "Year"],
    })


# ---------------------------------------------------------------------------
# Germany
# ---------------------------------------------------------------------------

def prepare_grainau(raw: Tables) -> DataFrame:
    df = raw["community"]
    df = df.select(*[F.col(f"`{c}`") for c in R.column_range(df, "site", "cover.class") if c != "plot"])
    df = df.withColumnsRenamed({
        "species.name": "SpeciesName", "cover.class": "Cover", "site": "destSiteID", "block": "destBlockID",
        "plot.ID": "destPlotID", "treatment": "label", "year": "Year",
    }).withColumn("originSiteID", turf_origin("label"))
    df = C.decode_cover(C.assign_treatment(df, TURF_RULES, label="label"), C.SCALE_13)
    df = df.withColumns({"destPlotID": text("destPlotID"), "destBlockID": text("destBlockID")})
    return C.build_ids(df, UNIQUE)


def pair_rules(**pairs: list[tuple[str, str]]) -> list[Rule]:
    """Rules from lists of (origin, destination) pairs per treatment."""
    return [Rule(treatment, origin=(a,), dest=(b,)) for treatment, group in pairs.items() for a, b in group]


# Fixed values, as published: susalps rules.
SUSALPS_RULES = pair_rules(
    LocalControl=[("BT", "BT"), ("EB", "EB"), ("FE", "FE"), ("GW", "GW")],
    Warm=[("EB", "BT"), ("EB", "FE"), ("EB", "GW"), ("FE", "BT"), ("GW", "BT"), ("GW", "FE")],
)
# Fixed values, as published: transalps rules.
TRANSALPS_RULES = pair_rules(
    LocalControl=[("BT", "BT"), ("FP", "FP"), ("SP", "SP")], Cold=[("BT", "FP"), ("BT", "SP")],
    Warm=[("FP", "BT"), ("SP", "BT")],
)
# Fixed values, as published: biomass classes.
BIOMASS_CLASSES = ["Moss", "Dead biomass"]


def prepare_biomass(rules: list[Rule]):
    def prepare(raw: Tables) -> DataFrame:
        df = raw["community"].withColumnsRenamed({
            "Plot_label": "destPlotID", "Origin_site": "originSiteID", "Transplant_site": "destSiteID",
            "Species_name": "SpeciesName",
        }).withColumn("Year", X.leading_year("Harvest_title"))
        df = K.biomass_rollup(df, ["SpeciesName", "destPlotID", "Year", "originSiteID", "destSiteID"], out="Cover")
        df = C.assign_treatment(df, rules).withColumn("destPlotID", text("destPlotID"))
        return no_block(C.build_ids(df, UNIQUE))

    return prepare


# ---------------------------------------------------------------------------
# France
# ---------------------------------------------------------------------------

# Fixed values, as published: huez rules.
HUEZ_RULES = [
    Rule("LocalControl", label=("LOW_TURF",), dest=("LOW",)),
    Rule("Warm", label=("HIGH_TURF",), dest=("LOW",)),
    Rule("LocalControl", label=("HIGH_TURF",), dest=("HIGH",)),
]


def prepare_huez(raw: Tables) -> DataFrame:
    df = raw["community"].filter(F.col("treatment").isin("HIGH_TURF", "LOW_TURF")).select(
        F.col("site").alias("destSiteID"), text("block").alias("destBlockID"), F.col("`plot.ID`").alias("plotID"),
        F.col("treatment").alias("label"), F.year(X.mixed_date("date")).alias("Year"),
        X.two_words("`corrected name`").alias("SpeciesName"), F.col("`cover.class`").alias("Cover"),
    ).withColumn("originSiteID", turf_origin("label"))
    df = C.decode_cover(C.assign_treatment(df, HUEZ_RULES, label="label"), C.SCALE_PLUS, numeric_rest=True)
    return C.build_ids(df, {
        "UniqueID": ["Year", "originSiteID", "destSiteID", "plotID"],
        "destPlotID": ["originSiteID", "destSiteID", "plotID"],
    })


# Fixed values, as published: lautaret names.
LAUTARET_NAMES = {
    "Carex sempervirens subsp. sempervirens": "Carex sempervirens", "Pilosella officinarum": "Pilosella",
    "Patzkea paniculata subsp. paniculata": "Patzkea paniculata",
}
# Fixed values, as published: lautaret keep.
LAUTARET_KEEP = ["Year", "destSiteID", "originSiteID", "plotID", "Treatment", "SpeciesName", "Cover"]


def prepare_lautaret(raw: Tables) -> DataFrame:
    """Pin counts of the early years and percent cover of 2022, each collapsed, then united."""
    pins = raw["community"].filter(text("Subplot").isin("0", "B")).withColumns({
        "plotID": X.zero_pad2("Replicate"), "Cover": F.col("number_of_obs").cast("double"),
        "SpeciesName": X.sp_suffix("Species"),
    })
    pins = lautaret_sites(R.separate(pins, "Site_Treatment", ["destSiteID", "label"], "_"), "label")
    code = F.col("code_plot")
    late = raw["community_2022"].withColumns({
        "Year": F.lit(2022), "label": F.regexp_replace(code, "^.*_(.*)$", "$1"),
        "destSiteID": S.recode(F.regexp_replace(code, "^.*_(High|Low)_.*$", "$1"), {"High": "G", "Low": "L"}),
        "plotID": F.regexp_replace(code, r"^.*_(\d{2})_.*$", "$1"),
        "SpeciesName": X.sp_suffix(S.recode("lb_nom", LAUTARET_NAMES)), "Cover": F.col("prct_recouvrement").cast("double"),
    }).filter(F.col("label").isin("CTRL", "B"))
    late = lautaret_sites(late, "label").filter(F.col("Treatment").isNotNull())
    keys = [c for c in LAUTARET_KEEP if c != "Cover"]
    parts = [C.collapse_duplicates(df.select(*LAUTARET_KEEP), keys) for df in (pins, late)]
    df = parts[0].withColumn("SpeciesName", S.recode("SpeciesName", {"Undetermined sp.": "Undetermined"}))
    df = C.build_ids(df.unionByName(parts[1]), {
        "UniqueID": ["Year", "originSiteID", "destSiteID", "plotID"],
        "destPlotID": ["originSiteID", "destSiteID", "plotID"],
    })
    return no_block(df)


# ---------------------------------------------------------------------------
# Sweden, Italy
# ---------------------------------------------------------------------------

# Fixed values, as published: abisko ranks.
ABISKO_RANKS = {"Low": 1, "Mid": 2, "High": 3}
# Fixed values, as published: abisko ids.
ABISKO_IDS = ["originSiteID", "destSiteID", "destBlockID", "destPlotID", "Treatment", "Year"]


def prepare_abisko(raw: Tables) -> DataFrame:
    """One column per species; plot notes and ground layers are left out."""
    df = raw["community"]
    unused = ["El", "Ori", "Yr", "Spot ID", "Tag", *R.column_range(df, "Bare soil", "Mosses")]
    df = df.drop(*unused).withColumnsRenamed({
        "Elevation of origin": "originSiteID", "Transplant elevation": "destSiteID", "Block": "destBlockID",
        "Core ID": "destPlotID",
    })
    df = C.assign_treatment(df, RANK_RULES, ranks=ABISKO_RANKS)
    df = R.gather(df, ABISKO_IDS, "SpeciesName", "Cover", dtype="double")
    df = df.withColumns({"destPlotID": text("destPlotID"), "destBlockID": text("destBlockID")})
    return C.build_ids(df, UNIQUE)


def abisko_taxa(raw: Tables) -> DataFrame:
    listed = R.concat_columns(raw["species_list"], [{"SpeciesName": "Name...2"}, {"SpeciesName": "Name...4"}])
    return listed.filter(~F.col("SpeciesName").isin("Lichen", "Litter", "Moss")).distinct()


# Fixed values, as published: matsch treatments.
MATSCH_TREATMENTS = {"destControl": "LocalControl", "originControls": "LocalControl", "warmed": "Warm"}
MATSCH2_TREATMENTS = {"originControl": "LocalControl", "originControls": "LocalControl", "warmed": "Warm"}


def prepare_matsch(low: int, high: int, treatments: dict[str, str], low_controls: list[str]):
    """One column per species; the plot name ends in the two-digit year."""

    def prepare(raw: Tables) -> DataFrame:
        df = raw["community"].drop("Gradient Name").withColumnsRenamed({
            "internal ID": "plot", "rec/Donor": "treat", "elevation": "Elevation",
        }).withColumn("Year", X.two_digit_year("plot"))
        df = R.gather(df, ["plot", "treat", "Elevation", "Year"], "SpeciesName", "Cover", dtype="double")
        df = df.filter(F.col("Cover").isNotNull()).withColumns({
            "SpeciesName": F.regexp_replace("SpeciesName", "_", " "),
            "destSiteID": F.when(F.col("Elevation") == low, "Low").when(F.col("Elevation") == high, "High"),
            "Treatment": S.recode_to("treat", treatments),
        })
        at_low = F.col("Elevation") == low
        origin = F.when(at_low & F.col("treat").isin(low_controls), "Low").when(F.col("Elevation") == high, "High").when(
            F.col("Treatment") == "Warm", "High"
        )
        df = df.withColumns({"originSiteID": origin, "destPlotID": X.extract("plot", r"^(.*)_([^_]+)$", 1)})
        return no_block(C.build_ids(df, {"UniqueID": ["originSiteID", "destSiteID", "destPlotID"]}))

    return prepare


# ---------------------------------------------------------------------------
# Profiles.  Site constants: elevation (m), longitude, latitude.
# ---------------------------------------------------------------------------

PROFILES: dict[str, Profile] = {
    p.region: p
    for p in [
        *[norway_profile(region, sites) for region, sites in NORWAY_GRADIENTS.items()],
        Profile(
            "CH_Lavey", "Switzerland", 2016, 1.0,
            {
                "PRA": (1400, 7.0396599, 46.216459), "MAR": (1750, 7.051020, 46.21567),
                "CRE": (1950, 7.0546499, 46.2181), "RIO": (2200, 7.06053, 46.20429),
            },
            prepare_lavey, residual=False, classes=LAVEY_CLASSES, relabel=LAVEY_LABELS,
        ),
        Profile(
            "CH_Calanda", "Switzerland", 2012, 0.75,
            {
                "Pea": (2800, 9.47031, 46.89326), "Cal": (2000, 9.48939, 46.88778),
                "Nes": (1400, 9.49013, 46.86923),
            },
            prepare_calanda, dedupe="distinct", classes=["Other", "Cetraria islandica"], traits=TS.calanda,
        ),
        Profile(
            "CH_Calanda2", "Switzerland", 2016, 1.0,
            {"Cal": (2000, 9.48939, 46.88778), "Nes": (1400, 9.49013, 46.86923)},
            prepare_calanda2, residual=False,
            classes=["Moss Group", "Lychen Group", "Mushroom Group", "Cetraria islandica"],
        ),
        Profile(
            "US_Colorado", "USA", 2017, 0.25,
            {
                "um": (2900, -107.010180, 38.9324799), "pf": (3200, -107.0326199, 38.9324799),
                "mo": (3300, -107.04908, 38.9727400),
            },
            prepare_colorado, dedupe="distinct", classes=COLORADO_CLASSES, relabel=COLORADO_LABELS,
            cover_grain=("Year", "destSiteID", "destPlotID"), traits=TS.colorado,
        ),
        Profile(
            "US_Montana", "USA", 2013, 0.25,
            {"Low": (1985, -111.496672, 45.3089900), "High": (2185, -111.49859499, 45.30523699)},
            prepare_montana, classes=MONTANA_CLASSES, relabel=MONTANA_LABELS,
        ),
        Profile(
            "US_Arizona", "USA", 2014, 0.09,
            {"MC": (2620, -111.73, 35.35), "PP": (2344, -111.67, 35.42)},
            prepare_arizona, residual=False, cover=lambda raw: greenness_table(raw["greenness"], raw.get("ignored_columns", ())),
            taxa=lambda raw: raw["species_list"].select(S.paste("Genus", "Species", sep=" ").alias("SpeciesName")).distinct(),
        ),
        Profile(
            "CN_Gongga", "China", 2012, 0.0625,
            {
                "L": (3000, 102.0343, 29.84347), "M": (3500, 102.0360, 29.86192),
                "A": (3850, 102.0173, 29.88911), "H": (4100, 102.0118, 29.90742),
            },
            prepare_gongga, cover_grain=("UniqueID", "destSiteID"), traits=TS.gongga,
            taxa=lambda raw: raw["taxon"].select(F.col("speciesName").alias("SpeciesName")).distinct(),
        ),
        Profile(
            "CN_Damxung", "China", 2013, 0.25,
            {"HIGH": (4800, 91.05491, 30.531410), "LOW": (4313, 91.0646299, 30.4971)},
            prepare_damxung, classes=DAMXUNG_CLASSES, relabel=DAMXUNG_LABELS,
        ),
        Profile(
            "IN_Kashmir", "India", 2013, 0.25,
            {"HIGH": (2684, 74.39961099, 34.050736), "LOW": (1951, 74.832931, 34.13218899)},
            prepare_kashmir, dedupe="collapse", cover_grain=("destPlotID", "Year"), compat_grain=("destPlotID",),
        ),
        Profile(
            "CN_Heibei", "China", 2007, 1.0,
            {
                "3200": (3200, 101.313306, 37.611750), "3400": (3400, 101.331306, 37.665306),
                "3800": (3800, 101.36922199, 37.704917),
            },
            prepare_heibei, dedupe="collapse",
        ),
        Profile(
            "DE_Grainau", "Germany", 2013, 0.25,
            {"HIGH": (1714, 11.0617667, 47.4414333), "LOW": (773, 11.011217, 47.4761499)},
            prepare_grainau, dedupe="collapse",
        ),
        Profile(
            "DE_Susalps", "Germany", 2016, 0.09,
            {
                "BT": (350, 11.581944, 49.921111), "FE": (600, 11.066260, 47.829320),
                "GW": (860, 11.031010, 47.569750), "EB": (1260, 11.157730, 47.516340),
            },
            prepare_biomass(SUSALPS_RULES), residual=False, classes=BIOMASS_CLASSES,
        ),
        Profile(
            "DE_TransAlps", "Germany/Switzerland", 2016, 0.09,
            {
                "BT": (300, 11.581944, 49.921111), "SP": (1850, 11.305278, 47.128889),
                "FP": (2440, 8.421389, 46.576667),
            },
            prepare_biomass(TRANSALPS_RULES), residual=False, classes=BIOMASS_CLASSES,
        ),
        Profile(
            "FR_AlpeHuez", "France", 2014, 0.25,
            {"HIGH": (2072, 6.0554500, 45.0999830), "LOW": (1481, 6.035933, 45.08820)},
            prepare_huez, dedupe="collapse", classes=["Other", "Bare ground"], traits=TS.huez,
        ),
        Profile(
            "SE_Abisko", "Sweden", 2012, 0.0177,
            {
                "High": (1000, 19.0921899, 68.29267099), "Mid": (690, 19.17353299, 68.294066999),
                "Low": (500, 19.190148, 68.300843),
            },
            prepare_abisko, classes=["Other", "Sph spe"], taxa=abisko_taxa,
        ),
        Profile(
            "FR_Lautaret", "France", 2017, 1.0,
            {"G": (2450, 6.40048, 45.0543600), "L": (1950, 6.4190699, 45.04006)},
            prepare_lautaret, traits=TS.lautaret,
        ),
        Profile(
            "IT_MatschMazia1", "Italy", 2010, 0.25,
            {"High": (1500, 10.5797899, 46.6862599), "Low": (1000, 10.5902491243, 46.6612188656)},
            prepare_matsch(1000, 1500, MATSCH_TREATMENTS, ["destControl"]), cover_grain=("UniqueID", "Year"),
            compat_grain=("UniqueID",), traits=TS.matsch("IT_MatschMazia1", {"989.8": "Low", "1476.46": "High"}),
        ),
        Profile(
            "IT_MatschMazia2", "Italy", 2010, 0.25,
            {"High": (1950, 10.59195399, 46.6916840), "Low": (1500, 10.5797899, 46.6862599)},
            prepare_matsch(1500, 1950, MATSCH2_TREATMENTS, ["originControl", "originControls"]), cover_grain=("UniqueID", "Year"),
            compat_grain=("UniqueID",), traits=TS.matsch("IT_MatschMazia2", {"1476.46": "Low", "2026.09": "High"}),
        ),
    ]
}


def region_names() -> list[str]:
    return list(PROFILES)


