"""Field trait sheets of the regions that measured traits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..functions import text as X
from ..operators import reshape as R
from ..operators import traits as Tr
from .profile import Tables
from .shared import lautaret_sites

# Site abbreviations of the Norwegian sheets.
NORWAY_SITES = {
    "Lav": "Lavisdalen", "Hog": "Hogsete", "Ulv": "Ulvhaugen", "Vik": "Vikesland", "Gud": "Gudmedalen",
    "Ram": "Rambera", "Arh": "Arhelleren", "Skj": "Skjellingahaugen", "Ves": "Veskre", "Alr": "Alrust",
    "Ovs": "Ovstedal", "Fau": "Fauske",
}


def plant(*parts: str) -> F.Column:
    return S.paste(*parts)


def norway(sites: list[str]):
    def tidy(raw: Tables) -> DataFrame:
        df = raw["trait"].withColumn("destSiteID", S.recode("Site", NORWAY_SITES)).filter(
            F.col("destSiteID").isin(sites)
        )
        df = df.withColumnsRenamed({"Leaf_Thicness_Ave_mm": "Leaf_Thickness_Ave_mm"}).withColumns({
            "SpeciesName": F.trim("Taxon"), "Year": F.year("Date"),
        })
        names = R.column_range(df, "Leaf_Thickness_1_mm", "CN_ratio")
        return Tr.tidy_traits(
            df, {}, {n: F.col(n) for n in names}, ["destSiteID", "SpeciesName", "Year", "Individual_number"],
            {"Country": "Norway"}, plant("destSiteID", "Individual_number", "SpeciesName"),
        )

    return tidy


def calanda(raw: Tables) -> DataFrame:
    """All measures are texts with units and junk; heights are in mm, a leaf area of 0 is missing."""
    df = raw["trait"].withColumn("site", S.recode("site", {"PEAK": "Pea", "CAL": "Cal", "NES": "Nes"}))
    area = X.clean_number("`leaf.area`")
    return Tr.tidy_traits(
        df,
        {"species": "SpeciesName", "individual": "Individual_number", "site": "destSiteID"},
        {
            "Plant_Veg_Height_cm": X.clean_number("`height.veg.stretch`") / 10,
            "Plant_Rep_Height_cm": X.clean_number("`height.rep.stretch`") / 10,
            "Wet_Mass_g": X.clean_number("`leaf.fresh.weight`"),
            "Dry_Mass_g": X.clean_number("`leaf.dry.weight`"),
            "Leaf_Area_cm2": F.when(area != 0, area),
            "SLA_cm2_g": Tr.sla(),
            "LDMC": Tr.ldmc(),
        },
        ["destSiteID", "SpeciesName", "Individual_number"],
        {"Country": "Switzerland", "Gradient": "CH_Calanda"},
        plant("destSiteID", "Individual_number", "SpeciesName"),
    )


# Treatment and site codes of the Colorado trait sheet.
COLORADO_TREATMENTS = {
    "c1": "Cold", "c2": "Cold", "w1": "Warm", "w2": "Warm", "nu": "NettedControl", "u": "Control",
    "ws": "LocalControl",
}
COLORADO_ORIGINS = {"Monument": "mo", "Pfeiler": "pf", "Upper Montane": "um"}
COLORADO_VALUES = {
    "Wet_Mass_g": "wetMassg", "Dry_Mass_g": "dryMassg", "Leaf_Area_cm2": "leafAreacm2", "SLA_cm2_g": "SLA",
    "LDMC": "LDMC", "Leaf_Thickness_Ave_mm": "thickAvgmm", "Plant_Veg_Height_cm": "vegHeightcm",
}


def colorado(raw: Tables) -> DataFrame:
    """A plant measured outside a turf belongs to its origin site."""
    df = raw["trait"].drop("destPlotID").withColumnsRenamed({
        "turfID": "destPlotID", "species": "SpeciesName", "individualNumber": "Individual_number",
    })
    df = df.withColumns({
        "destSiteID": F.coalesce(X.between("destPlotID", 1, 2), S.recode_to("originSite", COLORADO_ORIGINS)),
        "Treatment": S.recode("treatmentAbbrev", COLORADO_TREATMENTS),
        "Year": F.col("year").try_cast("int"),
    }).filter(F.col("Treatment").isNotNull())
    df = df.withColumn("UniqueID", S.paste("Year", "destPlotID"))
    return Tr.tidy_traits(
        df, {}, {k: S.to_number(v) for k, v in COLORADO_VALUES.items()},
        ["destSiteID", "Year", "destPlotID", "UniqueID", "Treatment", "SpeciesName", "Individual_number"],
        {"Country": "USA", "Gradient": "US_Colorado"}, plant("UniqueID", "Individual_number", "SpeciesName"),
    )


GONGGA_VALUES = [
    "Wet_Mass_g", "Dry_Mass_g", "Leaf_Thickness_Ave_mm", "Leaf_Area_cm2", "SLA_cm2_g", "LDMC", "C_percent",
    "N_percent", "CN_ratio", "dN15_percent", "dC13_percent", "P_AVG", "P_Std_Dev", "P_Co_Var",
]


def gongga(raw: Tables) -> DataFrame:
    """Plants of the gradient and of the two control treatments (written O or 0)."""
    df = raw["trait"].filter(F.col("Project").isin("LOCAL", "0", "O", "C")).withColumns({
        "SpeciesName": F.trim("Taxon"), "Year": F.year("Date"),
    }).withColumnRenamed("Site", "destSiteID")
    return Tr.tidy_traits(
        df, {}, {c: F.col(c) for c in GONGGA_VALUES},
        ["Year", "destSiteID", "SpeciesName", "Individual_number", "Leaf_number"],
        {"Country": "China", "Gradient": "CN_Gongga"}, plant("destSiteID", "Individual_number", "SpeciesName"),
    )


def huez(raw: Tables) -> DataFrame:
    """Two row blocks of one sheet, a column per individual; plants get ids of their own."""
    df = R.slice_rows(raw["trait"], {"LOW": (1, 15), "HIGH": (20, 36)}, "row_no", "destSiteID")
    df = df.withColumn("SpeciesName", S.paste("LOW", "`...2`", sep=" ")).drop("LOW", "...2", "row_no")
    tall = R.gather(df, ["destSiteID", "SpeciesName"], "Individual_number", "Value", dtype="double")
    return tall.filter(F.col("Value").isNotNull()).withColumns({
        "Country": F.lit("France"), "Gradient": F.lit("FR_AlpeHuez"), "Trait": F.lit("Plant_Veg_Height_cm"),
        "PlantID": plant("destSiteID", "Individual_number", "SpeciesName"),
    })


def lautaret(raw: Tables) -> DataFrame:
    """Leaf carbon and nitrogen are given per mille; the height is the vegetative one."""
    df = R.separate(raw["trait"], "combi_fac", ["destSiteID", "label"], "_")
    df = lautaret_sites(df, "label").withColumns({
        "plotID": X.zero_pad2("rep"), "Individual_number": F.col("num_point").cast("string"),
        "Year": F.col("year").try_cast("int"), "SpeciesName": F.col("species"),
    })
    df = df.withColumns({
        "UniqueID": S.paste("Year", "originSiteID", "destSiteID", "plotID"),
        "destPlotID": S.paste("originSiteID", "destSiteID", "plotID"),
    })
    return Tr.tidy_traits(
        df, {},
        {
            "Plant_Veg_Height_cm": S.to_number("Height_cm"), "Leaf_Area_cm2": S.to_number("LA_cm2"),
            "LDMC": S.to_number("LDMC_percent"), "N_percent": S.to_number("LNC_mg_g") / 10,
            "C_percent": S.to_number("LCC_mg_g") / 10,
        },
        ["destSiteID", "destPlotID", "Treatment", "UniqueID", "Year", "SpeciesName", "Individual_number"],
        {"Country": "France", "Gradient": "FR_Lautaret"}, plant("UniqueID", "Individual_number", "SpeciesName"),
        required=["SpeciesName"],
    )


# Column headings of the Italian trait sheet.
MATSCH_COLUMNS = {
    "Fresh weight, 1 leaf [g]": "Wet_Mass_g", "Dry weight, 1 leaf [mg]": "Dry_Mass_g",
    "Leaf area [cm2], 1 leaf": "Leaf_Area_cm2", "VegHt [cm]": "Plant_Veg_Height_cm",
    "RepHt [cm]": "Plant_Rep_Height_cm", "LDMC [mg g-1]": "LDMC", "SLA [mm2 mg-1]": "SLA_mm2_mg",
    "Carbon [%]": "C_percent", "Nitrogen [%]": "N_percent", "LNC [mg g-1]": "N_conc_mg_g",
    "LCC [mg g-1]": "C_conc_mg_g",
}


def matsch(region: str, sites: dict[str, str]):
    """The sheet of both Italian gradients; ``sites`` names the elevations that belong to one of them."""

    def tidy(raw: Tables) -> DataFrame:
        df = raw["trait"].withColumnsRenamed({**MATSCH_COLUMNS, "Species": "SpeciesName"}).withColumns({
            "destSiteID": S.recode_to(F.col("elevation").cast("string"), sites),
            "Individual_number": X.extract("`Rep-ID`", r"\d+$"),
        }).filter(F.col("destSiteID").isNotNull())
        n = {c: X.comma_number(c) for c in MATSCH_COLUMNS.values()}
        values = {
            "Wet_Mass_g": n["Wet_Mass_g"], "Dry_Mass_g": n["Dry_Mass_g"] / 1000, "Leaf_Area_cm2": n["Leaf_Area_cm2"],
            "Plant_Veg_Height_cm": n["Plant_Veg_Height_cm"], "Plant_Rep_Height_cm": n["Plant_Rep_Height_cm"],
            "LDMC": n["LDMC"] / 1000, "SLA_cm2_g": n["SLA_mm2_mg"] * 10, "C_percent": n["C_percent"],
            "N_percent": n["N_percent"], "CN_ratio": Tr.cn_ratio(), "N_conc_mg_g": n["N_conc_mg_g"],
            "C_conc_mg_g": n["C_conc_mg_g"],
        }
        return Tr.tidy_traits(
            df, {}, values, ["destSiteID", "SpeciesName", "Individual_number"],
            {"Country": "Italy", "Gradient": region}, plant("destSiteID", "Individual_number", "SpeciesName"),
        )

    return tidy
