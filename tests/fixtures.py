"""Hand-made raw tables of every region, with missing values, repeats, junk numbers and unmatched labels."""

from helpers import frame


def norway(s):
    return {
        "sites": frame(s, "siteID string", ("Ulvhaugen",), ("Alrust",), ("Lavisdalen",)),
        "blocks": frame(s, "blockID string, siteID string", ("U1", "Ulvhaugen"), ("A1", "Alrust"), ("L1", "Lavisdalen")),
        "plots": frame(
            s, "plotID int, blockID string", (1, "U1"), (2, "A1"), (3, "L1"), (4, "U1"),
        ),
        "turfs": frame(
            s, "turfID string, TTtreat string, originPlotID int, destinationPlotID int",
            ("t1", "TTC", 1, 1), ("t2", "TT2", 1, 2), ("t3", "TT3", 1, 4), ("t4", "", 2, 2), ("t5", "TTC", 3, 3),
            ("111 TT2 137", "TT2", 4, 2),
        ),
        "turfCommunity": frame(
            s, "turfID string, year int, species string, cover double",
            ("t1", 2011, "Agr.cap", 40.0), ("t1", 2011, "Poa.alp", 10.0), ("t1", 2010, "Agr.cap", 5.0),
            ("t1", 2016, "Agr.cap", 5.0), ("t2", 2011, "Agr.cap", 120.0), ("t2", 2011, "Car.big", None),
            ("t3", 2011, "Agr.cap", 9.0), ("t4", 2011, "Agr.cap", 9.0), ("t5", 2011, "Agr.cap", 50.0),
            ("111 TT2 137", 2011, "Agr.cap", 3.0), ("t2", 2012, "Agr.cap", 10.0), ("t1", 2012, "Agr.cap", 10.0),
        ),
        "turfEnvironment": frame(
            s, "turfID string, year int, recorder string, date string, totalVascular double",
            ("t1", 2011, "PM", "d", 60.0), ("t1", 2010, "PM", "d", 60.0), ("t1", 2016, "PM", "d", 60.0),
            ("t2", 2011, None, "d", 60.0), ("t3", 2011, "PM", "d", 60.0), ("t4", 2011, "PM", "d", 60.0),
            ("t5", 2011, "Siri", "d", 60.0), ("111 TT2 137", 2011, "PM", "d", 60.0), ("t2", 2012, "PM", "d", 60.0),
            ("t1", 2012, "Siri", "d", 2.0),
        ),
        "subTurfEnvironment": frame(
            s, "turfID string, year int, bad string",
            *[("t1", 2011, "") for _ in range(25)], *[("t2", 2011, "") for _ in range(20)],
            *[("t2", 2011, "x") for _ in range(5)], *[("t5", 2011, "") for _ in range(25)],
            *[("111 TT2 137", 2011, "") for _ in range(25)], *[("t2", 2012, "") for _ in range(10)],
            *[("t1", 2012, "") for _ in range(25)], *[("t1", 2016, "") for _ in range(25)],
        ),
        "taxon": frame(
            s, "speciesName string", ("Agrostis capillaris",), ("Carex saxatilis",), ("Hypericum maculatum",),
            ("Hypochaeris maculata",), ("Carex sp.",), ("Aconitum septentrionale",), ("Rumex acetosella",),
            ("Poa alpina",), ("Oxalis",),
        ),
        "meta": frame(
            s, "Site string, Elevation string, Longitude double, Latitude double",
            ("Ulv", "1208", 8.12, 61.02), ("Alr", "789", 8.7, 60.8), ("Lav", "1097", 7.27, 60.82),
        ),
        "trait": frame(
            s,
            "Date string, Site string, Taxon string, ID string, Individual_number int, Leaf_Thickness_1_mm double, "
            "Leaf_Thicness_Ave_mm double, SLA_cm2_g double, CN_ratio double",
            ("2016-07-01", "Ulv", " Agrostis capillaris ", "x1", 1, 0.2, 0.21, 200.0, None),
            ("2016-07-01", "Ulv", "Agrostis capillaris", "x2", 1, None, None, 220.0, 12.0),
            ("2016-07-01", "Lav", "Poa alpina", "x3", 1, 0.3, None, None, None),
        ),
    }


def calanda(s):
    schema = (
        "year int, Treatment string, Block string, plot_id string, Site string, turf_type string, "
        "Species_Name string, Cov_Rel1 string, Cov_Rel2 string"
    )
    return {
        "community": frame(
            s, schema,
            (2013, "veg_away", "1", "p1", "Cal", "Pea", "Poa alpina", "10", "20"),
            (2013, "veg_away", "1", "p1", "Cal", "Pea", "Poa alpina", "10", "20"),
            (2013, "veg_away", "1", "p1", "Cal", "Pea", "Carex curvula", "0,5", "NF"),
            (2013, "veg_away", "1", "p1", "Cal", "Pea", "Cetraria islandica", "5", "5"),
            (2013, "veg_home", "2", "p2", "Pea", "Pea", "Poa alpina", "80", "70"),
            (2013, "veg_home", "2", "p2", "Pea", "Pea", "Nardus stricta", "60", "40"),
            (2013, "veg_home", "2", "p2", "Pea", "Pea", "Bare", "§", "NF"),
            (2013, "veg_away", "3", "p3", "Pea", "Cal", "Poa alpina", "10", "20"),
            (2013, "veg_home", "3", "CalNA.NA", "Cal", "Cal", "Poa alpina", "1", "2"),
            (2013, "bare", "3", "p5", "Cal", "Cal", "Poa alpina", "1", "2"),
        ),
        "trait": frame(
            s,
            "species string, individual string, site string, collector string, `unique.code` string, "
            "`leaf.fresh.weight` string, `leaf.dry.weight` string, `leaf.area` string, "
            "`height.veg.stretch` string, `height.rep.stretch` string",
            ("Poa alpina", "1", "PEAK", "c", "u1", "0..123", "0.05", "10.5", "120 mm", "1,200"),
            ("Poa alpina", "2", "CAL", "c", "u2", None, "n.a.", "0", "85", None),
        ),
    }


def calanda2(s):
    return {"community": frame(
        s,
        "year int, site string, block string, plot int, plot_id string, quadrant_id int, species string, "
        "cover_cm2 double, is_focal boolean",
        (2017, "Nes", "b", 1, "n1", 1, "Poa alpina", 10.0, False), (2017, "Nes", "b", 1, "n1", 2, "Poa alpina", 30.0, False),
        (2017, "Nes", "b", 1, "n1", 2, "Moss Group", 60.0, False), (2017, "Nes", "b", 1, "n1", 2, "Carex", 99.0, True),
        (2017, "Nes", "b", 8, "n8", 1, "Poa alpina", 5.0, False), (2017, "Cal", "b", 4, "c4", 1, "Nardus stricta", 7.0, False),
        (2017, "Nes", "b", 5, "n5", 1, "Poa alpina", 5.0, False),
    )}


def lavey(s):
    return {
        "pins_2017": frame(
            s, "siteID string, turfID string, `Poa alpina` double, `Poa alpina...7` double, `Carex` double, "
               "`Carex FOCAL` double, `Bare ground` double, Other double",
            ("CRE_RIO", "T1", 2.0, 1.0, None, 9.0, 1.0, 0.0), ("CRE_RIO", "T1", 1.0, 1.0, None, 9.0, 2.0, 0.0),
            ("RIO_RIO", "T2", 4.0, 0.0, 6.0, 1.0, 0.0, 10.0),
        ),
        "pins_2018": frame(
            s, "siteID string, turfID string, sp_2017 string, sp_2018 string, CRE1 double, CRE2 double",
            ("CRE_RIO", "T1", "Poa alpina", "Poa badensis", 1.0, None), ("CRE_RIO", "T1", None, "NA", 2.0, 2.0),
            ("CRE_RIO", "T1", None, "FOCAL x", 7.0, 7.0), ("CRE_RIO", "T1", None, "Poa badensis", 1.0, 1.0),
            ("XXX_RIO", "T9", None, "Poa badensis", 1.0, 1.0),
        ),
        "letters_2019": frame(
            s, "`...1` string, `Vegetation %` string, `Poa alpina` string, `Carex...12` string, `Biscutella laevigata` string",
            ("RIO_T3", "5", "2a", "r", None), ("MAR_RIOturf_T4", "3", "+", "bad", "1"),
        ),
    }


def colorado(s):
    return {
        "community": frame(
            s, "year string, turfID string, species string, percentCover string",
            ("2018", "um1xxxw1yypf2zz", "Carex", "40"), ("2018", "um1xxxw1yypf2zz", "Carex", "40"),
            ("2018", "um1xxxw1yypf2zz", "Rock", "30"), ("2018", "um1xxxw1yypf2zz", "bare soil", "90"),
            ("2018", "pf2xxxu_yypf2zz", "Poa", "10"), ("2018", "mo3xxxnuyymo3zz", "Poa", "10"),
            ("2018", "mo3xxxwsyymo3zz", "Poa", "10"), ("2018", "mo3xxxwsyymo3zz", "Bad", "n/a"),
        ),
        "trait": frame(
            s,
            "turfID string, destPlotID string, species string, individualNumber int, year string, treatmentAbbrev string, "
            "originSite string, wetMassg string, dryMassg string, leafAreacm2 string, vegHeightcm string, SLA string, "
            "LDMC string, thickAvgmm string",
            ("um1xxxw1yypf2zz", "d", "Carex", 1, "2018", "w1", "Pfeiler", "0.2", "0.1", "12", "x", "120", "0.5", None),
            (None, "d", "Carex", 2, "2018", "u", "Monument", "0.4", None, None, "7", None, None, None),
            (None, "d", "Carex", 3, "2018", None, "Monument", "0.4", None, None, "7", None, None, None),
        ),
    }


def montana(s):
    return {"community": frame(
        s, "Region string, Year int, Elevation string, Plot string, Species string, Disturb_treat string, Cover double",
        ("MT", 2014, "low", "1", "Poa", "lowland_community", 30.0), ("MT", 2014, "low", "1", "litter", "lowland_community", 20.0),
        ("MT", 2014, "low", "2", "Poa", "Alpine_community", 130.0), ("MT", 2014, "mid", "3", "Poa", "Alpine_community", 10.0),
        ("MT", 2014, "mid", "4", "Poa", "lowland_community", 10.0), ("MT", 2014, "low", "5", "Poa", "lowland_soil", 10.0),
        ("MT", 2014, "low", "1", "Carex", "lowland_community", None),
    )}


def arizona(s):
    keys = (
        "Year int, `Date Collected` string, Ecosystem string, `Warming.Treat` string, Plot string, `Teabag number` int, "
        "`Network Treatment` string"
    )
    return {
        "community": frame(
            s, keys + ", ACMI double, POPR double",
            (2014, "d", "MC", "Warming", "PP1", 1, "x", 3.0, None), (2014, "d", "MC", "Control", "MC2", 1, "x", 1.0, 3.0),
            (2014, "d", "PP", "Control", "PP3", 1, "x", None, None),
        ),
        "greenness": frame(
            s, keys + ", `% cover at peak biomass` double", (2014, "d", "MC", "Warming", "PP1", 1, "x", 35.0),
        ),
        "ignored_columns": ["Network Treatment"],
        "species_list": frame(s, "Genus string, Species string, Code string",
                              ("Achillea", "millefolium", "ACMI"), ("Poa", "pratensis", "POPR"), (None, None, "XX")),
    }


def gongga(s):
    return {
        "sites": frame(s, "siteID string", ("H",), ("A",), ("M",), ("L",)),
        "blocks": frame(s, "blockID string, siteID string", ("H1", "H"), ("A1", "A"), ("L1", "L")),
        "plots": frame(s, "plotID int, blockID string", (1, "H1"), (2, "A1"), (3, "L1")),
        "turfs": frame(
            s, "turfID string, TTtreat string, originPlotID int, destinationPlotID int",
            ("H1-1", "1", 1, 2), ("A1-C", "C", 2, 2), ("A1-O", "O", 2, 2), ("A1-OTC", "OTC", 2, 2), ("A1-4", "4", 2, 1),
            ("Z", "9", 2, 2),
        ),
        "turfCommunity": frame(
            s, "turfID string, year int, species string, cover double, flag string",
            ("H1-1", 2013, "Pot.ste", 30.0, None), ("H1-1", 2013, "Car.atr", 0.0, None), ("H1-1", 2013, "Poa.alp", None, None),
            ("A1-C", 2013, "Poa.alp", 20.0, None), ("A1-O", 2013, "Poa.alp", 150.0, "x"), ("A1-OTC", 2013, "Poa.alp", 5.0, None),
            ("A1-4", 2013, "Poa.alp", 5.0, None), ("Z", 2013, "Poa.alp", 5.0, None),
        ),
        "taxon": frame(
            s, "species string, speciesName string", ("Pot.ste", "Potentilla stenophylla var. emergens"),
            ("Car.atr", "Carex atrata"), ("Poa.alp", "Poa alpina"),
        ),
        "trait": frame(
            s,
            "Project string, Taxon string, Date string, Location string, Site string, Individual_number int, Leaf_number int, "
            "Wet_Mass_g double, Dry_Mass_g double, Leaf_Thickness_Ave_mm double, Leaf_Area_cm2 double, SLA_cm2_g double, "
            "LDMC double, C_percent double, N_percent double, CN_ratio double, dN15_percent double, dC13_percent double, "
            "P_AVG double, P_Std_Dev double, P_Co_Var double",
            ("LOCAL", "Poa alpina ", "2015-08-01", "b", "A", 1, 1, 0.1, 0.05, None, 4.0, 80.0, None, None, 2.0, None, None, None,
             None, None, None),
            ("0", "Poa alpina", "2015-08-01", "b", "A", 1, 2, 0.3, None, None, None, None, None, None, None, None, None, None,
             None, None, None),
            ("9", "Poa alpina", "2015-08-01", "b", "A", 1, 2, 0.3, None, None, None, None, None, None, None, None, None, None,
             None, None, None),
        ),
    }


def damxung(s):
    return {"community": frame(
        s, "SITE string, BLOCK int, PLOT int, `PLOT.ID` string, TREATMENT string, YEAR int, `Species name` string, `cover class` int",
        ("LOW", 1, 1, "a", "low_turf", 2014, "Kobresia", 10), ("LOW", 1, 1, "a", "low_turf", 2014, "litter", 4),
        ("LOW", 1, 1, "b", "high_turf", 2014, "Kobresia", 3), ("LOW", 1, 1, "b", "high_turf", 2014, "Carex", None),
        ("HIGH", 1, 1, "c", "high_turf", 2014, "Kobresia", 1), ("HIGH", 1, 1, "d", "low_turf", 2014, "Kobresia", 1),
    )}


def heibei(s):
    return {"community": frame(
        s, "species string, `Coverage(%)` double, Treatment string, away double, home double, year int, replicate int",
        ("Stipa", 20.0, "t", 3200.0, 3200.0, 2008, 1), ("Stipa", 20.0, "t", 3200.0, 3200.0, 2008, 1),
        ("Stipa", 5.0, "t", 3200.0, 3200.0, 2008, 1), ("Poa", None, "t", 3200.0, 3200.0, 2008, 1),
        ("Stipa", 70.0, "t", 3200.0, 3800.0, 2008, 2), ("Poa", 60.0, "t", 3200.0, 3800.0, 2008, 2),
        ("Stipa", 1.0, "t", 3800.0, 3200.0, 2008, 3), ("Stipa", 1.0, "t", 3600.0, 3200.0, 2008, 3),
    )}


def kashmir(s):
    schema = (
        "REGION string, SITE string, BLOCK int, PLOT int, `PLOT.ID` string, TREATMENT string, YEAR int, collector string, "
        "`Species name` string, `cover class` int"
    )
    return {
        "sheet_2014": frame(
            s, schema, ("K", "LOW", 1, 1, "p", "low_turf", 2014, "c", "Fragaria spp", 11),
            ("K", "LOW", 1, 1, "p", "low_turf", 2014, "c", "Fragaria spp", 11),
            ("K", "LOW", 1, 1, "p", "low_turf", 2014, "c", "Fragaria sp.", 5),
        ),
        "sheet_2015": frame(
            s, schema, ("K", "LOW", 1, 1, "p", "low_turf", 2019, "c", "Fragaria spp", 4),
            ("K", "HIGH", 2, 1, "q", "high_turf", 2020, "c", "Pinus spp", 4),
        ),
    }


def grainau(s):
    return {"community": frame(
        s, "site string, block int, plot int, `plot.ID` string, treatment string, year int, `species.name` string, `cover.class` int",
        ("LOW", 1, 1, "p", "low_turf", 2014, "Poa", 12), ("LOW", 1, 1, "p", "low_turf", 2014, "Poa", 12),
        ("LOW", 1, 1, "p", "low_turf", 2014, "Poa", 2), ("LOW", 1, 1, "q", "high_turf", 2014, "Poa", 2),
    )}


def biomass(s):
    schema = (
        "Harvest_title string, Plot_label string, Origin_site string, Transplant_site string, Species_name string, "
        "bm string, treatment string"
    )
    return {"community": frame(
        s, schema, ("2017.1 peak", "7", "EB", "BT", "Poa", "1,5", "ctrl"), ("2017.2 late", "7", "EB", "BT", "Poa", "0,5", "ctrl"),
        ("2017.1 peak", "7", "EB", "BT", "Moss", "2", "ctrl"), ("2017.1 peak", "7", "EB", "BT", "Carex", "x", "ctrl"),
        ("2017.1 peak", "7", "EB", "BT", "Poa", "9", "wet"), ("2018.1 peak", "8", "BT", "BT", "Poa", "4", "ctrl"),
        ("2018.1 peak", "9", "BT", "SP", "Poa", "4", "ctrl"),
    )}


def huez(s):
    return {
        "community": frame(
            s,
            "site string, block int, plot int, `plot.ID` string, treatment string, date string, `species.name` string, "
            "`corrected name` string, `cover.class` string",
            ("LOW", 1, 1, "a", "HIGH_TURF", "41821", "x", "Poa alpina L.", "+"), ("LOW", 1, 1, "a", "HIGH_TURF", "7/1/2014", "x", "Poa alpina", "12"),
            ("LOW", 1, 1, "b", "LOW_TURF", "07/01/14", "x", "Carex", "60"), ("HIGH", 1, 1, "c", "HIGH_TURF", "2014-07-01", "x", "Carex", "55"),
            ("HIGH", 1, 1, "c", "HIGH_TURF", "2014-07-01", "x", "Bare ground", "20"), ("HIGH", 1, 1, "d", "CONTROL", "2014-07-01", "x", "Carex", "5"),
            ("HIGH", 1, 1, "c", "HIGH_TURF", "2014-07-01", "x", "Nardus stricta", "junk"),
        ),
        "trait": frame(
            s, "row_no int, LOW string, `...2` string, `1` string, `2` string", (1, "Poa", "alpina", "5", "7.5"),
            (17, "HIGH", None, "1", "2"), (20, "Poa", "alpina", "3", None), (40, "Poa", "x", "3", "3"),
        ),
    }


def lautaret(s):
    return {
        "community": frame(
            s, "Year int, Site_Treatment string, Subplot string, Replicate string, Species string, number_of_obs int",
            (2018, "L_TP", "B", "1", "Carex sempervirens", 4), (2018, "L_TP", "B", "1", "Carex sempervirens", 4),
            (2018, "L_TP", "B", "1", "Carex sempervirens", 2), (2018, "L_TP", "B", "1", "Undetermined", 4),
            (2018, "G_TP", "0", "2", "Poa", 4), (2018, "L_CP", "0", "3", "Poa alpina", 120), (2018, "L_CP", "A", "3", "Poa alpina", 4),
        ),
        "community_2022": frame(
            s, "code_plot string, lb_nom string, prct_recouvrement double", ("TA_Low_03_B", "Pilosella officinarum", 12.0),
            ("TA_High_04_CTRL", "Carex sempervirens subsp. sempervirens", 30.0), ("TA_High_04_C", "Poa alpina", 30.0),
        ),
        "trait": frame(
            s,
            "X int, combi_fac string, rep string, year int, num_point int, species string, Height_cm double, LA_cm2 double, "
            "LDMC_percent double, LNC_mg_g double, LCC_mg_g double",
            (1, "L_TP", "1", 2018, 3, "Poa alpina", 12.0, 2.0, None, 25.0, 450.0), (2, "L_TP", "1", 2018, 4, None, 12.0, 2.0, None, 25.0, 450.0),
        ),
    }


def abisko(s):
    return {
        "community": frame(
            s,
            "El string, Ori string, Yr int, `Spot ID` string, Tag string, `Elevation of origin` string, `Transplant elevation` string, "
            "Block int, `Core ID` int, Treatment string, Year int, `Bare soil` double, Litter double, Mosses double, "
            "`Bet nan` double, `Sph spe` double, `Emp nig` double",
            ("a", "b", 1, "s", "t", "High", "Low", 1, 11, "x", 2013, 5.0, 6.0, 7.0, 30.0, 10.0, None),
            ("a", "b", 1, "s", "t", "Mid", "Mid", 1, 12, "x", 2013, 5.0, 6.0, 7.0, 90.0, None, 30.0),
            ("a", "b", 1, "s", "t", "Low", "High", 1, 13, "x", 2013, 5.0, 6.0, 7.0, 0.0, None, 3.0),
        ),
        "species_list": frame(
            s, "`Code...1` string, `Name...2` string, `Code...3` string, `Name...4` string",
            ("Bet nan", "Betula nana", "Emp nig", "Empetrum nigrum"), ("Lic", "Lichen", None, None),
        ),
        "species_2017": frame(s, "species string", ("Luzula multiflora subsp. frigida",), ("moss sp",), ("Verbascum sp.",)),
    }


def matsch1(s):
    return {
        "community": frame(
            s, "`Gradient Name` string, `internal ID` string, `rec/Donor` string, elevation int, Poa_alpina double, Carex_x double",
            ("g", "A_1_12", "destControl", 1000, 30.0, None), ("g", "B_2_12", "warmed", 1000, 60.0, 70.0),
            ("g", "C_3_13", "originControls", 1500, 20.0, 0.0), ("g", "A_1_13", "destControl", 1000, 40.0, None),
        ),
        "trait": _matsch_trait(s),
    }


def matsch2(s):
    return {
        "community": frame(
            s, "`Gradient Name` string, `internal ID` string, `rec/Donor` string, elevation int, Poa_alpina double, Carex_x double",
            ("g", "A_1_12", "originControls", 1500, 30.0, None), ("g", "B_2_12", "warmed", 1500, 60.0, 70.0),
            ("g", "C_3_13", "originControl", 1950, 20.0, 5.0),
        ),
        "trait": _matsch_trait(s),
    }


def _matsch_trait(s):
    cols = [
        "Fresh weight, 1 leaf [g]", "Dry weight, 1 leaf [mg]", "Leaf area [cm2], 1 leaf", "VegHt [cm]", "RepHt [cm]",
        "LDMC [mg g-1]", "SLA [mm2 mg-1]", "Carbon [%]", "Nitrogen [%]", "LNC [mg g-1]", "LCC [mg g-1]",
    ]
    schema = "elevation string, Species string, `Rep-ID` string, " + ", ".join(f"`{c}` string" for c in cols)
    return frame(
        s, schema, ("989.8", "Poa alpina", "Poa_07", "0.5", "200", "3", "1,200", None, "250", "20", "45", "3", None, None),
        ("2026.09", "Poa alpina", "Poa_08", "0.5", "200", "3", "12", None, "250", "20", "45", "0", None, None),
    )


REGIONS = {
    "NO_Ulvhaugen": norway, "NO_Lavisdalen": norway, "NO_Gudmedalen": norway, "NO_Skjellingahaugen": norway,
    "CH_Lavey": lavey, "CH_Calanda": calanda, "CH_Calanda2": calanda2, "US_Colorado": colorado, "US_Montana": montana,
    "US_Arizona": arizona, "CN_Gongga": gongga, "CN_Damxung": damxung, "IN_Kashmir": kashmir, "CN_Heibei": heibei,
    "DE_Grainau": grainau, "DE_Susalps": biomass, "DE_TransAlps": biomass, "FR_AlpeHuez": huez, "SE_Abisko": abisko,
    "FR_Lautaret": lautaret, "IT_MatschMazia1": matsch1, "IT_MatschMazia2": matsch2,
}
