"""Codes, code books, resolution and matching, checked against plain-Python brute force."""

import random

from helpers import frame, rows
from pyspark.sql import functions as F

import fixtures
from gradientlab.operators import taxonomy as T


def levenshtein(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def test_norway_codes(spark):
    got = dict(rows(T.norway_codebook(fixtures.norway(spark)["taxon"]), "taxa", "code"))
    assert got["Agrostis capillaris"] == "Agr.cap"
    assert got["Carex saxatilis"] == "Car.sax"
    assert got["Aconitum septentrionale"] == "Aco.sep"
    assert got["Hypericum maculatum"] == "Hype.mac"
    assert got["Hypochaeris maculata"] == "Hypo.mac"
    assert got["Rumex acetosella"] == "Rum.acl"
    assert got["Carex sp."] == "Car.sp"
    assert got["Poa alpina"] == "Poa.alp"
    assert got["Oxalis"] == "Oxa."


def test_sweden_codes(spark):
    raw = fixtures.abisko(spark)
    listed = frame(spark, "code string, taxa string", ("Bet nan", "Betula nana"), ("Lic", "Lichen"), (None, "Poa alpina"), ("Luz mul", "Luzula multiflora"))
    got = T.sweden_codebook(listed, raw["species_2017"])
    assert rows(got, "code", "taxa") == [
        ("Bet nan", "Betula nana"), ("Luz mul (subsp fri)", "Luzula multiflora"), ("Ver spe", "Verbascum sp.")]


def test_books_and_names(spark):
    book = frame(spark, "code string, taxa string", ("a", "Alpha one"), ("a", "Alpha two"), ("b", None), ("c", "NA NA"))
    books = T.merge_codebooks([(["R1", "R2"], book)])
    assert books.count() == 4
    census = frame(spark, "Region string, destSiteID string, SpeciesName string", ("R1", "s", "a"), ("R3", "s", "a"), ("R2", "s", "q"), ("R1", "s", None))
    assert rows(T.attach_names(census, books), "Region", "SpeciesName", "original_name") == [
        ("R1", "a", "Alpha one"), ("R1", "a", "Alpha two"), ("R1", None, None), ("R2", "q", "q"), ("R3", "a", "a")]
    assert rows(T.arizona_codebook(fixtures.arizona(spark)["species_list"]), "code", "taxa")[-1] == ("XX", "NA NA")


def test_synonyms(spark):
    assert len(T.SYNONYMS) == 25
    df = frame(spark, "original_name string", ("Listera ovata",), ("Stellaria umbellata ",), (None,), ("Poa",))
    assert [r.submitted_name for r in T.apply_synonyms(df).collect()] == ["Neottia ovata", "Stellaria umbellata", None, "Poa"]


def test_segment_keys_do_not_grow_with_the_name(spark):
    df = frame(spark, "t string", ("abc",), ("",), ("x" * 2000,))
    sizes = df.select(F.size(T.segment_keys("t", 2)), F.size(T.probe_keys("t", 2))).collect()
    assert all(r[0] == 3 and r[1] <= 75 for r in sizes)


def test_very_long_names_resolve(spark):
    long = "genus " + "y" * 2000
    names = frame(spark, "submitted_name string", (long,), (long[:-1] + "q",), ("z" * 2000,))
    known = frame(spark, "matched_name string, gni_uuid string", (long, "1"))
    got = {r.user_supplied_name: r.matched_name for r in T.resolve_names(names, known).collect()}
    assert got == {long: long, long[:-1] + "q": long, "z" * 2000: None}


def test_resolution_equals_brute_force(spark):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abc") for _ in range(n))
    known = sorted({word(rnd.randint(1, 7)) for _ in range(60)})
    asked = sorted({word(rnd.randint(1, 8)) for _ in range(150)} | {"é" + known[0], "zzzzzzzz"})
    backbone = spark.createDataFrame([(n, f"id{i:03d}") for i, n in enumerate(known)], "matched_name string, gni_uuid string")
    names = spark.createDataFrame([(n,) for n in asked] * 2 + [(None,)], "submitted_name string")
    for edits in (0, 1, 2):
        got = {r.user_supplied_name: (r.matched_name, r.score) for r in T.resolve_names(names, backbone, edits).collect()}
        assert set(got) == set(asked)
        for n in asked:
            near = sorted((levenshtein(n, k), k) for k in known if levenshtein(n, k) <= edits)
            if not near:
                assert got[n] == (None, None)
            else:
                d, k = near[0]
                assert got[n][0] == k and abs(got[n][1] - (1 - d / max(len(n), len(k)))) < 1e-12


def test_number_unresolved(spark):
    schema = "row_no int, Region string, destSiteID string, SpeciesName string, original_name string, submitted_name string, gni_uuid string, score double, matched_name string"
    df = frame(
        spark, schema, (1, "A", "s", "x", "x", "x", None, None, None), (2, "A", "s", "y", "y", "y", "id", 1.0, "y"),
        (3, "B", "s", "x", "x", "x", None, None, None), (4, "A", "t", "x", "x", "x", None, None, None),
        (5, "A", "t", None, None, None, None, None, None),
    )
    got = T.number_unresolved(df)
    assert rows(got, "row_no", "submitted_name", "matched_name") == [
        (1, "A_NID_1", "A_NID_1"), (2, "y", "y"), (3, "B_NID_1", "B_NID_1"), (4, "A_NID_2", "A_NID_2"), (5, "A_NID_3", "A_NID_3")]
    assert T.number_unresolved(df, append=True).count() == 5 + 4 - 1
    by_hash = T.number_unresolved(df, row_no=None)
    assert {r[0] for r in rows(by_hash.filter("Region = 'A'"), "submitted_name")} == {"A_NID_1", "A_NID_2", "A_NID_3", "y"}


def test_match_hierarchy_equals_first_match(spark):
    rnd = random.Random(3)
    names = [f"{g} {e}" for g in "PQRS" for e in "ab"]
    pick = lambda: rnd.choice(names + [None])
    species = [(i + 1, rnd.choice(["u1", "u2", "u3", None]), pick(), pick(), rnd.choice(["P", "Q", "Z", None])) for i in range(6)]
    cleaned = [(i, rnd.choice(["u1", "u4", None]), pick(), pick(), pick()) for i in range(120)]

    def match(x, col):
        return next((s[0] for s in species if s[col] == x), None)

    sp = frame(spark, "species_row int, gni_uuid string, accepted_name string, submitted_name string, genus string", *species)
    cl = frame(spark, "i int, gni_uuid string, matched_name string, submitted_name string, original_name string", *cleaned)
    got = {r.i: (r.species_match, r.genus_match) for r in T.match_hierarchy(cl, sp).collect()}
    assert len(got) == len(cleaned)
    for i, uid, m, s, o in cleaned:
        tries = [match(uid, 1), match(m, 2), match(s, 2), match(o, 2), match(m, 3), match(s, 3), match(o, 3)]
        species_match = next((t for t in tries if t is not None), None)
        genera = [match(n.split(" ")[0] if n else None, 4) for n in (m, s, o)]
        genus_match = species_match if species_match is not None else next((t for t in genera if t is not None), None)
        assert got[i] == (species_match, genus_match)
    only_known = T.match_hierarchy(cl.filter("matched_name IS NULL AND submitted_name IS NULL AND original_name IS NULL AND gni_uuid IS NULL"), sp, nulls_match=False)
    assert only_known.filter("species_match IS NOT NULL OR genus_match IS NOT NULL").count() == 0


def test_match_rank_never_gets_worse_with_more_keys(spark):
    sp = frame(spark, "species_row int, gni_uuid string, accepted_name string, submitted_name string, genus string", (1, "u", "A a", "A x", "A"), (2, "v", "B b", "B x", "B"))
    cl = frame(spark, "gni_uuid string, matched_name string, submitted_name string, original_name string", ("v", "A a", "A a", "A a"), (None, None, "Q q", "B x"), (None, "B z", None, None))
    got = T.match_hierarchy(cl, sp)
    assert rows(got, "species_match", "genus_match") == [(2, 2), (2, 2), (None, 2)]


def test_attach_trait_db(spark):
    sp = frame(spark, "species_row int, gni_uuid string, accepted_name string, submitted_name string, genus string, family string", (1, "u", "A a", "s", "A", "F"))
    cat = frame(spark, "species_row int, woody string", (1, "yes"))
    num = frame(spark, "species_row int, leaf_area double", (1, 5.0))
    m = frame(spark, "Region string, destSiteID string, original_name string, submitted_name string, matched_name string, species_match int, genus_match int", ("R", "s", "o", "s", "A a", 1, 1), ("R", "s", "o", "s", "A q", None, 1), ("R", "s", "o", "s", "Z", None, None))
    a, b = T.attach_trait_db(m, sp, cat, num)
    assert a.columns == ["Region", "destSiteID", "original_name", "submitted_name", "accepted_name", "try_name", "genus", "family", "woody", "leaf_area"]
    assert rows(a, "accepted_name", "leaf_area") == [("A a", 5.0), ("A q", None), ("Z", None)]
    assert rows(b, "accepted_name", "woody") == [("A a", "yes"), ("A q", "yes"), ("Z", None)]


def test_epithet_markers(spark):
    df = frame(spark, "t string", ("Carex spp.",), ("Carex sp?",), ("Carex",))
    assert [r[0][:3] for r in df.select(F.concat(T.epithet_core("t"), F.lit("   "))).collect()] == ["sp ", "sp ", "   "]
