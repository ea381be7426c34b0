"""The grammar of names against names read by hand, and matching by rank against brute force."""

import itertools
from dataclasses import fields

from helpers import frame, rows
from pyspark.sql import functions as F

from gradientlab.operators import names as N
from gradientlab.plans.products import cleaned_species
from gradientlab.plans.profile import SiteBundle

READ = {
    "Poa alpina": ("Poa alpina", "genus species", None, False, None),
    "Poa  alpina L.": ("Poa alpina", "genus species", "L.", False, None),
    "Ranunculus acris subsp. friesianus (Jord.) Syme": ("Ranunculus acris friesianus", "genus species subsp", "(Jord.) Syme", False, None),
    "Poa alpina L. ssp. vivipara (L.) Arcang. fo. nana": ("Poa alpina vivipara nana", "genus species subsp f", "L. (L.) Arcang.", False, None),
    "Anthoxanthum odoratum nipponicum": ("Anthoxanthum odoratum nipponicum", "genus species infra", None, False, None),
    "Aster alpinus Hook. f. ex Benth.": ("Aster alpinus", "genus species", "Hook. f. ex Benth.", False, None),
    "Carex (Vignea) nigra": ("Carex nigra", "genus species", None, False, None),
    "Carex cf. nigra": ("Carex nigra", "genus species", None, False, "cf"),
    "cf Carex nigra": ("Carex nigra", "genus species", None, False, "cf"),
    "Carex aff. nigra": ("Carex", "genus", None, False, "aff"),
    "Carex sp.": ("Carex", "genus", None, False, None),
    "Carex spp": ("Carex", "genus", None, False, None),
    "Carex": ("Carex", "genus", None, False, None),
    "Mentha ×piperita": ("Mentha piperita", "genus species", None, True, None),
    "Mentha x piperita L.": ("Mentha piperita", "genus species", "L.", True, None),
    "× Festulolium loliaceum": ("Festulolium loliaceum", "genus species", None, True, None),
    "Salix alba × S. fragilis": ("Salix", "genus", None, True, None),
    "Capsella bursa-pastoris": ("Capsella bursa-pastoris", "genus species", None, False, None),
    "": (None, None, None, False, None),
    "?Poa alpina": (None, None, None, False, None),
}


def test_names_read_by_hand(spark):
    df = frame(spark, "name string, parsed_by string", *[(n, "x") for n in READ], (None, "y"), ("Poa " + "alpina " * 20_000, "z"))
    got = {r["name"]: r["parsed"] for r in N.parse_names(df, "name").collect()}
    for name, (canonical, ranks, authors, hybrid, qualifier) in READ.items():
        p = got[name]
        assert p.canonical == canonical, name
        assert (" ".join(p.ranks) if p.ranks else None) == ranks, name
        assert p.authors == authors, name
        assert (p.hybrid, p.qualifier) == (hybrid, qualifier), name
    assert got["Poa alpina L. ssp. vivipara (L.) Arcang. fo. nana"].forms == [
        "poa alpina vivipara nana", "poa alpina vivipara", "poa alpina", "poa"]
    assert got[None].canonical is None and got[None].forms is None


def test_matching_by_rank_is_that_of_brute_force(spark):
    genera, species, lower = ["Poa", "Carex", "Aster"], ["alpina", "nigra"], ["nana", "major"]
    asked = [f"{g} {s} L. subsp. {x} Koch" for g, s, x in itertools.product(genera, species, lower)]
    asked += [f"{g} {s}" for g, s in itertools.product(genera, species)] + [f"{g} sp." for g in genera] + ["??", ""]
    listed = {"Poa alpina Mill.": 1, "Poa alpina L.": 2, "Poa alpina ssp. nana": 3, "Carex": 4, "Carex nigra subsp. major": 5,
              "Aster cf. alpina": 6, "Carex aff. alpina": 7, "poa": 8}
    clean = {n: " ".join(w for w in n.lower().split() if w not in ("mill.", "l.", "ssp.", "subsp.")) for n in listed}
    expected = []
    for name in asked:
        words = [w for w in name.replace("L. ", "").replace("subsp. ", "").replace(" Koch", "").replace(" sp.", "").lower().split()]
        words = [] if words and not words[0].isalpha() else words
        hit = None
        for n in range(len(words), 0, -1):
            fits = sorted(k for k, v in clean.items() if v == " ".join(words[:n]) and "cf." not in k and "aff." not in k)
            if fits and hit is None:
                hit = (fits[0], listed[fits[0]], n / len(words))
        expected.append((name, *(hit or (None, None, None))))
    names = frame(spark, "submitted_name string", *[(n,) for n in asked for _ in range(2)], (None,))
    got = N.resolve_ranked(names, frame(spark, "matched_name string, gni_uuid int", *listed.items(), (None, 9)))
    key = lambda t: t[0]
    assert sorted(rows(got, "user_supplied_name", "matched_name", "gni_uuid", "score"), key=key) == sorted(expected, key=key)
    empty = N.resolve_ranked(names.limit(0), frame(spark, "matched_name string, gni_uuid int"))
    assert empty.count() == 0


def test_whole_names_come_before_ranks(spark):
    names = frame(spark, "submitted_name string", ("Poa alpin",), ("Poa alpina var. nana",), ("Zea mays",))
    backbone = frame(spark, "matched_name string, gni_uuid int", ("Poa alpina", 1), ("Carex", 2))
    got = N.resolve_with_ranks(names, backbone)
    assert rows(got.withColumn("score", F.round("score", 3)), "user_supplied_name", "gni_uuid", "score") == [
        ("Poa alpin", 1, 0.9), ("Poa alpina var. nana", 1, 0.667), ("Zea mays", None, None)]


def test_the_product_resolves_by_rank_where_asked(spark):
    community = frame(
        spark, "destSiteID string, SpeciesName string, Treatment string, Cover double",
        ("s", "Poa alpina L. var. nana", "Warm", 1.0), ("s", "Carex sp.", "Warm", 1.0), ("s", "Zea mays", "Warm", 1.0))
    bundle = SiteBundle(**{f.name: community if f.name == "community" else None for f in fields(SiteBundle)})
    backbone = frame(spark, "matched_name string, gni_uuid int", ("Poa alpina", 1), ("Carex", 2))
    for by_rank, expected in ((False, [None, None, None]), (True, [2, 1, None])):
        got = cleaned_species({"R": bundle}, [], backbone, by_rank=by_rank)
        assert [r[1] for r in rows(got, "original_name", "gni_uuid")] == expected


def test_a_listed_name_is_parsed_once(spark, monkeypatch):
    parsed, parse = [], N.parse_names
    monkeypatch.setattr(N, "parse_names", lambda df, col, out="parsed": (parsed.append(df.count()), parse(df, col, out))[1])
    listed = [(n, i) for i, n in enumerate(["Poa alpina L.", "Poa alpina Mill.", "Carex"] * 50)] + [("Carex", None), (None, 1)]
    backbone = frame(spark, "matched_name string, gni_uuid int", *listed)
    got = N.resolve_ranked(frame(spark, "submitted_name string", *[("Poa alpina",), ("Carex nigra",)] * 9), backbone)
    assert sorted(parsed) == [2, 3]
    assert rows(got, "user_supplied_name", "matched_name", "gni_uuid") == [
        ("Carex nigra", "Carex", None), ("Poa alpina", "Poa alpina L.", 0)]
