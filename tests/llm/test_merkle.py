import hashlib
import zlib
from pathlib import Path

import compare
import pytest
from pyspark.sql import functions as F

from gradientlab.llm import REGISTRY, SQL, merkle
from gradientlab.llm.common import prepare

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, place string, leaf string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc, source, lang, n, text):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def fold(digests, at, own):
    """(top, siblings of place ``at`` from below, top with ``own`` at that place)."""
    siblings = ""
    while len(digests) > 1:
        run = at // 16 * 16
        others = digests[run : run + 16]
        siblings += "".join(d for k, d in enumerate(others) if k != at - run)
        own = digest("".join(own if k == at - run else d for k, d in enumerate(others)))
        digests = [digest("".join(digests[k : k + 16])) for k in range(0, len(digests), 16)]
        at //= 16
    return digests[0], siblings, own


def brute(docs):
    def lowered(doc, text):
        if doc is None or text is None or zlib.crc32(str(doc).encode()) % 5:
            return text
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    sources = sorted({d[1] for d in docs}, key=lambda s: (s is not None, (s or "").encode()))
    rows = {s: sorted(((d[0] is not None, d[0] or 0, leaf_of(*d), d) for d in docs if d[1] == s), key=lambda r: r[:3]) for s in sources}
    tops = [fold([r[2] for r in rows[s]], 0, "")[0] for s in sources]
    out = []
    for k, s in enumerate(sources):
        for at, (_, _, leaf, d) in enumerate(rows[s]):
            sub, below, own = fold([r[2] for r in rows[s]], at, leaf_of(*d[:4], lowered(d[0], d[4])))
            root, above, own = fold(tops, k, own)
            out.append((d[0], leaf, sub, root, digest(below + above), own, own == root))
    return sorted(out, key=str)


def ours(spark, docs):
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA).repartition(5)
    found = merkle.prove(merkle.leaves(df, merkle.tampered_text(F.col("text"))))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def documents(sizes):
    out, k = [], 0
    for source, n in sizes:
        for _ in range(n):
            out.append((k, source, "en" if k % 3 else None, k if k % 4 else None, f"Text {k} É\n" if k % 7 else None))
            k += 1
    return out


@pytest.mark.parametrize("sizes", [
    [("a", 1)], [("a", 16)], [("a", 17)], [(None, 300)], [("a", 1), ("b", 2)], [("b", 257), (None, 3), ("a", 16), ("Z", 33), ("é", 1), ("", 1)],
    [(f"s{k:03}", 1 + k % 4) for k in range(40)],
], ids=str)
def test_proofs_against_a_plain_tree(spark, sizes):
    prepare(spark)
    docs = documents(sizes)
    got = ours(spark, docs)
    assert got == brute(docs)
    assert any(not r[-1] for r in got) or len(docs) < 10


def test_odd_rows(spark):
    prepare(spark)
    docs = [
        (1, "a", "en", 3, "X"), (1, "a", "en", 3, "X"), (1, "a", "en", 3, "Y"), (None, "a", None, None, "Z"), (None, "a", None, None, None),
        (0, None, None, None, None), (-5, None, "", 0, ""), (9, "a", "en", 5, "Long WORD " * 200_000), (1 << 62, "b", "-", 1, "-"),
        (25, "a", "en", 3, "1:a1:b"),
    ]
    assert ours(spark, docs) == brute(docs)


def test_values_cannot_be_shifted_between_columns(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "-"), ("-", None)], "x string, y string")
    found = rows.select(merkle.leaf_digest([F.col("x"), F.col("y")]).alias("d")).distinct().count()
    assert found == 4


def test_empty_table(spark):
    prepare(spark)
    assert ours(spark, []) == []


def test_without_tampering_every_row_is_verified(spark):
    prepare(spark)
    df = spark.createDataFrame([(*d, "x", "y") for d in documents([("a", 40), ("b", 20)])], SCHEMA)
    assert {r.verified for r in merkle.prove(merkle.leaves(df)).collect()} == {True}


def test_a_hot_source_is_dealt_over_partitions(spark):
    prepare(spark)
    df = spark.createDataFrame([(*d, "x", "y") for d in documents([("hot", 4000), ("b", 20)])], SCHEMA)
    placed, sizes = merkle.numbered(merkle.leaves(df))
    assert sorted(r.nodes for r in sizes.collect()) == [20, 4000]
    assert [r.place for r in placed.filter("tree = 1").orderBy("doc_id").collect()] == list(range(4000))


def test_many_lanes(spark, monkeypatch):
    prepare(spark)
    docs = documents([("hot", 1500), ("b", 20), (None, 300), *[(f"s{k}", 2) for k in range(30)]])
    wanted = brute(docs)
    for lane in (1, 16):
        monkeypatch.setattr(merkle, "LANE", lane)
        assert ours(spark, docs) == wanted


def test_no_key_of_the_climb_has_more_rows_than_a_lane(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(merkle, "LANE", 16)
    made = merkle.Manifest(merkle.leaves(spark.createDataFrame([(*d, "x", "y") for d in documents([("hot", 6000), ("b", 40)])], SCHEMA)))
    runs = made.bottom.count()
    keys = ["source", "lane", "tree", "level", "place"]
    assert made.nodes.count() == made.nodes.select(*keys).distinct().count() <= runs + runs // 4
    assert made.bottom.groupBy("tree", F.floor(F.col("run") / 16)).count().agg(F.max("count")).first()[0] == 16


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
def test_query_op11(spark):
    assert not compare.difference(REGISTRY["op11_merkle"](spark, FOLDER), compare.duck(FOLDER), SQL["op11_merkle"])
