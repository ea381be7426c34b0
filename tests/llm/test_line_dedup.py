import random
from pathlib import Path

import compare
import pytest

from gradientlab.llm import REGISTRY, SQL, line_dedup
from gradientlab.llm.common import prepare

FOLDER = "/root/testdata/sf0.01"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(docs, least_chars=10, least_docs=2):
    holders = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(key(line), set())
            ids = [d for d in held if d is not None]
            if len(held) < least_docs or doc is not None and doc == min(ids):
                kept.append(line)
        out.append((str(doc), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def ours(spark, docs, **more):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, kept string, place int")
    found = line_dedup.drop_repeated_lines(df, **more)
    assert found.columns == ["doc_id", "text", "place", "n_lines", "n_dropped", "kept"]
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in found.collect())


@pytest.mark.parametrize("least_docs", [2, 3, 5])
def test_against_all_lines(spark, least_docs):
    prepare(spark)
    rng = random.Random(least_docs)
    pool = [f"{'Line' if k % 2 else 'zeile'} number {k} {'É' * (k % 5)}" for k in range(60)] + ["short", "", "  ", "ten chars!", "nine char"]
    dress = [lambda s: s, lambda s: f"  {s}\t", lambda s: s.upper() if s.isascii() else s, lambda s: f"\x0b{s}\r"]
    docs = [(k, "\n".join(rng.choice(dress)(rng.choice(pool)) for _ in range(rng.randint(1, 14)))) for k in range(120)]
    assert ours(spark, docs, least_docs=least_docs) == brute(docs, least_docs=least_docs)


def test_odd_rows(spark):
    prepare(spark)
    long = "\n".join(f"a rather long line {k}" for k in range(30_000))
    docs = [
        (1, None), (2, ""), (3, "\n\n"), (5, "shared line one\nother\nshared line one"), (5, "SHARED line one"), (5, "SHARED line one"),
        (4, " shared line one "), (None, "shared line one\nonly without id"), (None, "only without id"), (-7, "tail line here\n"),
        (8, "tail line here"), (9, long), (10, long), (11, "\xa0ten chars here"), (12, "ten chars here"), (13, "É" * 10), (14, "é" * 10),
        (15, "É" * 10), (16, "ÉTAT Général"), (17, "État GénéRAL"), (18, "x" * 9 + " "), (19, "x" * 9),
    ]
    assert ours(spark, docs) == brute(docs)
    assert ours(spark, []) == []


def test_lines_with_wide_blanks_take_linear_time(spark):
    prepare(spark)
    docs = [(1, "a" + " " * 2_000_000 + "b"), (2, "\t" * 2_000_000), (3, "x\n" * 300_000), (4, "same line of text\n" * 100_000), (5, "same line of text")]
    assert ours(spark, docs) == brute(docs)


def test_a_line_in_every_document(spark):
    prepare(spark)
    docs = [(k, f"terms of use apply\nbody of document {k}") for k in range(3000)]
    assert ours(spark, docs) == brute(docs)


def test_no_python_in_the_plan(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, "a\nb")], "doc_id bigint, text string")
    plan = line_dedup.drop_repeated_lines(df)._jdf.queryExecution().toString()
    hashes = line_dedup.hashed_lines(df, "doc_id", "text", 10)._jdf.queryExecution().toString()
    assert not any(word in plan + hashes for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
def test_query_op13(spark):
    assert not compare.difference(REGISTRY["op13_line_dedup"](spark, FOLDER), compare.duck(FOLDER), SQL["op13_line_dedup"])
