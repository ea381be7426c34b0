import random
import re

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from gradientlab.llm import REGISTRY, SQL, decontaminate, embedding_join
from gradientlab.llm.common import add_columns, prepare, table

FOLDER = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_overlap(text, item):
    doc, want = words(text), words(item)
    if len(want) < 6:
        return bool(want) and any(words(line) == want for line in (text or "").split("\n"))
    window, agree = (12, 10) if len(want) >= 12 else (len(want), len(want) - (len(want) >= 8))
    for shift in range(-len(want), len(doc) + 1):
        same = [0 <= shift + j < len(doc) and doc[shift + j] == want[j] for j in range(len(want))]
        if any(sum(same[a : a + window]) >= agree for a in range(max(1, len(want) - window + 1))):
            return True
    return False


def test_query_op8(spark, con):
    df = REGISTRY["op8_decontaminate"](spark, FOLDER)
    assert not compare.difference(df, con, SQL["op8_decontaminate"])
    assert df.filter("contaminated").count() > 0


def test_substitutions_against_all_alignments(spark):
    prepare(spark)
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 6, 7, 8, 9, 10, 11, 12, 13, 20, 40])))) for k in range(60)]
    docs = []
    for k in range(250):
        part = rng.choice(items)[1].split()
        a = rng.randrange(len(part))
        part = part[a if rng.random() < 0.5 else 0 :][: rng.choice([6, 10, 11, 12, 13, 30])]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
            part[rng.randrange(len(part))] = rng.choice(["", "other", "Other!"])
        around = [rng.choices(vocabulary, k=rng.randint(0, 30)) for _ in range(2)]
        docs.append((k, rng.choice([" ", "\n"]).join([*around[0], " ".join(part), *around[1]])))
    got = decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    wanted = {(i, j) for i, t in docs for j, x in items if brute_overlap(t, x)}
    first = {x: min(j for j, y in items if words(y) == words(x)) for _, x in items}
    assert pairs == {(i, j) for i, j in wanted if j in first.values()} and {len(words(items[j][1])) for _, j in pairs} >= {1, 3, 6, 8, 11, 12}


def test_short_items_by_the_sql(spark, con):
    prepare(spark)
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter("doc_id % 7 = 0")
    lines = lines.withColumn("w", F.expr(r"regexp_extract_all(line, '[\\p{L}\\p{N}]+', 0)")).filter("size(w) > 0")
    items = lines.select((F.xxhash64("line") % 10_000).alias("item_id"), F.array_join(
        F.slice("w", 1, (F.pmod(F.xxhash64("line", F.lit(1)), F.lit(12)) + 1).cast("int")), " ").alias("text")).distinct().toPandas()
    fresh = compare.duck(SMALL)
    fresh.execute("DROP VIEW benchmark")
    fresh.register("benchmark", items)
    df = decontaminate.flag(docs, spark.createDataFrame(items))
    assert not compare.difference(df, fresh, SQL["op8_decontaminate"])
    assert df.filter("n_items > 0").count() > 10


def test_decontaminate_odd_rows(spark):
    prepare(spark)
    passage = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    items = spark.createDataFrame([(1, passage), (0, passage.upper()), (None, "some other item of more than six words here"), (3, None), (4, ""), (5, "too short")],
                                  "item_id bigint, text string")
    docs = [(1, "x " * 40_000 + passage), (2, None), (3, ""), (None, passage), (None, "clean"), (4, "clean text " * 9), (5, passage), (5, "clean"),
            (6, "SOME other, item of more than-six words HERE")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, found_id int, item string")
    flags = sorted(str((r.doc_id, r.contaminated, r.n_items, r.first_item)) for r in decontaminate.flag(df, items).collect())
    assert flags == sorted(map(str, [
        (1, True, 1, 0), (2, False, 0, None), (3, False, 0, None), (None, True, 1, 0), (None, True, 1, 0), (4, False, 0, None),
        (5, True, 1, 0), (5, True, 1, 0), (6, True, 1, None)]))
    clean = decontaminate.keep_clean(df, items)
    assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4]
    none = items.limit(0)
    assert decontaminate.keep_clean(df, none).count() == len(docs) and decontaminate.flag(df.limit(0), items).count() == 0


def test_large_benchmarks_are_joined_by_shuffle(spark, monkeypatch):
    prepare(spark)
    docs, items = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    wanted = sorted(map(tuple, decontaminate.overlaps(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, decontaminate.overlaps(docs, items).collect())) == wanted and wanted


def test_op8_runs_no_python(spark):
    docs = table(prepare(spark), SMALL, "documents")
    plan = decontaminate.overlaps(docs, table(spark, SMALL, "benchmark"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_links(rows, least):
    """{row number: (n_links, smallest id)}."""
    n = len(rows)
    vectors = [None if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v)
               else np.array(v, dtype=np.float32).astype(float) for _, v in rows]
    linked = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is not None and b is not None and len(a) == len(b):
                linked[i, j] = linked[j, i] = a @ b / np.sqrt((a @ a) * (b @ b)) >= least
    part = np.arange(n)
    while True:
        new = np.array([min([part[i], *part[linked[i]]]) for i in range(n)])
        if (new == part).all():
            break
        part = new
    smallest = {p: min((rows[i][0] for i in range(n) if part[i] == p and rows[i][0] is not None), default=None) for p in set(part)}
    return sorted((str(rows[i][0]), int(linked[i].sum()), str(smallest[part[i]])) for i in range(n))


def ours(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, item int")
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in embedding_join.near_duplicates(df, 0.95, **more).collect())


@pytest.mark.parametrize("dims", [2, 3, 64])
def test_range_join_against_all_pairs(spark, dims):
    prepare(spark)
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(12, dims))
    x = np.concatenate([centres[rng.integers(0, 12, 150)] + 0.1 * rng.normal(size=(150, dims)), rng.normal(size=(150, dims)) * rng.uniform(0.1, 9, (150, 1))])
    rows = [(k, [float(np.float32(v)) for v in row]) for k, row in enumerate(x)]
    wanted = brute_links(rows, 0.95)
    assert ours(spark, rows) == wanted
    assert ours(spark, rows, home_rows=20, guest_rows=30) == wanted  # many cells and blocks


def test_copies_and_odd_vectors(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (9, [2.0, 0.01]), (1, [0.0, 1.0]), (2, None), (6, []), (7, [0.0, 0.0]), (8, [nan, 1.0]),
            (10, [inf, 1.0]), (11, [None, 1.0]), (12, [1.0]), (13, [3.0]), (14, [-1.0]), (None, [0.0, 1.0]), (None, None), (15, [5.0, 5.0]), (15, [-5.0, 5.0])]
    assert ours(spark, rows) == brute_links(rows, 0.95)
    assert ours(spark, rows[:1]) == [("5", 0, "5")] and ours(spark, []) == []


def test_doubles_are_compared_as_doubles(spark):
    prepare(spark)
    angle = np.arccos(0.95)
    rows = [(k, [float(np.cos(a)), float(np.sin(a))], "x") for k, a in enumerate([0.0, angle - 1e-9, angle + 1e-9, 2.0])]
    rows += [(10, [1e300, 0.0], "x"), (11, [1e-300, 0.0], "x"), (12, [1e300, 1e300], "x"), (13, [5e-324, 5e-324], "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, vector string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join.near_duplicates(df, 0.95).collect()}
    assert got[0] == got[10] == got[11] == (3, 0) and got[1] == (4, 0) and got[2] == (1, 0) and got[3] == (0, 3)
    assert got[12] == got[13] == (1, 12)


def test_wide_vectors_are_dealt_by_bytes(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(embedding_join, "BLOCK_BYTES", 1 << 14)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(8, 3000))[rng.integers(0, 8, 60)] + 0.1 * rng.normal(size=(60, 3000))
    rows = [(k, [float(np.float32(v)) for v in row]) for k, row in enumerate(x)]
    assert ours(spark, rows) == brute_links(rows, 0.95)


def test_guests_are_few_where_vectors_cluster():
    rng = np.random.default_rng(1)
    centres = np.eye(16)
    x = centres[rng.integers(0, 16, 2000)] + 0.02 * rng.normal(size=(2000, 16))
    x /= np.sqrt((x * x).sum(1))[:, None]
    cells = embedding_join.Cells(embedding_join.spread(x[:200], 16), float(np.sqrt(0.1)))
    home, distance, to = cells.place(x)
    assert to.sum() == len(x) and distance.max() < 0.5


def test_query_op9(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, FOLDER, "embeddings").collect()]
    got = REGISTRY["op9_embedding_duplicates"](spark, FOLDER).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute_links(rows, 0.95)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(SQL) <= set(REGISTRY) and "pipeline" not in __spark_entry__.oracle_sql()


def test_pipeline_stages(spark):
    docs = table(prepare(spark), FOLDER, "documents").withColumn("score", F.lit("kept"))
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        n = out.count()
        assert 0 < n <= before
        assert out.join(docs, [*docs.columns], "left_anti").isEmpty()
        if name == "decontamination":
            assert n < before
    out = stage_result(spark, docs.limit(0))
    assert out.count() == 0


def stage_result(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    return docs


def test_pipeline_stage_by_stage_result(spark):
    """What leaves each stage is what its operator says of the stage's input."""
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    items = [r.text for r in table(spark, SMALL, "benchmark").collect()]
    assert set(got) <= set(docs) and all(r.exact and r.n_tokens == len(r.ids) for r in got.values())
    assert not any(brute_overlap(docs[i], x) for i in got for x in items)
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i in got for w in [(docs[i] or "").lower().split()]}
    ids = sorted(sets)
    assert not any(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for k, a in enumerate(ids) for b in ids[:k])


def test_pipeline_odd_rows(spark):
    prepare(spark)
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some text without an id", "en", None, 3), (3, "123", "en", "s", 3),
            (4, "plain words of a text that is here", "en", "s", 1), (4, "plain words of a text that is here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = stage_result(spark, docs).collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "None"] and all(r.exact for r in got)


def test_added_columns_replace_and_keep(spark):
    import pyarrow as pa

    df = spark.createDataFrame([(1, "a", "b")], "k int, Text string, other string")
    out = add_columns(df, "Text", "text string, n int", lambda c: [pa.array(["new"] * len(c)), pa.array([len(x) for x in c.to_pylist()], pa.int32())])
    assert out.columns == ["k", "other", "text", "n"] and tuple(out.first()) == (1, "b", "new", 1)
