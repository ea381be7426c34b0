import random
import zlib

import numpy as np
import pytest

from gradientlab.llm import REGISTRY, langid, nbsvm
from gradientlab.llm.common import bounded_sample, held_out, prepare, sample_by_group, table
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


def fold(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def auc(scores, labels):
    pairs = [(a > b) + 0.5 * (a == b) for a, y in zip(scores, labels) if y for b, z in zip(scores, labels) if not z]
    return float(np.mean(pairs))


def test_folds_and_sample(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id").withColumn("h", held_out())
    assert all(r.h == fold(r.doc_id) for r in df.collect())
    assert bounded_sample(df, F.col("doc_id"), 100).count() <= 100
    assert bounded_sample(df, F.col("doc_id"), 5000).count() == 1000


def test_dual_descent_solves_the_hinge_problem():
    rng = np.random.default_rng(0)
    rows = [np.array([0, 2]), np.array([0]), np.array([1, 2]), np.array([1])] * 5
    labels = np.array([1, 1, 0, 0] * 5)
    scale = np.zeros(1 << nbsvm.BITS)
    scale[:3] = [1.0, -1.0, 0.2]
    w, b = nbsvm.dual_descent(rows, labels, scale, cost=1.0, epochs=500, tolerance=1e-9)
    x = np.zeros((20, 3))
    for k, u in enumerate(rows):
        x[k, u] = scale[u] / np.sqrt((scale[u] ** 2).sum())
    y = np.where(labels > 0, 1, -1)

    def loss(v):
        return 0.5 * (v**2).sum() + np.maximum(0, 1 - y * (x @ v[:3] + v[3])).sum()

    best = loss(np.append(w[:3], b))
    for _ in range(300):
        assert best <= loss(np.append(w[:3], b) + rng.normal(0, 0.05, 4)) + 1e-6


def test_log_count_ratios():
    r = nbsvm.log_count_ratios([np.array([1]), np.array([1]), np.array([1, 2])], np.array([1, 1, 0]))
    assert r[2] == 0 and r[1] == pytest.approx(np.log(3 / ((1 << nbsvm.BITS) + 2)) - np.log(2 / ((1 << nbsvm.BITS) + 2)))


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    got = REGISTRY["op1_quality"](spark, FOLDER).collect()
    assert len(got) == table(spark, FOLDER, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == fold(r.doc_id) for r in got)
    rows = [r for r in got if r.held_out and r.doc_id in labels]
    assert auc([r.score for r in rows], [labels[r.doc_id] for r in rows]) > 0.97


def test_language_on_held_out_rows(spark):
    langs = {r.doc_id: r.lang for r in table(spark, FOLDER, "documents").collect()}
    got = [r for r in REGISTRY["op7_language"](spark, FOLDER).collect() if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in got]) > 0.97


LABELS = "doc_id bigint, quality int, toxic int"


def odd_rows():
    good = [(k, f"This is a plain text about rivers and towns number {k}, with the usual words of it.", "en") for k in range(40)]
    bad = [(100 + k, f"BUY!! NOW!! {k} $$$ CHEAP!! BUY!! NOW!!", "de") for k in range(40)]
    return good + bad + [(200, None, None), (201, "", "en"), (None, "some text", "en"), (3, "repeated id", "en"), (3, "repeated id", "en"),
                         (202, "word " * 60_000, "en"), (203, "1234 !!", None)]


def test_quality_with_odd_rows(spark):
    prepare(spark)
    docs = spark.createDataFrame([(*r, "old") for r in odd_rows()], "doc_id bigint, text string, lang string, Score string")
    labels = spark.createDataFrame(
        [(k, int(k < 100), 0) for k in [*range(40), *range(100, 140)]] + [(1, 0, 0), (2, None, None), (None, 1, 0)], LABELS)
    model = nbsvm.fit(docs, labels)
    got = nbsvm.score(docs, model).collect()
    assert len(got) == len(odd_rows()) and got[0].asDict().keys() == {"doc_id", "text", "lang", "score"}
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text}) == 1  # null and empty texts
    assert np.mean([r.score for r in got if r.doc_id in range(10, 40)]) > np.mean([r.score for r in got if r.doc_id in range(100, 140)])
    kept = nbsvm.keep_good(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_quality_without_labels(spark):
    prepare(spark)
    docs = spark.createDataFrame(odd_rows(), "doc_id bigint, text string, lang string")
    none, ones = spark.createDataFrame([], LABELS), spark.createDataFrame([(k, 1, 0) for k in range(40)], LABELS)
    assert {r.score for r in nbsvm.score(docs, nbsvm.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in nbsvm.score(docs, nbsvm.fit(docs, ones)).collect()} == {1.0}
    assert nbsvm.keep_good(docs, nbsvm.fit(docs, none)).count() == docs.count()
    empty = docs.limit(0)
    assert nbsvm.score(empty, nbsvm.fit(empty, none)).count() == 0


def test_language_with_odd_rows(spark):
    prepare(spark)
    docs = spark.createDataFrame([(*r, 1) for r in odd_rows()], "doc_id bigint, text string, lang string, accepted int")
    model = langid.fit(docs)
    got = {(r.doc_id, r.text): r for r in langid.identify(docs, model).collect()}
    for key, r in got.items():
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
        if not key[1] or key[1] == "1234 !!":
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
    kept = langid.keep_accepted(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id in (200, 201, 203)").count() == 0
    empty = docs.limit(0)
    nothing = langid.fit(empty)
    assert langid.identify(empty, nothing).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.keep_accepted(docs, nothing).count() == docs.count()


def test_table_of_subwords_equals_the_mean():
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcde fg", k=200)) for _ in range(30)] + ["".join(rng.choices("vwxyz uü", k=200)) for _ in range(30)]
    model = langid.fit_rows(texts, ["p"] * 30 + ["q"] * 30)
    many = texts[0] * 400  # more subwords than the table has rows
    assert model.languages[model.probabilities(many).argmax()] == "p"
    assert np.allclose(model.probabilities(texts[1]), model.probabilities(texts[1].upper()))


def four_languages(n):
    rng = random.Random(3)
    alphabets = {"p": "abcde ", "q": "vwxyz ", "r": "ijklm ", "s": "nopqr "}
    return [("".join(rng.choices(letters, k=120)), lang) for _ in range(n) for lang, letters in alphabets.items()]


def test_few_unsure_rows_do_not_set_the_language_threshold():
    rng = random.Random(4)
    junk = [("".join(rng.choices("abcdevwxyzijklmnopqr ", k=120)), rng.choice("pqrs")) for _ in range(12)]
    rows = four_languages(150) + junk
    model = langid.fit_rows([t for t, _ in rows], [lang for _, lang in rows])
    unsure = sorted(max(model.probabilities(t)) for t, _ in junk)
    assert unsure[0] < 0.45 and model.threshold == 0.5
    assert all(ok for _, _, ok in langid.identify_texts([t for t, _ in rows[:-12]], model))


def test_threshold_parts_right_from_wrong():
    best, labels = np.array([0.9] * 50 + [0.62] * 50), np.array([0, 1] * 50)
    assert 0.62 < langid.choose_threshold(best, best > 0.8, labels) <= 0.9
    assert langid.choose_threshold(best, best > 0, labels) == 0.5
    unsure = np.append(best, [0.3, 0.3])  # all that a rare language has
    assert langid.choose_threshold(unsure, unsure > 0, np.append(labels, [2, 2])) == 0.3


def test_a_rare_language_leaves_the_rows_apart(monkeypatch):
    learnt = []
    train = langid.train
    monkeypatch.setattr(langid, "train", lambda rows, *args: learnt.append(len(rows)) or train(rows, *args))
    rows = [("ščřž " * 20, "t"), *four_languages(25)]
    model = langid.fit_rows([t for t, _ in rows], [lang for _, lang in rows])
    assert learnt == [81] and model.languages[model.probabilities(rows[0][0]).argmax()] == "t"
    assert langid.fit_rows(["12", "ab cd"], ["x", "y"]).languages == ["y"]


def test_sample_by_group_keeps_rare_groups(spark):
    prepare(spark)
    df = spark.range(60_000).selectExpr("id AS doc_id", "CASE WHEN id % 10000 = 7 THEN 'rare' WHEN id % 3 = 0 THEN 'b' ELSE 'a' END AS lang", "1 AS __size")
    got = sample_by_group(df, "lang", F.col("doc_id"), 300)
    counts = {r.lang: r["count"] for r in got.groupBy("lang").count().collect()}
    assert counts == {"a": 100, "b": 100, "rare": 6} and got.columns == df.columns
    assert sample_by_group(df, "doc_id", F.col("doc_id"), 50).count() == 50
    assert sample_by_group(df.limit(0), "lang", F.col("doc_id"), 50).count() == 0


def test_words_are_hashed_whole():
    assert len({nbsvm.hash_word(w) for w in ("Donaudampfschifffahrt", "Donaudampfschiffer", "donaudampfschifffahrt")}) == 3
    assert nbsvm.hash_word("a" * 16) != nbsvm.hash_word("a" * 17)
