import random

import numpy as np
import pytest

from gradientlab.llm import REGISTRY, minhash
from gradientlab.llm.common import prepare, table
from gradientlab.llm.components import connected_components

FOLDER = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(docs, percent):
    """[(component, n)] by comparing all pairs of different sets."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    smallest = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            smallest[find(k)] = min(smallest.get(find(k), i), i)
    return sorted((str(i), str(smallest.get(find(k))), len(sets[k])) for k, (i, _) in enumerate(docs))


def ours(spark, docs, percent, **more):
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, item string")
    got = minhash.near_duplicates(df, percent, **more).collect()
    return sorted((str(r.doc_id), str(r.component_id), r.n_shingles) for r in got)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


def family(rng, n, copies, changes, name):
    words = [f"{name}{rng.randrange(5000)}" for _ in range(n)]
    return [edited(rng, words, rng.randint(0, changes)) for _ in range(copies)]


def test_sets_are_those_of_the_words():
    rng = random.Random(1)
    texts = ["", None, "a", "A b", "a b c d", "a b c d e", "É é \x0b x\x0cy\x1cz \xa0 w v u", "a a a a a a a", " lead", "x" * 700_000 + " a b c d e"]
    texts += [" ".join(rng.choices("abcd", k=rng.randint(0, 60))) for _ in range(300)]
    assert [len(s) for s in minhash.shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    a, b = minhash.shingle_sets(["One  two three\tFOUR five six", "zero one two three four five six seven"])
    assert len(np.intersect1d(a, b)) == 2


@pytest.mark.parametrize("n,j", [(12, 0.85), (60, 0.85), (700, 0.85), (3000, 0.5)])
def test_estimate_and_bands(n, j):
    rng = np.random.default_rng(n)
    common = round(2 * n * j / (1 + j))
    true, got, hits = common / (2 * n - common), [], 0
    size = minhash.band_size(0.85)
    for _ in range(60):
        a = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64) << np.uint64(1)
        x, y = np.sort(a[:n]), np.sort(np.concatenate([a[:common], a[n:]]))
        s = np.stack([minhash.sketch(x), minhash.sketch(y)])
        got.append(float(minhash.estimate((s[0] == s[1]).sum(), np.array(n), np.array(n))))
        bands = minhash.band_hashes(s, size)
        hits += (bands[0] == bands[1]).any()
        assert not minhash.may_link((s[0] == s[1]).sum(), np.array(n), np.array(n), 0.85) or j == 0.85 or n < minhash.SMALL_SET
    assert abs(np.mean(got) - true) < 0.012
    assert j < 0.85 or hits == 60


def test_chance_agreement():
    rng = np.random.default_rng(5)
    x, y = (np.stack([minhash.sketch(np.sort(rng.integers(0, 1 << 63, 2000, dtype=np.uint64) << np.uint64(1))) for _ in range(400)]) for _ in "ab")
    assert (x == y).mean() == pytest.approx(float(minhash.chance(np.array(2000), np.array(2000))), rel=0.35)


def test_band_size():
    assert minhash.band_size(0.85) == 9 and minhash.band_size(0.8) == 8


@pytest.mark.parametrize("percent", [80, 85])
def test_components_against_all_pairs(spark, percent, monkeypatch):
    prepare(spark)
    rng = random.Random(percent)
    texts = []
    for k in range(12):
        texts += family(rng, rng.choice([6, 12, 40, 90]), rng.randint(1, 9), 3, f"f{k}w")
    texts += family(rng, 60, 40, 3, "big")  # many pairs on either side of the threshold
    docs = [(k, t) for k, t in enumerate(rng.sample(texts, len(texts)))]
    assert ours(spark, docs, percent) == brute(docs, percent)
    monkeypatch.setattr(minhash, "UNIT_SHINGLES", 500)
    assert ours(spark, docs, percent, most=1) == brute(docs, percent)  # several rounds, and many units


def test_independent_edits_of_one_base(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(400)]
    docs = [(k, edited(rng, base, 6)) for k in range(5000)]  # each near to the base, few to each other
    docs.insert(2500, (9999, " ".join(base)))
    opened, still_open = [], minhash._still_open
    monkeypatch.setattr(minhash, "_still_open", lambda rows, labels: (opened.append(out := still_open(rows, labels)), out)[1])
    got = ours(spark, docs, 80)
    assert {c for _, c, _ in got} == {"0"}
    assert opened[0].count() < 2 * len(docs) and opened[-1].count() == 0


def thue_morse(length):
    word = "a"
    while len(word) < length:
        word += word.translate({97: "b", 98: "a"})
    return word, word.translate({97: "b", 98: "a"})


@pytest.mark.parametrize("length", [64, 1024, 2048, 4096])
def test_words_whose_polynomials_agree_have_other_shingles(spark, length):
    prepare(spark)
    one, two = thue_morse(length)
    docs = [(1, one), (2, two), (3, f"{one} b c d e f"), (4, f"{two} b c d e f")]
    assert ours(spark, docs, 80) == brute(docs, 80)


def test_chain_of_edits_is_one_component(spark):
    prepare(spark)
    words = [f"w{k}" for k in range(60)]
    docs = []
    for k in range(12):
        docs.append((k, " ".join(words)))
        words[5 * k] = f"new{k}"
    assert ours(spark, docs, 80) == brute(docs, 80)


def test_odd_rows(spark):
    prepare(spark)
    docs = [(1, None), (2, ""), (3, " \t "), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one two"), (None, None),
            (7, "a b c d e f g h i j k l m n o p"), (7, "a b c d e f g h i j k l m n o p"), (7, "another text under the same id"),
            (8, "long words " * 40_000), (9, "long words " * 40_001)]
    assert ours(spark, docs, 85) == brute(docs, 85)
    assert ours(spark, docs[:1], 85) == brute(docs[:1], 85)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, kept_id string, rows int")
    kept = minhash.keep_one(df, 85)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == [1, 2, 3, 4, 6, 7, 7, 8]
    empty = df.limit(0)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_one(empty).count() == 0


def test_query_op3(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    got = REGISTRY["op3_minhash_duplicates"](spark, FOLDER).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.n_shingles) for r in got) == brute(docs, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(3, 3), (9, 8), (8, 9)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[k] for k in range(100, 141)} == {100} and {got[k] for k in range(200, 260)} == {7}
    assert got[9] == got[8] == 8 and got[7] == 7 and 3 not in got
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_texts_are_fetched_by_shuffle_beyond_the_bound(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(4)
    docs = [(k, t) for k, t in enumerate(family(rng, 40, 8, 3, "a") + family(rng, 30, 8, 3, "b"))]
    wanted = brute(docs, 85)
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 0)
    assert ours(spark, docs, 85) == wanted


def test_large_buckets_are_dealt_into_blocks(spark, monkeypatch):
    """Blocks of three items give what one block gives."""
    prepare(spark)
    rng = random.Random(9)
    docs = [(k, t) for k, t in enumerate(family(rng, 60, 25, 5, "c"))]
    whole = minhash._across
    monkeypatch.setattr(minhash, "_across", lambda *a: whole(*a, block=3))
    assert ours(spark, docs, 85) == brute(docs, 85)


def test_only_items_that_may_link_are_compared_again(spark, monkeypatch):
    """A group whose outer copies have too much of their own to link: rows of the exact rounds, and the links."""
    prepare(spark)
    rng = random.Random(3)
    base, far = [f"w{k}" for k in range(120)], []
    for k in range(60):  # 8 edits far apart: 40 shingles of their own
        words = list(base)
        for place in rng.sample(range(6, 114, 6), 8):
            words[place] = f"own{k}_{place}"
        far.append(" ".join(words))
    docs = [(k, t) for k, t in enumerate([*(edited(rng, base, rng.randint(0, 2)) for _ in range(40)), *far])]
    asked, across = [], minhash._across
    monkeypatch.setattr(minhash, "_across", lambda rows, *a: (asked.append(rows.count()), across(rows, *a))[1])
    assert ours(spark, docs, 80, most=1) == brute(docs, 80)
    assert sum(asked) < len(far)  # each stands in many buckets


def test_later_rounds_hold_what_has_more_to_ask(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(12)
    base = [f"w{k}" for k in range(100)]
    docs = []
    for k in range(150):  # edits that others share, so that no shingle is an item's own; some copies near, some not
        words = list(base)
        for place in rng.sample(range(3, 97, 6), rng.randint(0, 5)):
            words[place] = f"z{rng.randrange(2)}"
        docs.append((k, " ".join(words)))
    asked, across = [], minhash._across
    monkeypatch.setattr(minhash, "_across", lambda rows, *a: (asked.append(rows.count()), across(rows, *a))[1])
    assert ours(spark, docs, 85, most=1) == brute(docs, 85)
    assert len(asked) > 1 and asked[-1] < asked[0]
