import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gradientlab.llm import REGISTRY, sharding
from gradientlab.llm.common import prepare, table

FOLDER = "/root/testdata/sf0.01"


def by_hand(sizes, parts):
    """Differencing on tuples that carry their items."""
    nodes = [(tuple([s] + [0] * (parts - 1)), tuple([(k,)] + [()] * (parts - 1)), k) for k, s in enumerate(sizes)]
    number = len(sizes)
    while len(nodes) > 1:
        nodes.sort(key=lambda n: (-(n[0][0] - n[0][-1]), n[2]))
        a, b = nodes[0], nodes[1]
        joined = [(a[0][p] + b[0][parts - 1 - p], a[1][p] + b[1][parts - 1 - p]) for p in range(parts)]
        joined = sorted(joined, key=lambda x: -x[0])
        nodes = [(tuple(x[0] for x in joined), tuple(x[1] for x in joined), number), *nodes[2:]]
        number += 1
    return sorted(nodes[0][0]) if nodes else []


@pytest.mark.parametrize("parts", [2, 3, 5])
def test_differencing_by_hand(parts):
    rng = random.Random(parts)
    for _ in range(40):
        sizes = [rng.randint(0, 50) for _ in range(rng.randint(1, 25))]
        part = sharding.differencing(np.array(sizes), parts)
        assert sorted(np.bincount(part, weights=sizes, minlength=parts).astype(int).tolist()) == by_hand(sizes, parts)


def test_differencing_of_textbook_numbers():
    part = sharding.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(part, weights=[8, 7, 6, 5, 4])) == [14, 16]
    assert sharding.differencing(np.array([], dtype=int), 3).tolist() == []


def test_levels_balance_as_one_run(spark):
    prepare(spark)
    rng = np.random.default_rng(3)
    sizes = rng.lognormal(7, 1, 5000).astype(int) + 1
    sizes[0] = sizes.sum() // 2  # one group of copies holds a third of all bytes
    items = spark.createDataFrame([(f"i{k}", int(s)) for k, s in enumerate(sizes)], "item string, size bigint")
    got = {r.item: r.shard for r in sharding.assign(items, 8, limit=900, block=256, parts=16, fill=300).collect()}
    assert len(got) == 5000 and set(got.values()) == set(range(8))
    totals = np.bincount([got[f"i{k}"] for k in range(5000)], weights=sizes, minlength=8)
    rest = np.delete(totals, got["i0"])
    assert totals.max() == sizes[0]
    assert rest.max() - rest.min() <= 0.002 * rest.mean()


def check_rows(rows, docs, shards):
    """rows: of the result; docs: [(doc_id, text)]."""
    wanted = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == wanted
    slots, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        groups[r.text_crc32, r.size].add(r.shard)
    assert all(0 <= s < shards for s in slots)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in groups.values())


def test_query_op2(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    rows = REGISTRY["op2_sharding"](spark, FOLDER).collect()
    check_rows(rows, docs, 40)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    totals = Counter()
    for r in rows:
        totals[r.shard] += r.size
    assert len(totals) == 40 and max(totals.values()) <= 1.01 * min(totals.values())


def test_odd_rows(spark):
    prepare(spark)
    docs = [(1, None), (2, ""), (None, "null id"), (3, "same"), (4, "same"), (4, "same"), (4, "other"), (5, "long " * 50_000)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, item string, shard int")
    check_rows(sharding.shard_documents(df, 3).collect(), docs, 3)
    assert sharding.shard_documents(df.limit(0), 3).count() == 0


def test_slots_over_many_buckets(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 3 AS int) AS shard")
    got = sharding.numbered(df, "shard", "doc_id", rows=100).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
