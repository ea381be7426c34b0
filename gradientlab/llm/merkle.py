"""Merkle manifest of a table, and proofs by a recursive query that climbs it.

A row's leaf is the hex SHA-256 of its values in a stated order, each as ``-`` if
null, else as its UTF-8 byte count, ``:`` and the value (whole numbers decimal).
Leaves of one source are ordered by id (null ids first, rows that share an id by
their leaf); while there are several nodes, each ``FANOUT`` consecutive ones (the
last run: what is left, be it one) become the SHA-256 of their hex digests.  What
remains is the source's subroot, and the subroots, ordered by source (null first,
by UTF-8 bytes), give the root likewise.

Leaves are numbered without a window over a source: they are dealt out by range of
(source, id, leaf) and sorted, so a row's number follows from its place in the
partition and the counts of the partitions before it.  Every level is written as
node rows that name their parent:

    tree, level, place    the node (tree: number of the source, -1 above the subroots)
    parent_tree, parent_level, parent_place
    digest, before, after    its own digest and those of its siblings left and right

A level has a sixteenth of the rows of the one below, and the number of levels is
the logarithm of the largest source.

``prove`` climbs these rows with a recursive query.  Leaves of one run share
their way up, so one row stands for a run: with the id, the digest and the digest to
be folded of each of its at most ``FANOUT`` leaves, and with the siblings met on the
common way.  A step joins the node where the row stands, appends that node's
siblings, and folds each leaf's digest between them; it ends at the root.  So a row
grows by one run of digests a level, and no level is gathered.

Near the root all rows stand at few nodes.  Runs are therefore dealt into lanes of
``LANE`` consecutive ones; a node that several lanes pass has a row for each of
them, and rows are joined by lane: no key has more than ``LANE`` rows.  Only nodes
with more than ``LANE`` runs below them are repeated, once a lane, which adds at
most one row a level for each ``LANE * FANOUT`` leaves of a source, and one a source.

The digest that is folded is that of the tampered row where one is given: the
root then shows whether the row is as it was (``verified``).

An empty table has no rows and no root.  Repeated rows are leaves of their own.
Very long texts are hashed whole; other columns aren't part of a leaf.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage_table
from .common import crc32_of_id

FANOUT = 16
#: Runs that are joined to a node under one key; a power of FANOUT.
LANE = FANOUT**2
NODE = ("tree", "level", "place")
#: More steps than any tree can have levels: a depth of 64 would be 16**64 leaves.
DEEPEST = 64


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hex digest of one row's values."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def tampered_text(text: Column, key: str = "doc_id", every: int = 5) -> Column:
    """The text with A-Z in lower case where ``every`` divides the crc32 of the id; a null id is never tampered with."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.col(key).isNotNull() & (crc32_of_id(key) % every == 0), F.translate(text, upper, upper.lower())).otherwise(text)


def leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """(source, doc_id, leaf, folded) of the rows of a documents table, digests as bytes.

    ``changed`` is the tampered text; without it the digest to be folded is the leaf's own.
    """
    columns = ["doc_id", "source", "lang", "n_chars"]
    rows = docs.select(
        *columns, "text", (F.col("text") if changed is None else changed).alias("changed"),
        leaf_digest([F.col(c) for c in (*columns, "text")]).alias("leaf"))
    folded = F.when(F.col("changed").eqNullSafe(F.col("text")), F.col("leaf")).otherwise(
        leaf_digest([F.col(c) for c in (*columns, "changed")]))
    return rows.select("source", "doc_id", F.unhex("leaf").alias("leaf"), F.unhex(folded).alias("folded"))


def _ahead(count: str, *by: str, order: str) -> Column:
    """Sum of ``count`` over the rows before."""
    return F.coalesce(F.sum(count).over(
        Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, place, doc_id, leaf, folded) of the leaves, and (tree, nodes): the number of leaves of each source.

    Windows hold at most one row for each partition, or the sources that begin in one partition.
    """
    order = ["source", "doc_id", "leaf"]
    rows = stage_table(rows, "merkle/leaves")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("*", F.monotonically_increasing_id().alias("at"))
    placed = stage_table(placed, "merkle/placed")  # what the ids say is fixed by writing them
    placed = placed.withColumns({"part": F.shiftright("at", 33).cast("int"), "row": F.col("at").bitwiseAND((1 << 33) - 1)})
    runs = stage_table(placed.groupBy("source", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("first")), "merkle/runs")
    begins = runs.groupBy("source").agg(F.min("part").alias("part"), F.sum("n").alias("nodes"))
    starts = begins.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("part", _ahead("n", order="part").alias("base"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("source")) - 1
    trees = begins.select("source", "part", "nodes", inside.alias("inside")).join(starts, "part").select(
        "source", "nodes", (F.col("base") + F.col("inside")).cast("bigint").alias("tree"))
    trees = stage_table(trees, "merkle/trees")
    offsets = runs.select("source", "part", "first", _ahead("n", "source", order="part").alias("before"))
    named = trees.withColumnRenamed("source", "its_source")
    offsets = stage_table(
        offsets.join(named, F.col("source").eqNullSafe(F.col("its_source"))).select(
            F.col("source").alias("of"), F.col("part").alias("in"), "tree", (F.col("before") - F.col("first")).alias("shift")),
        "merkle/offsets")
    out = placed.join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    return out.select(
        "tree", (F.col("row") + F.col("shift")).alias("place"), "doc_id", "leaf", "folded"), trees.select("tree", "nodes")


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _run_of(place: str = "place") -> Column:
    return F.floor(F.col(place) / FANOUT).cast("bigint")


def _hash_of(digests: Column) -> Column:
    """Digest of an array of digests."""
    return F.unhex(F.sha2(F.array_join(F.transform(digests, _hex), ""), 256))


def _levels(nodes: DataFrame, most: int, level: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Node rows below the top of each tree (one frame a level), and the tops (tree, level, place, digest).

    ``nodes`` has tree, place, digest and left (nodes of the tree at this level, at most ``most``).
    """
    below: list[DataFrame] = []
    tops: list[DataFrame] = []
    while True:
        tops.append(nodes.filter("left = 1").select("tree", F.lit(level).alias("level"), "place", "digest"))
        if most <= 1:
            return below, tops
        runs = stage_table(
            nodes.filter("left > 1").groupBy("tree", _run_of().alias("run"), "left").agg(
                F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda x: x["digest"]).alias("kids"))
            .withColumn("digest", _hash_of(F.col("kids"))), "merkle/runs")
        kid = runs.select("tree", "run", "kids", F.posexplode("kids").alias("k", "digest"))
        part = lambda a, n: F.array_join(F.transform(F.slice("kids", a, n), _hex), "")
        below.append(kid.select(
            "tree", F.lit(level).alias("level"), (F.col("run") * FANOUT + F.col("k")).alias("place"),
            F.col("tree").alias("parent_tree"), F.lit(level + 1).alias("parent_level"), F.col("run").alias("parent_place"), "digest",
            F.unhex(part(F.lit(1), F.col("k"))).alias("before"),
            F.unhex(part(F.col("k") + 2, F.lit(FANOUT))).alias("after"),
        ))
        nodes = runs.select(
            "tree", F.col("run").alias("place"), "digest", F.ceil(F.col("left") / FANOUT).cast("bigint").alias("left"))
        most, level = -(-most // FANOUT), level + 1


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _laned(nodes: DataFrame, level: int, lanes: DataFrame, upper: bool) -> DataFrame:
    """The node rows of one level with the (source, lane) that pass them: of their own tree, or above the subroots."""
    if not upper and FANOUT ** (level - 1) <= LANE:
        return nodes.select(
            F.col("tree").alias("source"), F.floor(F.col("place") / (LANE // FANOUT ** (level - 1))).alias("lane"), "*")
    if upper:
        return nodes.join(lanes, F.floor(F.col("source") / FANOUT**level) == F.col("place")).select("source", "lane", *nodes.columns)
    return nodes.join(lanes, (F.col("source") == F.col("tree")) & (
        F.floor(F.col("lane") / (FANOUT ** (level - 1) // LANE)) == F.col("place"))).select("source", "lane", *nodes.columns)


class Manifest:
    """``bottom``: the runs of leaves; ``nodes``: node rows above them, by lane; ``tops``: the node that each subroot is.

    ``end`` is the root's node and ``root`` its digest, both None of an empty table.
    """

    def __init__(self, rows: DataFrame):
        found, sizes = numbered(rows)
        leaf = found.join(sizes, "tree")
        kid = F.struct("place", "doc_id", "leaf", "folded")
        self.bottom = stage_table(
            leaf.groupBy("tree", _run_of().alias("run"), "nodes").agg(F.sort_array(F.collect_list(kid)).alias("kids"))
            .withColumn("digest", F.when(F.col("nodes") == 1, F.col("kids")[0]["leaf"]).otherwise(
                _hash_of(F.transform("kids", lambda k: k["leaf"])))), "merkle/bottom")
        lanes = stage_table(self.bottom.select(
            F.col("tree").alias("source"), F.floor(F.col("run") / LANE).alias("lane")).distinct(), "merkle/lanes")
        most = sizes.agg(F.max("nodes")).first()[0] or 0
        # a lone leaf is its own subroot; other runs of leaves are the nodes of level 1
        first = self.bottom.select(
            "tree", F.col("run").alias("place"), "digest", F.ceil(F.col("nodes") / FANOUT).cast("bigint").alias("left"))
        below, tops = _levels(first, -(-most // FANOUT), 1)
        self.tops = stage_table(_union(tops), "merkle/tops")
        trees = self.tops.count()
        upper = self.tops.select(
            F.lit(-1).cast("bigint").alias("tree"), F.col("tree").alias("place"), "digest", F.lit(trees).cast("bigint").alias("left"))
        above, roots = _levels(upper, trees, 0)
        top = _union(roots).first()
        self.root = top["digest"].hex() if top else None
        if above:
            self.end = (-1, len(above), 0)
        else:
            only = self.tops.select(*NODE).first()
            self.end = tuple(only) if only else None
        laned = [_laned(frame, k, lanes, False) for k, frame in enumerate(below, 1)]
        laned += [_laned(frame, k, lanes, True) for k, frame in enumerate(above)]
        if above:  # the lowest rows of the tree of subroots stand for the subroots themselves
            at = len(below)
            named = self.tops.select(F.col("tree").alias("of"), F.col("level").alias("its_level"))
            laned[at] = laned[at].join(named, F.col("source") == F.col("of")).withColumns(
                {"tree": F.col("of"), "level": F.col("its_level"), "place": F.lit(0).cast("bigint")}).select(*laned[at].columns)
        self.nodes = stage_table(_union(laned), "merkle/nodes") if laned else None


CLIMB = """
WITH RECURSIVE climb AS (
  SELECT source, lane, tree, level, place, kids, unhex('') AS common FROM {start}
  UNION ALL
  SELECT c.source, c.lane, n.parent_tree, n.parent_level, n.parent_place,
         transform(c.kids, k -> struct(
           k.doc_id AS doc_id, k.leaf AS leaf,
           unhex(sha2(lower(concat(hex(n.before), hex(k.folded), hex(n.after))), 256)) AS folded)),
         concat(c.common, n.before, n.after)
  FROM climb c JOIN {nodes} n
    ON n.source = c.source AND n.lane = c.lane AND n.tree = c.tree AND n.level = c.level AND n.place = c.place
)
SELECT source, kids, common FROM climb WHERE tree = :tree AND level = :level AND place = :place
"""


def climb(spark: SparkSession, start: DataFrame, nodes: DataFrame, end: tuple[int, int, int]) -> DataFrame:
    """(source, kids, common) of every starting row when it has reached the node ``end``."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # as many rows as runs, a level
    spark.conf.set("spark.sql.cteRecursionLevelLimit", str(DEEPEST))
    return spark.sql(CLIMB, args=dict(zip(NODE, end)), start=start, nodes=nodes)


def prove(rows: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every leaf (see ``leaves``)."""
    made = Manifest(rows)
    run = lambda i: F.array_join(
        F.transform("kids", lambda x, j: _hex(F.when(j == i, x["folded"]).otherwise(x["leaf"]))), "")
    kids = F.transform("kids", lambda k, i: F.struct(
        k["doc_id"].alias("doc_id"), k["leaf"].alias("leaf"),
        F.when(F.col("nodes") == 1, k["folded"]).otherwise(F.unhex(F.sha2(run(i), 256))).alias("folded")))
    done = made.bottom.select(
        F.col("tree").alias("source"), F.floor(F.col("run") / LANE).alias("lane"), "tree", F.lit(1).alias("level"),
        F.col("run").alias("place"), kids.alias("kids"))
    if made.nodes is None:  # nothing to climb: the runs are the subroots, and at most one
        done = done.select("source", "kids", F.unhex(F.lit("")).alias("common"))
    else:
        done = climb(rows.sparkSession, done, made.nodes, made.end)
    others = F.array_join(F.transform(F.filter("kids", lambda _, j: j != F.col("at")), lambda x: _hex(x["leaf"])), "")
    subroots = made.tops.select(F.col("tree").alias("source"), _hex(F.col("digest")).alias("subroot"))
    each = done.select("source", "common", "kids", F.posexplode("kids").alias("at", "k")).join(subroots, "source")
    folded = _hex(F.col("k.folded"))
    return each.select(
        F.col("k.doc_id").alias("doc_id"), _hex(F.col("k.leaf")).alias("leaf"), "subroot",
        F.lit(made.root).cast("string").alias("root"),
        F.sha2(F.concat(others, _hex(F.col("common"))), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.lit(made.root).cast("string")).alias("verified"),
    )
