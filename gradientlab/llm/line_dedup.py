"""Lines that documents share, kept in one document only; in DataFrame functions only.

A text is split at \\n.  A line's key is the line without blanks (space, \\t, \\n,
\\v, \\f, \\r) at either end and with A-Z in lower case.  Keys of at least
``least_chars`` code points that occur in at least ``least_docs`` different
documents lose all their lines but those of the document with the smallest id.
What stays is joined by \\n in its order.

Keys are compared by 128 bits of their SHA-256.  Each text is split and hashed
once; the hashes of a row are written as one array.  Lines are exploded from there
as (document, place, hash), without their texts: distinct (hash, document) pairs
are counted per hash, frequent hashes are joined back, and the places to drop come
together per document, where the text is split again and put together from
the places that stay.  Every aggregate combines before the shuffle, and a hash that
very many lines share is a large side of a join whose other side has it once, which
the optimizer splits.

Null and empty texts are one empty line.  Very long texts are used whole.  Rows
that share a doc_id are one document and are rebuilt each by itself; rows without
an id are one document too, which comes after all others.  An empty table gives an
empty result.  Other columns pass through (named like an added one: replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import fresh, replace_columns
from .decontaminate import once

#: Fixed value: the blanks that are stripped from a line.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ADDED = "n_lines bigint, n_dropped bigint, kept string"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without outer blanks, A-Z in lower case; other letters stay."""
    bare = F.btrim(line, F.lit(BLANKS))
    # in a line of ASCII alone all of lower() is A-Z, and faster
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, UPPER, UPPER.lower()))


def _hash(key: Column) -> Column:
    return F.substring(F.unhex(F.sha2(key, 256)), 1, 16)


def _identity(df: DataFrame, doc: str, text: str) -> list[Column]:
    """What tells rows apart: equal rows have equal lines."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return [F.col(f"`{doc}`").alias("doc"), F.xxhash64(value).alias("tie"), F.octet_length(value).alias("size")]


def hashed_lines(df: DataFrame, doc: str, text: str, least_chars: int) -> DataFrame:
    """(doc, tie, size, hashes): one row per row; a line whose key is too short has a null hash."""
    each = F.transform(lines(F.col(f"`{text}`")), lambda line: once(line_key(line), lambda key: F.when(
        F.char_length(key) >= least_chars, _hash(key))))
    return df.select(*_identity(df, doc, text), each.alias("hashes"))


def frequent(found: DataFrame, least_docs: int) -> DataFrame:
    """(hash, keeper) of the hashes in at least ``least_docs`` documents; the keeper is the smallest id."""
    each = found.select("doc", F.explode(F.array_distinct(F.array_compact("hashes"))).alias("hash"))
    per_doc = each.groupBy("hash", "doc").agg(F.lit(1).alias("one"))
    return per_doc.groupBy("hash").agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("keeper")).filter(
        F.col("docs") >= least_docs).select("hash", "keeper")


def dropped_places(docs: DataFrame, doc: str, text: str, least_chars: int, least_docs: int) -> DataFrame:
    """(doc, tie, size, dropped): the places of the lines to drop, for rows that have some."""
    found = stage_table(hashed_lines(docs, doc, text, least_chars), "lines/hashes")
    each = found.select("doc", "tie", "size", F.posexplode("hashes").alias("place", "hash")).filter("hash IS NOT NULL")
    # written, so that a hash which very many lines share is split: its join then stands between two exchanges
    often = stage_table(frequent(found, least_docs), "lines/frequent")
    gone = each.join(often, "hash").filter(~F.col("doc").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc", "tie", "size").agg(F.collect_set("place").alias("dropped"))


def drop_repeated_lines(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", least_chars: int = 10, least_docs: int = 2,
) -> DataFrame:
    """Add n_lines, n_dropped and kept, the text without the dropped lines."""
    places = dropped_places(docs, doc, text, least_chars, least_docs)
    names = fresh(docs, "__doc", "__tie", "__size", "__dropped")
    places = places.select(*[F.col(c).alias(n) for c, n in zip(places.columns, names)])
    key, tie, size, dropped = names
    _, own_tie, own_size = _identity(docs, doc, text)
    rows = docs.join(
        places, F.col(f"`{doc}`").eqNullSafe(F.col(key)) & (own_tie == F.col(tie)) & (own_size == F.col(size)), "left")
    gone = F.coalesce(F.col(dropped), F.array().cast("array<int>"))
    # all that is needed of the lines and their places, from one split
    state = once(F.struct(lines(F.col(f"`{text}`")).alias("lines"), gone.alias("gone")), lambda x: F.struct(
        F.size(x["lines"]).cast("bigint").alias("n_lines"), F.size(x["gone"]).cast("bigint").alias("n_dropped"),
        F.when(F.size(x["gone"]) == 0, F.array_join(x["lines"], "\n")).otherwise(F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["gone"]), lambda i: F.get(x["lines"], i)), "\n"),
        ).alias("kept")))
    (found,) = fresh(rows, "__found")
    work, schema = replace_columns(rows.withColumn(found, state).drop(*names), ADDED)
    added = [F.col(f"`{found}`.{c}").alias(c) for c in ("n_lines", "n_dropped", "kept")]
    return work.select(*[F.col(f"`{c}`") for c in work.columns if c != found], *added)
