"""Queries for the grammar of names.

Part names are species names, written in nine ways: with an author, a subspecies, cf., aff., a hybrid sign, an open
determination, a second parent, two lower ranks, or a mark that makes them unreadable.
"""

from pyspark.sql import functions as F

from ..functions.text import word
from ..operators import names as N
from .mapping import table
from .registry import query

# The parts of every spelling are known by construction; the SQL states them and parses nothing.
SPELT_SQL = """
words AS (SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS g, split_part(p_name, ' ', 2) AS e,
                 upper(p_name[1]) || p_name[2:] AS cap FROM part),
spelt AS (
  SELECT p_partkey, g, p_name, CASE p_partkey % 9
      WHEN 0 THEN p_name || ' L.' WHEN 1 THEN cap || ' subsp. alpina (L.) Koch' WHEN 2 THEN g || ' cf. ' || e
      WHEN 3 THEN g || ' aff. ' || e WHEN 4 THEN g || ' × ' || e WHEN 5 THEN g || ' sp.'
      WHEN 6 THEN cap || ' × Large bolt' WHEN 7 THEN p_name || ' var. nana f. rosea Hook. f.' ELSE '?' || p_name END AS name,
    CASE p_partkey % 9
      WHEN 1 THEN [p_name || ' alpina', p_name, g] WHEN 7 THEN [p_name || ' nana rosea', p_name || ' nana', p_name, g]
      WHEN 3 THEN [g] WHEN 5 THEN [g] WHEN 6 THEN [g] WHEN 8 THEN [] ELSE [p_name, g] END AS forms,
    CASE p_partkey % 9
      WHEN 1 THEN ['subsp', 'species', 'genus'] WHEN 7 THEN ['f', 'var', 'species', 'genus']
      WHEN 3 THEN ['genus'] WHEN 5 THEN ['genus'] WHEN 6 THEN ['genus'] WHEN 8 THEN [] ELSE ['species', 'genus'] END AS ranks,
    CASE p_partkey % 9 WHEN 0 THEN 'L.' WHEN 1 THEN '(L.) Koch' WHEN 7 THEN 'Hook. f.' END AS authors,
    p_partkey % 9 IN (4, 6) AS hybrid, CASE p_partkey % 9 WHEN 2 THEN 'cf' WHEN 3 THEN 'aff' END AS qualifier,
    CASE p_partkey % 9 WHEN 1 THEN cap || ' alpina' WHEN 6 THEN split_part(cap, ' ', 1) WHEN 3 THEN g WHEN 5 THEN g
      WHEN 7 THEN p_name || ' nana rosea' WHEN 8 THEN NULL ELSE p_name END AS canonical
  FROM words
)"""


def spelt(spark, folder):
    name, k = F.col("p_name"), F.col("p_partkey") % 9
    g, e = word(name, 1), word(name, 2)
    cap = F.concat(F.upper(F.substring(name, 1, 1)), F.substr(name, F.lit(2)))
    spellings = [
        F.concat(name, F.lit(" L.")), F.concat(cap, F.lit(" subsp. alpina (L.) Koch")), F.concat(g, F.lit(" cf. "), e),
        F.concat(g, F.lit(" aff. "), e), F.concat(g, F.lit(" × "), e), F.concat(g, F.lit(" sp.")),
        F.concat(cap, F.lit(" × Large bolt")), F.concat(name, F.lit(" var. nana f. rosea Hook. f.")),
        F.concat(F.lit("?"), name),
    ]
    return table(spark, folder, "part").select("p_partkey", F.try_element_at(F.array(*spellings), (k + 1).cast("int")).alias("name"))


@query("parse_names", "WITH" + SPELT_SQL + """
SELECT p_partkey, name, canonical, array_to_string(forms, ';') AS forms, array_to_string(list_reverse(ranks), ';') AS ranks,
       authors, hybrid, qualifier FROM spelt
""")
def parse_names(spark, folder):
    """A name that can't be read has no form and no rank, here empty texts."""
    p = N.parse_names(spelt(spark, folder), "name")
    joined = lambda c: F.coalesce(F.array_join(c, ";"), F.lit(""))
    return p.select(
        "p_partkey", "name", "parsed.canonical", joined("parsed.forms").alias("forms"), joined("parsed.ranks").alias("ranks"),
        "parsed.authors", "parsed.hybrid", "parsed.qualifier")


@query("resolve_ranked", "WITH" + SPELT_SQL + """,
listed AS (
  SELECT matched_name, form, min(gni_uuid) AS gni_uuid FROM (
    SELECT p_name || ' Mill.' AS matched_name, p_name AS form, p_partkey AS gni_uuid FROM words WHERE p_partkey % 4 = 0
    UNION ALL SELECT p_name || ' ssp. alpina', p_name || ' alpina', p_partkey FROM words WHERE p_partkey % 5 = 0
    UNION ALL SELECT p_name || ' var. nana Mill.', p_name || ' nana', p_partkey FROM words WHERE p_partkey % 7 = 0
    UNION ALL SELECT g, g, p_partkey FROM words WHERE g < 'm') GROUP BY 1, 2
),
tried AS (SELECT DISTINCT name, canonical, len(forms) AS levels, unnest(forms) AS form, unnest(ranks) AS rank,
                 generate_subscripts(forms, 1) - 1 AS step FROM spelt),
best AS (SELECT t.name, t.levels, t.step, t.rank, l.matched_name, l.gni_uuid FROM tried t JOIN listed l ON l.form = t.form
         QUALIFY row_number() OVER (PARTITION BY t.name ORDER BY t.step, l.matched_name) = 1)
SELECT s.name AS user_supplied_name, s.canonical, b.gni_uuid, (b.levels - b.step)::DOUBLE / b.levels AS score, b.matched_name,
       b.rank AS matched_rank
FROM (SELECT DISTINCT name, canonical FROM spelt) s LEFT JOIN best b ON b.name = s.name
""")
def resolve_ranked(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name", word("p_name", 1).alias("g"))
    k, name = F.col("p_partkey"), F.col("p_name")
    spellings = F.array(
        F.when(k % 4 == 0, F.concat(name, F.lit(" Mill."))), F.when(k % 5 == 0, F.concat(name, F.lit(" ssp. alpina"))),
        F.when(k % 7 == 0, F.concat(name, F.lit(" var. nana Mill."))), F.when(F.col("g") < "m", F.col("g")))
    backbone = part.select(k.alias("gni_uuid"), F.explode(F.array_compact(spellings)).alias("matched_name"))
    return N.resolve_ranked(spelt(spark, folder), backbone, "name")
