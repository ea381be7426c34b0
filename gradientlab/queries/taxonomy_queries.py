"""Queries for species names.

Submitted names are part names with a typo that depends on the part key: none,
a dropped letter, a doubled last letter, an exchanged first letter or two
changes; one in seven is unknown altogether.
"""

from pyspark.sql import functions as F

from ..functions.semantics import null_safe_join, recode
from ..functions.text import genus, tail, word
from ..operators import taxonomy as T
from ..operators.community import site_species
from ..operators.reshape import first_per_key
from .mapping import OBS_SQL, obs, table
from .registry import query

TYPO_SQL = """
typed AS (
  SELECT p_partkey AS row_no, p_brand AS destSiteID, p_type AS Region, p_name,
    CASE p_partkey % 7
      WHEN 0 THEN p_name
      WHEN 1 THEN substring(p_name, 1, 1) || substring(p_name, 3)
      WHEN 2 THEN p_name || right(p_name, 1)
      WHEN 3 THEN 'x' || substring(p_name, 2)
      WHEN 4 THEN 'x' || substring(p_name, 2) || 'z'
      WHEN 5 THEN '?' || p_name || p_brand
      ELSE p_name END AS submitted_name
  FROM part
),
backbone AS (SELECT p_name AS matched_name, min(p_partkey) AS gni_uuid FROM part GROUP BY 1)"""
RESOLVED_SQL = TYPO_SQL + """,
near AS (
  SELECT n.submitted_name, b.matched_name, b.gni_uuid, levenshtein(n.submitted_name, b.matched_name) AS distance
  FROM (SELECT DISTINCT submitted_name FROM typed) n, backbone b
  WHERE levenshtein(n.submitted_name, b.matched_name) <= 2
),
resolved AS (
  SELECT submitted_name, gni_uuid, matched_name,
         round(1 - distance::DOUBLE / greatest(length(submitted_name), length(matched_name)), 6) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY submitted_name ORDER BY distance, matched_name) AS rn FROM near)
  WHERE rn = 1
)"""
CLEANED_SQL = RESOLVED_SQL + """,
cleaned AS (
  SELECT t.row_no, t.Region, t.destSiteID, t.p_name || ' spec' AS original_name, t.submitted_name, r.gni_uuid, r.score,
         r.matched_name
  FROM typed t LEFT JOIN resolved r ON r.submitted_name = t.submitted_name
)"""


def typed(spark, folder):
    part = table(spark, folder, "part")
    name, k = F.col("p_name"), F.col("p_partkey") % 7
    swapped = F.concat(F.lit("x"), tail(name, 2))
    submitted = (
        F.when(k == 1, F.concat(F.substring(name, 1, 1), tail(name, 3)))
        .when(k == 2, F.concat(name, F.right(name, F.lit(1))))
        .when(k == 3, swapped)
        .when(k == 4, F.concat(swapped, F.lit("z")))
        .when(k == 5, F.concat(F.lit("?"), name, F.col("p_brand")))
        .otherwise(name)
    )
    return part.select(
        F.col("p_partkey").alias("row_no"), F.col("p_brand").alias("destSiteID"), F.col("p_type").alias("Region"),
        "p_name", submitted.alias("submitted_name"),
    )


def backbone(spark, folder):
    return table(spark, folder, "part").groupBy(F.col("p_name").alias("matched_name")).agg(
        F.min("p_partkey").alias("gni_uuid")
    )


def resolved_names(names, known):
    names = names.withColumn("original_name", F.concat("p_name", F.lit(" spec"))).drop("p_name")
    return T.attach_resolution(names, T.resolve_names(names, known))


def cleaned(spark, folder):
    return resolved_names(typed(spark, folder), backbone(spark, folder))


@query("species_code", """
SELECT DISTINCT CASE code WHEN 'sma bol' THEN 'sma blt' ELSE code END AS code, p_name AS taxa FROM (
  SELECT p_name, substring(split_part(p_name, ' ', 1), 1, 3) || ' ' || substring(split_part(p_name, ' ', 2), 1, 3) AS code
  FROM part)
""")
def species_code(spark, folder):
    df = table(spark, folder, "part").select(F.col("p_name").alias("taxa")).distinct()
    code = T.species_code(word("taxa", 1), word("taxa", 2), " ", {"sma bol": "sma blt"})
    return df.select(code.alias("code"), "taxa")


def _books(spark, folder):
    parts = table(spark, folder, "part").select(F.col("p_name").alias("taxa"), "p_size").distinct()
    coded = parts.withColumn("code", T.species_code(word("taxa", 1), word("taxa", 2), "."))
    small = coded.filter(F.col("p_size") <= 25).select("code", "taxa").distinct()
    large = coded.filter(F.col("p_size") > 20).select(
        "code", F.when(F.col("taxa").startswith("old"), "NA NA").otherwise(F.upper("taxa")).alias("taxa")
    ).distinct()
    return T.merge_codebooks([(["AFRICA", "ASIA"], small), (["EUROPE", "ASIA"], large)])


BOOKS_SQL = """
coded AS (SELECT DISTINCT p_name AS taxa, p_size,
                 substring(split_part(p_name, ' ', 1), 1, 3) || '.' || substring(split_part(p_name, ' ', 2), 1, 3) AS code
          FROM part),
small AS (SELECT DISTINCT code, taxa FROM coded WHERE p_size <= 25),
large AS (SELECT DISTINCT code, upper(taxa) AS taxa FROM coded WHERE p_size > 20 AND taxa NOT LIKE 'old%'),
books AS (
  SELECT unnest(['AFRICA', 'ASIA']) AS Region, code, taxa FROM small
  UNION ALL SELECT unnest(['EUROPE', 'ASIA']) AS Region, code, taxa FROM large)"""


@query("merge_codebooks", "WITH" + BOOKS_SQL + " SELECT Region, code, taxa FROM books")
def merge_codebooks(spark, folder):
    return _books(spark, folder)


@query("attach_names", "WITH" + OBS_SQL + "," + BOOKS_SQL + """,
census AS (SELECT DISTINCT Region, destSiteID,
  substring(split_part(SpeciesName, ' ', 1), 1, 3) || '.' || substring(split_part(SpeciesName, ' ', 2), 1, 3) AS SpeciesName
  FROM obs)
SELECT c.Region, c.destSiteID, c.SpeciesName, b.taxa, coalesce(b.taxa, c.SpeciesName) AS original_name
FROM census c LEFT JOIN books b ON b.Region = c.Region AND b.code = c.SpeciesName
""")
def attach_names(spark, folder):
    """A code with two names gives two rows; regions without a book keep the code."""
    df = obs(spark, folder).withColumn(
        "SpeciesName", T.species_code(word("SpeciesName", 1), word("SpeciesName", 2), ".")
    )
    return T.attach_names(site_species(df), _books(spark, folder))


@query("apply_synonyms", """
SELECT p_partkey, p_name AS original_name, CASE p_name WHEN 'small ring' THEN 'minor ring'
  WHEN 'red widget' THEN 'rubra widget' ELSE p_name END AS submitted_name FROM part
""")
def apply_synonyms(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("original_name"))
    return T.apply_synonyms(df, {"small ring": "minor ring", "red widget": "rubra widget"})


@query("resolve_exact", "WITH" + TYPO_SQL + """
SELECT DISTINCT t.submitted_name AS user_supplied_name, b.gni_uuid, CASE WHEN b.gni_uuid IS NULL THEN NULL ELSE 1.0::DOUBLE END AS score,
       b.matched_name
FROM typed t LEFT JOIN backbone b ON b.matched_name = t.submitted_name
""")
def resolve_exact(spark, folder):
    return T.resolve_names(typed(spark, folder), backbone(spark, folder), edits=0)


@query("resolve_fuzzy", "WITH" + RESOLVED_SQL + """
SELECT DISTINCT t.submitted_name AS user_supplied_name, r.gni_uuid, r.score, r.matched_name
FROM typed t LEFT JOIN resolved r ON r.submitted_name = t.submitted_name
""")
def resolve_fuzzy(spark, folder):
    out = T.resolve_names(typed(spark, folder), backbone(spark, folder))
    return out.withColumn("score", F.round("score", 6))


@query("number_unresolved", "WITH" + CLEANED_SQL + """
SELECT row_no, Region, destSiteID, original_name, gni_uuid,
  CASE WHEN gni_uuid IS NULL THEN Region || '_NID_' || k ELSE submitted_name END AS submitted_name,
  CASE WHEN gni_uuid IS NULL THEN Region || '_NID_' || k ELSE matched_name END AS matched_name
FROM (SELECT *, row_number() OVER (PARTITION BY Region, gni_uuid IS NULL ORDER BY row_no) AS k FROM cleaned)
""")
def number_unresolved(spark, folder):
    return T.number_unresolved(cleaned(spark, folder)).drop("score")


# -- trait list -------------------------------------------------------------

MATCH_SQL = CLEANED_SQL + "," + """
species AS (
  SELECT gni_uuid AS species_row, gni_uuid, matched_name AS accepted_name, matched_name || 's' AS submitted_name,
         split_part(matched_name, ' ', 1) AS genus, length(matched_name)::DOUBLE AS leaf_area
  FROM backbone WHERE matched_name NOT LIKE '%ring'
),
matched AS (
  SELECT c.*, coalesce(
    (SELECT min(species_row) FROM species s WHERE s.gni_uuid = c.gni_uuid),
    (SELECT min(species_row) FROM species s WHERE s.accepted_name = c.matched_name),
    (SELECT min(species_row) FROM species s WHERE s.accepted_name = c.submitted_name),
    (SELECT min(species_row) FROM species s WHERE s.accepted_name = c.original_name),
    (SELECT min(species_row) FROM species s WHERE s.submitted_name = c.matched_name),
    (SELECT min(species_row) FROM species s WHERE s.submitted_name = c.submitted_name),
    (SELECT min(species_row) FROM species s WHERE s.submitted_name = c.original_name)) AS species_match
  FROM cleaned c
),
full_match AS (
  SELECT m.*, coalesce(m.species_match,
    (SELECT min(species_row) FROM species s WHERE s.genus = split_part(m.matched_name, ' ', 1)),
    (SELECT min(species_row) FROM species s WHERE s.genus = split_part(m.submitted_name, ' ', 1)),
    (SELECT min(species_row) FROM species s WHERE s.genus = split_part(m.original_name, ' ', 1))) AS genus_match
  FROM matched m
)"""


def trait_list(spark, folder):
    names = backbone(spark, folder).filter(~F.col("matched_name").endswith("ring"))
    return names.select(
        F.col("gni_uuid").alias("species_row"), "gni_uuid", F.col("matched_name").alias("accepted_name"),
        F.concat("matched_name", F.lit("s")).alias("submitted_name"), genus("matched_name").alias("genus"),
    )


@query("match_hierarchy", "WITH" + MATCH_SQL + """
SELECT row_no, species_match, genus_match FROM full_match
""")
def match_hierarchy(spark, folder):
    out = T.match_hierarchy(cleaned(spark, folder), trait_list(spark, folder))
    return out.select("row_no", "species_match", "genus_match")


@query("attach_trait_db", "WITH" + MATCH_SQL + """
SELECT 'species' AS part, f.Region, f.destSiteID, f.original_name, f.submitted_name, f.matched_name AS accepted_name,
       s.accepted_name AS try_name, s.genus, s.leaf_area FROM full_match f LEFT JOIN species s ON s.species_row = f.species_match
UNION ALL
SELECT 'genus', f.Region, f.destSiteID, f.original_name, f.submitted_name, f.matched_name,
       s.accepted_name, s.genus, s.leaf_area FROM full_match f LEFT JOIN species s ON s.species_row = f.genus_match
""")
def attach_trait_db(spark, folder):
    species = trait_list(spark, folder)
    matched = T.match_hierarchy(cleaned(spark, folder), species)
    numeric = species.select("species_row", F.length("accepted_name").cast("double").alias("leaf_area"))
    categorical = species.select("species_row")
    return T.attach_trait_rows(matched, species, categorical, numeric)


@query("first_match", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, f.row_no AS first_row
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
JOIN (SELECT p_name, min(p_partkey) AS row_no FROM part GROUP BY 1) f ON f.p_name = p.p_name
""")
def first_match(spark, folder):
    """Position of the first equal name in a list with repetitions."""
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    first = first_per_key(part.withColumnRenamed("p_partkey", "row_no"), ["p_name"], "row_no")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    named = lines.join(part, lines["l_partkey"] == part["p_partkey"])
    return null_safe_join(named, first, ["p_name"], "inner").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("row_no").alias("first_row")
    )


@query("recode_names", """
SELECT p_name, CASE p_type WHEN 'PROMO' THEN 'P' WHEN 'SMALL' THEN 'S' ELSE p_type END AS kept, count(*) AS n
FROM part GROUP BY 1, 2
""")
def recode_names(spark, folder):
    df = table(spark, folder, "part").withColumn("kept", recode("p_type", {"PROMO": "P", "SMALL": "S"}))
    return df.groupBy("p_name", "kept").agg(F.count(F.lit(1)).alias("n"))


# -- code books -------------------------------------------------------------

def _taxa(spark, folder):
    """Names with a marker in the epithet for some parts."""
    k = F.col("p_partkey") % 5
    marked = F.when(k == 1, F.concat(word("p_name", 1), F.lit(" sp."))).when(k == 2, F.concat("p_name", F.lit(" sp?")))
    return table(spark, folder, "part").select("p_partkey", F.coalesce(marked, "p_name").alias("speciesName"))


TAXA_SQL = """
taxa AS (SELECT CASE p_partkey % 5 WHEN 1 THEN split_part(p_name, ' ', 1) || ' sp.' WHEN 2 THEN p_name || ' sp?'
                ELSE p_name END AS taxa FROM part)"""


@query("norway_codebook", "WITH" + TAXA_SQL + """,
cores AS (SELECT DISTINCT taxa, CASE WHEN strpos(taxa, ' ') > 0 THEN substring(taxa, strpos(taxa, ' ') + 1) ELSE '' END AS rest
          FROM taxa)
SELECT substring(split_part(taxa, ' ', 1), 1, 3) || '.' || substring(regexp_replace(replace(replace(rest, 'sp.', 'sp'),
  'sp?', 'sp'), '[[:punct:] ]+', '', 'g'), 1, 3) AS code, taxa FROM cores
""")
def norway_codebook(spark, folder):
    return T.norway_codebook(_taxa(spark, folder))


@query("sweden_codebook", """
WITH listed AS (SELECT 'K' || p_partkey AS code, CASE WHEN p_size > 10 THEN p_name END AS taxa FROM part),
later AS (SELECT split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part
          WHERE split_part(p_name, ' ', 1) NOT IN ('moss', 'litter', 'lichen'))
SELECT DISTINCT code, taxa FROM (
  SELECT code, taxa FROM listed WHERE taxa IS NOT NULL
  UNION ALL SELECT substring(a, 1, 3) || ' ' || substring(b, 1, 3), a || ' ' || b FROM later)
""")
def sweden_codebook(spark, folder):
    part = table(spark, folder, "part")
    listed = part.select(
        F.concat(F.lit("K"), F.col("p_partkey").cast("string")).alias("code"), F.when(F.col("p_size") > 10, F.col("p_name")).alias("taxa"))
    return T.sweden_codebook(listed, part.select(F.col("p_name").alias("species")))


@query("arizona_codebook", """
SELECT p_brand AS code, coalesce(nullif(split_part(p_name, ' ', 1), 'red'), 'NA') || ' ' || split_part(p_name, ' ', 2) AS taxa FROM part
""")
def arizona_codebook(spark, folder):
    """A missing part of a name prints as NA."""
    first = word("p_name", 1)
    return T.arizona_codebook(table(spark, folder, "part").select(
        F.col("p_brand").alias("Code"), F.when(first != "red", first).alias("Genus"), word("p_name", 2).alias("Species")))
