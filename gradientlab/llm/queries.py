"""One query per operator, over its whole table."""

import public_tokenizers
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    bpe, chat, decontaminate, embedding_join, fill_middle, html_text, langid, line_dedup, merkle, minhash, nbsvm, packing, sharding,
)
from .common import held_out, table
from .registry import query

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query("op4_byte_bpe")
def op4_byte_bpe(spark, folder):
    """Ids of every text by the rank file, decoded again; digests of both."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, RANKS).select("doc_id", "ids"), RANKS)
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_token_files")
def op10_token_files(spark, folder):
    """All texts as packed id files in ascending doc_id order, read back."""
    files = scratch_path(spark, "token_files")
    packing.write_ids(table(spark, folder, "documents"), files, TOKENIZER)
    return packing.read_documents(spark, files)


@query("op1_quality")
def op1_quality(spark, folder):
    """Score of every document by a model learnt outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = nbsvm.score(docs, nbsvm.fit(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= nbsvm.REJECT_BELOW).cast("int").alias("predicted"),
    )


@query("op7_language")
def op7_language(spark, folder):
    """Predicted language of every document by a model learnt outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


@query("op2_sharding")
def op2_sharding(spark, folder):
    """All documents in 40 shards of near equal bytes."""
    placed = sharding.shard_documents(table(spark, folder, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_chat")
def op5_chat(spark, folder):
    """All conversations, and one that consists of control strings, formatted and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    files = scratch_path(spark, "chat")
    chat.write_formatted(turns.unionByName(extra), files)
    return chat.read_back(spark.read.parquet(files))


@query("op8_decontaminate", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents
), b AS (
  SELECT min(item_id) AS item_id, w, len(w) AS n
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark) GROUP BY w HAVING len(w) >= 1
), dw AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
bw AS (SELECT item_id, n, unnest(w) AS word, generate_subscripts(w, 1) AS ipos FROM b),
same AS (
  SELECT doc_id, item_id, n, pos - ipos AS shift, ipos,
         lead(ipos, 9) OVER a - ipos AS span, count(*) OVER (PARTITION BY doc_id, item_id, pos - ipos) AS agreeing
  FROM dw JOIN bw USING (word) WHERE n >= 6 WINDOW a AS (PARTITION BY doc_id, item_id, pos - ipos ORDER BY ipos)
), hit AS (
  SELECT doc_id, item_id, max(agreeing) AS agreeing FROM same
  WHERE (n >= 12 AND span < 12) OR (n BETWEEN 8 AND 11 AND agreeing >= n - 1) OR (n < 8 AND agreeing = n) GROUP BY ALL
  UNION
  SELECT doc_id, item_id, n FROM (
    SELECT doc_id, regexp_extract_all(lower(line), '[\p{L}\p{N}]+') AS w
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  ) JOIN b USING (w) WHERE n < 6
), per AS (
  SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item, max(agreeing) AS most_agreeing FROM hit GROUP BY 1
)
SELECT d.doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, first_item, most_agreeing
FROM documents d LEFT JOIN per USING (doc_id)
""")
def op8_decontaminate(spark, folder):
    """Every document, and whether it overlaps a benchmark item."""
    return decontaminate.flag(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_html_text")
def op6_html_text(spark, folder):
    """Main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


@query("op9_embedding_duplicates")
def op9_embedding_duplicates(spark, folder):
    """Links and component of every vector at cosine 0.95 or more."""
    found = embedding_join.near_duplicates(table(spark, folder, "embeddings"), 0.95)
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query("op3_minhash_duplicates")
def op3_minhash_duplicates(spark, folder):
    """Component of every document at a Jaccard similarity of 0.85 or more."""
    found = minhash.near_duplicates(table(spark, folder, "documents"), 85)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query("op11_merkle", r"""
WITH RECURSIVE d AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, (s & 1) * 3988292384))), 4294967295) % 5 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents
), l AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS folded FROM d
), p AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM l
), low AS (
  SELECT tree, 0 AS level, place, leaf AS digest, n FROM p
  UNION ALL
  SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (n + 15) // 16
  FROM low WHERE n > 1 GROUP BY tree, level, place // 16, n
), sub AS (SELECT tree, level, digest FROM low WHERE n = 1),
up AS (
  SELECT -1 AS tree, 0 AS level, tree AS place, digest, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (n + 15) // 16
  FROM up WHERE n > 1 GROUP BY tree, level, place // 16, n
), nodes AS (
  SELECT *, coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM (FROM low UNION ALL FROM up) WHERE n > 1 WINDOW r AS (PARTITION BY tree, level, place // 16 ORDER BY place)
), climb AS (
  SELECT doc_id, leaf, tree AS own, tree, 0 AS level, place, folded, '' AS proof FROM p
  UNION ALL
  SELECT doc_id, leaf, own, n.tree, n.level + 1, n.place // 16, sha256(before || folded || after), proof || before || after
  FROM climb c JOIN nodes n ON CASE WHEN EXISTS (FROM sub s WHERE s.tree = c.tree AND s.level = c.level)
    THEN n.tree = -1 AND n.level = 0 AND n.place = c.tree ELSE n.tree = c.tree AND n.level = c.level AND n.place = c.place END
), top AS (SELECT digest FROM up WHERE n = 1)
SELECT doc_id, leaf, sub.digest AS subroot, top.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = top.digest AS verified
FROM climb c JOIN sub ON sub.tree = own, top
WHERE CASE WHEN (SELECT count(*) FROM sub) = 1 THEN c.level = sub.level ELSE c.tree = -1 AND c.level = (SELECT max(level) FROM up) END
""")
def op11_merkle(spark, folder):
    """Leaf, subroot and root of every document, and the root that its (perhaps tampered) leaf folds to."""
    docs = table(spark, folder, "documents")
    return merkle.prove(merkle.leaves(docs, merkle.tampered_text(F.col("text"))))


@query("op12_fill_middle", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), e AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
              OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), f AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:least(c1, c2)], '') AS p,
         array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM e
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM f
""")
def op12_fill_middle(spark, folder):
    """Every document cut for filling in its middle, and rebuilt; digests of both."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return fill_middle.fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


@query("op13_line_dedup", r"""
WITH l AS (
  SELECT doc_id, line, place, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents)
), k AS (
  SELECT key, min(doc_id) AS keeper FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), m AS (SELECT doc_id, line, place, keeper IS NOT NULL AND keeper <> doc_id AS dropped FROM l LEFT JOIN k USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op13_line_dedup(spark, folder):
    """Every document without the lines that an earlier one holds; number of lines, of dropped ones, and a digest."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
