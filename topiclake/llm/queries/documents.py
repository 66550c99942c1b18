"""Queries over ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from topiclake.llm import decontaminate, licenses, lines, merkle, near_copies, packing, quality, repeats
from topiclake.llm.queries import query
from topiclake.llm.tables import table

_OP9 = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s) AS n_shingles, l.c AS component_id, s.doc_id = l.c AS kept
FROM sets s JOIN least l ON l.a = s.doc_id
"""


@query("op9_near_copies", _OP9)
def op9_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies.near_copies(table(spark, folder, "documents"))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, folder, "labels")))


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP7 = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), window_of AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(1, len(w) - 9) + 1),
    lambda i: array_to_string(w[i : i + 9], ' '))) AS g FROM item WHERE len(w) > 0
), place AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM window_of))
), hit AS (
  SELECT p.doc_id, p.i, p.n, v.item_id FROM place p JOIN window_of v USING (n, g)
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op7_decontaminate", _OP7)
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query("op1_repeated_passages")
def op1_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


@query("op4_packing")
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


_OP5 = """
WITH line AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), word AS (
  SELECT doc_id, no, list_filter(string_split_regex(line, '[ \\t\\r\\x0B\\f]+'), lambda x: x <> '') AS w FROM line
), item AS (
  SELECT doc_id, no, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
  FROM word WHERE len(w) > 0
), token AS (SELECT doc_id, no, len(s) AS n, unnest(s) AS g FROM item),
gone AS (
  SELECT DISTINCT doc_id, no FROM (
    SELECT y.doc_id, y.no FROM token x JOIN token y ON x.g = y.g AND (x.doc_id < y.doc_id OR x.doc_id = y.doc_id AND x.no < y.no)
    GROUP BY x.doc_id, x.no, y.doc_id, y.no, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*)))
), lost AS (
  SELECT doc_id, count(*) AS n, sum(length(line)) AS chars FROM gone JOIN line USING (doc_id, no) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines, coalesce(n, 0) AS n_removed,
  length(coalesce(text, '')) - CAST(coalesce(chars, 0) AS BIGINT) AS kept_chars
FROM documents d LEFT JOIN lost USING (doc_id)
"""


@query("op5_line_dedup", _OP5)
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: lines, lines removed, and characters that are kept, line ends of removed lines included."""
    docs = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit(""))
    sizes = docs.select(
        "doc_id",
        F.xxhash64("doc_id", text).alias("doc_key"),
        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.length(text).cast("long").alias("chars"),
    )
    found = sizes.join(lines.removed_lines(docs), "doc_key", "left")
    return found.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        (F.col("chars") - F.coalesce("lost", F.lit(0))).alias("kept_chars"),
    )


def _tagged(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_tagged(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_OP11 = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql("replace(text, chr(10), '')")} AS cut,
    xor(list_reduce(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ord(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)),
      lambda c, b: list_reduce(range(8), lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)), 4294967295), 4294967295) % 2 = 0 AS tampered
  FROM documents
), leaf AS (
  SELECT doc_id, leaf, CASE WHEN tampered THEN cut ELSE leaf END AS changed, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS no, count(*) OVER (PARTITION BY source) AS n FROM base
), node AS (
  SELECT tree, 0 AS lvl, no AS pos, n, leaf AS h FROM leaf
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY tree, lvl, pos // 3, n
), sub AS (SELECT tree, h FROM node WHERE n = 1),
top AS (
  SELECT 0 AS lvl, tree AS pos, (SELECT count(*) FROM sub) AS n, h FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n
), step AS (
  SELECT tree, lvl, pos, coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT tree, lvl, pos, n, h FROM node UNION ALL SELECT -1, lvl, pos, n, h FROM top) WHERE n > 1
), walk AS (
  SELECT tree, no, 0 AS lvl, no AS pos, changed AS acc, '' AS sib FROM leaf
  UNION ALL
  SELECT w.tree, w.no, w.lvl + 1, w.pos // 3, sha256(l || acc || r), sib || l || r FROM walk w JOIN step s ON s.tree = w.tree AND s.lvl = w.lvl AND s.pos = w.pos
), low AS (SELECT tree, no, arg_max(acc, lvl) AS acc, arg_max(sib, lvl) AS sib FROM walk GROUP BY tree, no),
climb AS (
  SELECT tree, no, 0 AS lvl, tree AS pos, acc, sib FROM low
  UNION ALL
  SELECT w.tree, w.no, w.lvl + 1, w.pos // 3, sha256(l || acc || r), sib || l || r FROM climb w JOIN step s ON s.tree = -1 AND s.lvl = w.lvl AND s.pos = w.pos
), done AS (SELECT tree, no, arg_max(acc, lvl) AS acc, arg_max(sib, lvl) AS sib FROM climb GROUP BY tree, no)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(sib) AS proof_sha256, acc AS folded_root, acc = top.h AS verified
FROM leaf JOIN done USING (tree, no) JOIN sub USING (tree) JOIN top ON top.n = 1
"""


@query("op11_merkle_manifest", _OP11)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all rows, and the roots they lead to when every second text has lost its line ends."""
    docs = table(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = merkle.digest(*fields)
    cut = merkle.digest(*fields[:-1], F.replace("text", F.lit("\n"), F.lit("")))
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    carry = {"doc_id": F.col("doc_id"), "changed": F.when(tampered, cut)}
    proved = merkle.prove(merkle.build(docs, leaf, "source", ["doc_id"], carry))
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("proof"))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
