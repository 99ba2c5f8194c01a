"""Registered queries of the operators over the sample tables, and SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsight.llm.html_text import extract_text
from keepsight.llm.language import identify_language
from keepsight.llm.merkle import audit, merkle_manifest
from keepsight.llm.mixing import mix_report
from keepsight.llm.near_duplicates import near_duplicates
from keepsight.llm.neighbours import nearest_neighbours
from keepsight.llm.packing import pack
from keepsight.llm.ppm import score_documents
from keepsight.llm.prefix_trie import conversation_trie
from keepsight.llm.quality import judge_quality
from keepsight.llm.store import table
from keepsight.llm.token_counts import count_tokens
from keepsight.llm.toxicity import score_toxicity
from keepsight.llm.url_rules import judge_urls

# fixed values: the rules that the urls are judged by (host, path, verdict)
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
QUERY_EVERY = 50


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public tokenizer's file; every executor has it installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def url_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(URL_RULES, "host string, path string, verdict string")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_harmonic_packing": lambda spark, d: pack(table(spark, d, "documents"), vocabulary_path()),
    "op2_nearest_neighbours": lambda spark, d: nearest_neighbours(
        table(spark, d, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0
    ),
    "op3_toxicity": lambda spark, d: score_toxicity(
        table(spark, d, "documents"), table(spark, d, "labels")
    ),
    "op4_url_filter": lambda spark, d: judge_urls(table(spark, d, "pages"), url_rules(spark)),
    "op5_language": lambda spark, d: identify_language(table(spark, d, "documents")),
    "op6_near_duplicates": lambda spark, d: near_duplicates(table(spark, d, "documents")),
    "op7_html_text": lambda spark, d: extract_text(table(spark, d, "pages")),
    "op8_quality": lambda spark, d: judge_quality(table(spark, d, "documents")),
    "op9_language_model": lambda spark, d: score_documents(table(spark, d, "documents")),
    "op10_mixing": lambda spark, d: mix_report(table(spark, d, "documents")).drop("shards"),
    "op11_token_counts": lambda spark, d: count_tokens(
        table(spark, d, "documents"), vocabulary_path(BYTE_VOCABULARY)
    ),
    "op12_merkle_manifest": lambda spark, d: audit(merkle_manifest(table(spark, d, "documents"))),
    "op13_prefix_trie": lambda spark, d: conversation_trie(table(spark, d, "conversations"), rebuilt=True),
}

_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: crc32 of a decimal id in SQL: a table of the 256 bytes, then a fold over the id's digits.
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC_TABLE = f"""
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: {_CRC_STEP}, i) ORDER BY i) AS crcs
  FROM (SELECT unnest(range(256)) AS i))"""


def _crc32(column: str) -> str:
    digits = f"list_transform(string_split({column}::varchar, ''), lambda d: ascii(d)::bigint)"
    step = "xor(c >> 8, crcs[xor(c, d) % 256 + 1])"
    return f"xor(list_reduce({digits}, lambda c, d: {step}, 4294967295::bigint), 4294967295)"


def _framed(value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_framed, ["doc_id", "source", "lang", "n_chars", text])) + ")"


ORACLES: dict[str, str] = {
    "op12_merkle_manifest": f"""
WITH RECURSIVE {_CRC_TABLE.strip()},
leaves AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("doc_id")} % 3 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n
  FROM documents, crc_table),
nodes(lang, level, i, n, digest) AS (
  SELECT lang, 0, i, n, leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY lang, level, i // 8, n),
tops AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
upper_nodes(level, i, n, digest) AS (
  SELECT 0, i, n, digest FROM tops
  UNION ALL
  SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i))
  FROM upper_nodes WHERE n > 1 GROUP BY level, i // 8, n),
root AS (SELECT digest AS root FROM upper_nodes WHERE n = 1),
every AS (
  SELECT lang, level, i, n, digest, false AS up FROM nodes
  UNION ALL SELECT NULL, level, i, n, digest, true FROM upper_nodes),
spans AS (
  SELECT doc_id, leaf, tampered, l.lang, l.i, t.i AS top, t.digest AS subroot,
    (SELECT max(level) FROM nodes x WHERE x.lang IS NOT DISTINCT FROM l.lang) AS depth,
    (SELECT max(level) FROM upper_nodes) AS upper_depth
  FROM leaves l JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang),
places AS (
  SELECT doc_id, leaf, unnest(range(depth)) AS step, false AS up, lang, i, unnest(range(depth)) AS level FROM spans
  UNION ALL
  SELECT doc_id, leaf, depth + unnest(range(upper_depth)), true, NULL, top, unnest(range(upper_depth)) FROM spans),
ways AS (
  SELECT p.doc_id, p.leaf, p.step,
    coalesce(string_agg(e.digest, '' ORDER BY e.i) FILTER (WHERE e.i < p.i), '') AS before,
    coalesce(string_agg(e.digest, '' ORDER BY e.i) FILTER (WHERE e.i > p.i), '') AS after
  FROM (SELECT * REPLACE (i // (8 ** level)::bigint AS i) FROM places) p
  JOIN every e ON p.up = e.up AND p.level = e.level AND p.lang IS NOT DISTINCT FROM e.lang AND p.i // 8 = e.i // 8
  GROUP BY ALL),
proofs AS (
  SELECT doc_id, leaf, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256
  FROM ways GROUP BY doc_id, leaf),
folded(doc_id, leaf, step, digest) AS (
  SELECT doc_id, leaf, 0, coalesce(tampered, leaf) FROM spans
  UNION ALL
  SELECT f.doc_id, f.leaf, f.step + 1, sha256(before || digest || after)
  FROM folded f JOIN ways w ON f.doc_id = w.doc_id AND f.leaf = w.leaf AND f.step = w.step)
SELECT s.doc_id, s.leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
  f.digest AS folded_root, f.digest = root AS verified
FROM spans s CROSS JOIN root
LEFT JOIN proofs p ON s.doc_id = p.doc_id AND s.leaf = p.leaf
JOIN folded f ON s.doc_id = f.doc_id AND s.leaf = f.leaf AND f.step = depth + upper_depth
""",
    "op4_url_filter": f"""
WITH rules(h, p, v) AS (VALUES {_RULE_ROWS}),
cut AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
urls AS (SELECT DISTINCT host, path FROM cut),
fits AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM urls JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM cut LEFT JOIN fits USING (host, path)
""",
    "op6_near_duplicates": f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
  FROM split),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS p, b.doc_id AS q, count(*) AS common, any_value(a.n) AS n, any_value(b.n) AS m
  FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id),
links AS (SELECT p, q FROM pairs WHERE 100 * common >= 85 * (n + m - common)),
both_ways AS (SELECT p, q FROM links UNION ALL SELECT q, p FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, both_ways.q FROM reach JOIN both_ways ON reach.other = both_ways.p)
SELECT sets.doc_id, len(s) AS n_shingles, least_id AS component_id, sets.doc_id = least_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id) USING (doc_id)
""",
    "op13_prefix_trie": f"""
WITH {_CRC_TABLE.strip()},
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32("conv_id")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc_table),
turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d
  FROM (
    SELECT c.conv_id, 0 AS part, o.i, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.i <= h
    UNION ALL
    SELECT c.conv_id, 1, o.i, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > h)),
whole AS (
  SELECT c.conv_id, coalesce(list([role, text] ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS t
  FROM convs c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, unnest(range(len(t) + 1)) AS depth, t FROM whole),
named AS (SELECT conv_id, depth, t[1:depth] AS node, len(t) = depth AS ends FROM prefixes),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0
      ELSE len(regexp_extract_all(node[depth][2], '[^\x20\x09-\x0D]+')) END AS saved
  FROM named GROUP BY node, depth),
family AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.node[1:n.depth] = n.node) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1])
SELECT a.conv_id, a.depth, any_value(a.parent_conv_id) AS parent_conv_id, any_value(a.n_convs) AS n_convs,
  any_value(a.n_children) AS n_children, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves,
  sum(b.saved)::bigint AS saved_tokens, any_value(a.ends_sha256) AS ends_sha256
FROM family a JOIN family b ON b.node[1:a.depth] = a.node AND b.depth >= a.depth
GROUP BY a.conv_id, a.depth
""",
}
