"""The operators bound to the driver tables with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as _decontaminate
from . import divergence as _divergence
from . import embed_dedup as _embed_dedup
from . import licenses as _licenses
from . import line_dedup as _line_dedup
from . import minhash as _minhash
from . import packing as _packing
from . import prefix_trie as _prefix_trie
from . import quality as _quality
from . import sentencepieces as _sentencepieces
from . import sharding as _sharding
from . import suffix_dedup as _suffix_dedup
from . import toxicity as _toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _toxicity.score_documents(docs, _toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return _decontaminate.digest(found)


@query("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suffix_dedup.digest(table(spark, sf_dir, "documents"))


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _quality.score_documents(docs, _quality.train(docs, table(spark, sf_dir, "labels")))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack(table(spark, sf_dir, "documents"))


@query("op7_sharding", sql="""
WITH s AS (
  SELECT doc_id, CAST(COALESCE(strlen(text), 0) + 16 AS BIGINT) AS size, lower(hex(encode(COALESCE(text, '')))) AS x
  FROM documents),
steps AS (
  SELECT list(c ORDER BY k) AS t FROM (
    SELECT k, list_reduce(list_prepend(k, range(8)), lambda a, i:
      CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM range(256) r(k))),
crc AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(x, '..'),
           lambda h: CAST('0x' || h AS BIGINT))),
           lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295) AS text_crc32
  FROM s, steps),
p AS (
  SELECT *, SUM(size) OVER () AS total,
    SUM(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM crc),
q AS (
  SELECT *, CAST(LEAST(39, ((2 * before + size) * 40) // (2 * total)) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  CAST(ROW_NUMBER() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM q
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _sharding.shard_by_bytes(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op8_line_dedup", sql="""
WITH lines AS (
  SELECT doc_id, unnest(string_split(COALESCE(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(COALESCE(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
marked AS (
  SELECT *, length(key) >= 10 AND doc_id <> MIN(doc_id) OVER (PARTITION BY key) AS gone FROM keyed)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_dedup.digest(table(spark, sf_dir, "documents"))


@query("op9_embedding_near_dedup", sql="""
WITH RECURSIVE
u AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least_id AS (SELECT a, MIN(b) AS m FROM reach GROUP BY a),
counts AS (SELECT a, COUNT(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, COALESCE(n, 0) AS n_links, LEAST(vec_id, COALESCE(m, vec_id)) AS component_id,
  vec_id = LEAST(vec_id, COALESCE(m, vec_id)) AS kept
FROM embeddings LEFT JOIN counts c ON c.a = vec_id LEFT JOIN least_id l ON l.a = vec_id
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op10_license_scan", sql="""
WITH lines AS (
  SELECT doc_id, trim(unnest(string_split(COALESCE(text, ''), chr(10)))) AS line FROM documents),
named AS (
  SELECT doc_id, CASE line
    WHEN 'Licensed under the Apache License, Version 2.0.' THEN 'apache-2.0'
    WHEN 'Licensed under CC BY-NC 4.0.' THEN 'cc-by-nc'
    WHEN 'This work is licensed under the GNU General Public License, version 3.' THEN 'gpl-3.0'
    WHEN 'Released under the MIT License.' THEN 'mit'
    WHEN 'All rights reserved.' THEN 'proprietary' END AS family
  FROM lines)
SELECT doc_id, COUNT(*) AS n_paragraphs, COUNT(family) AS n_license, CAST(0 AS BIGINT) AS n_unknown,
  COALESCE(string_agg(DISTINCT family, ',' ORDER BY family), '') AS families
FROM named GROUP BY doc_id
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _licenses.summary(docs, _licenses.scan(docs, _licenses.train(docs)))


@query("op11_sentencepiece")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _sentencepieces.read_model(f"{TOKENIZERS}/piece_bpe_32k.model")
    return _sentencepieces.digest(table(spark, sf_dir, "documents"), model)


@query("op12_source_divergence", sql=r"""
WITH d AS (
  SELECT COALESCE(lang, '') AS lang, COALESCE(source, '') AS source, row_number() OVER () AS r,
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
w AS (
  SELECT lang, source, r, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING COUNT(DISTINCT r) >= 10),
sizes AS (SELECT lang, COUNT(*) AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, term, COUNT(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT lang, source, COALESCE(SUM(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN n USING (lang, source) GROUP BY lang, source),
f AS (
  SELECT lang, source, term, COALESCE(n, 0)::HUGEINT AS n,
    1 + (1000000000::HUGEINT * (COALESCE(n, 0) + 2)) // (total + 2 * v) AS p
  FROM g JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN n USING (lang, source, term)),
l AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (SUM(n) + 2)) //
    (SUM(SUM(n)) OVER (PARTITION BY lang) + 2 * COUNT(*) OVER (PARTITION BY lang)) AS q
  FROM f GROUP BY lang, term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, SUM(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT f.lang, f.source, 'term', f.term, (((p - q) * (p - q)) // (p + q))::BIGINT
  FROM f JOIN l USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_prefix_trie", sql="""
WITH steps AS (
  SELECT list(c ORDER BY k) AS t FROM (
    SELECT k, list_reduce(list_prepend(k, range(8)), lambda a, i:
      CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM range(256) r(k))),
own AS (
  SELECT conv_id, list({'r': COALESCE(role, ''), 'x': COALESCE(text, '')} ORDER BY turn NULLS FIRST) AS seq
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (
  SELECT conv_id, seq, xor(list_reduce(list_prepend(4294967295, list_transform(
      regexp_extract_all(lower(hex(encode(conv_id::VARCHAR))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295) % 9 AS h
  FROM own, steps),
built AS (
  SELECT c.conv_id, list_concat(list_slice(COALESCE(b.seq, []), 1, h), list_slice(c.seq, h + 1, len(c.seq))) AS seq
  FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (
  SELECT conv_id, len(seq) AS n, depth, list_slice(seq, 1, depth) AS p
  FROM (SELECT *, unnest(range(len(seq) + 1)) AS depth FROM built)),
nodes AS (
  SELECT p, depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs,
    sha256(COALESCE(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE strlen(p[depth].x) END AS bytes
  FROM prefixes GROUP BY p, depth),
kids AS (SELECT list_slice(p, 1, depth - 1) AS p, depth - 1 AS depth, COUNT(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT n.*, COALESCE(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (p, depth)),
below AS (
  SELECT list_slice(p, 1, d) AS p, d AS depth, SUM(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    SUM((n_convs - 1) * bytes) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_nodes) GROUP BY 1, 2)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below USING (p, depth)
LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.p = list_slice(n.p, 1, n.depth - 1)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prefix_trie.trie(table(spark, sf_dir, "conversations"))
