"""Queries: sources and sinks (2.1), semi/anti lookups and derived-column
concatenation (2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import consolidate as C
from ..operators import text as TX
from ..sources import files as IO
from ..sources.tables import load
from .registry import query

_CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("src_csv", "SELECT * FROM customer")
def q_src_csv(spark, sf):
    """Round trip: the customer table written as header CSV and read back
    with its declared schema."""
    path = IO.write_csv(load(spark, sf, "customer"), IO.scratch_path(spark, "customer-csv"))
    return IO.read_csv(spark, path, _CUSTOMER_SCHEMA)


@query("src_csv_inferred", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
       o_orderpriority, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS gaps,
       o_orderkey % 2 = 0 AS even
FROM orders
""")
def q_src_csv_inferred(spark, sf):
    """Round trip without a schema: integers, numbers, text, integers with
    gaps (numbers) and booleans are told apart."""
    o = load(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority",
        F.when(F.col("o_orderkey") % 9 == 0, F.lit("NA")).otherwise(F.col("o_custkey").cast("string")).alias("gaps"),
        (F.col("o_orderkey") % 2 == 0).alias("even"))
    return IO.read_csv_inferred(spark, IO.write_csv(o, IO.scratch_path(spark, "orders-csv")))


@query("src_csv_text", "SELECT doc_id, text, lang FROM documents")
def q_src_csv_text(spark, sf):
    """Round trip of texts with line breaks, quotes and commas."""
    path = IO.write_csv(load(spark, sf, "documents").select("doc_id", "text", "lang"),
                        IO.scratch_path(spark, "documents-csv"))
    return IO.read_csv(spark, path, "doc_id long, text string, lang string")


@query("sink_csv", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS prediction FROM orders
""")
def q_sink_csv(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("prediction"))
    path = IO.write_csv(o, IO.scratch_path(spark, "predictions"))
    return IO.read_csv(spark, path, "o_orderkey long, prediction int")


@query("sink_positional_csv", """
SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS Id, o_orderstatus AS Predicted
FROM orders
""")
def q_sink_positional_csv(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    path = IO.write_positional_csv(o, ["o_orderkey"], "o_orderstatus", IO.scratch_path(spark, "positional"))
    return IO.read_csv(spark, path, "Id long, Predicted string")


@query("src_json_list", "SELECT text || '.' AS name FROM conversations")
def q_src_json_list(spark, sf):
    conv = load(spark, sf, "conversations")
    path = IO.write_json_list(conv, ["conv_id"], "turn", "text", IO.scratch_path(spark, "json-list"))
    return IO.read_json_list(spark, path, ".")


@query("src_json_soa", "SELECT text AS X, n_chars AS Y FROM documents")
def q_src_json_soa(spark, sf):
    path = IO.write_json_soa(load(spark, sf, "documents"), ["lang"], "doc_id", "text", "n_chars",
                             IO.scratch_path(spark, "json-soa"))
    return IO.read_json_soa(spark, path, "string", "long")


@query("json_field", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def q_json_field(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", IO.json_field(F.col("props"), "k", "int").alias("k"))


_VOCAB_SQL = """
WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS token FROM documents),
v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS token FROM benchmark)
"""


@query("lookup_semi", _VOCAB_SQL.replace("\\\\", "\\") + """
SELECT token, count(*) AS n FROM t WHERE token IN (SELECT token FROM v) GROUP BY token
""")
def q_lookup_semi(spark, sf):
    """Document tokens kept only when they occur in the benchmark vocabulary."""
    from ..functions.text import vectorizer_tokens
    docs = load(spark, sf, "documents").select(F.explode(vectorizer_tokens(F.col("text"))).alias("token"))
    vocab = load(spark, sf, "benchmark").select(F.explode(vectorizer_tokens(F.col("text"))).alias("token"))
    # counted first: a common token is one row when it meets the vocabulary
    return C.lookup_semi(TX.token_counts(docs), vocab, "token")


@query("stop_anti", _VOCAB_SQL.replace("\\\\", "\\") + """
SELECT token, count(*) AS n FROM t WHERE token NOT IN (SELECT token FROM v) GROUP BY token
""")
def q_stop_anti(spark, sf):
    """Document tokens with the benchmark vocabulary removed."""
    from ..functions.text import vectorizer_tokens
    docs = load(spark, sf, "documents").select(F.explode(vectorizer_tokens(F.col("text"))).alias("token"))
    vocab = load(spark, sf, "benchmark").select(F.explode(vectorizer_tokens(F.col("text"))).alias("token"))
    return C.stop_anti(TX.token_counts(docs), vocab, "token")


@query("concat_columns", """
SELECT c_custkey, c_acctbal,
       CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS c_mktsegment_BUILDING,
       CAST(c_mktsegment = 'FURNITURE' AS DOUBLE) AS c_mktsegment_FURNITURE,
       CAST(c_mktsegment = 'HOUSEHOLD' AS DOUBLE) AS c_mktsegment_HOUSEHOLD,
       CAST(c_mktsegment = 'MACHINERY' AS DOUBLE) AS c_mktsegment_MACHINERY
FROM customer
""")
def q_concat_columns(spark, sf):
    """Encoded block placed next to the remaining columns: derived columns
    are added to the same rows, so no positional join is needed."""
    from ..operators.encoding import categories, onehot_drop_first
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return onehot_drop_first(c, "c_mktsegment", categories(c, "c_mktsegment"))
