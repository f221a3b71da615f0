"""Queries: deduplication and two-source consolidation (E2 chain).

Binding: ``lineitem`` seen as two systems that both record order lines,
split by a natural attribute: open lines (``l_linestatus='O'``) and
fulfilled lines (``'F'``). Each source keeps its newest line per order,
the two are merged with a full outer join on the order key, conflicts are
counted and the newest value survives.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import consolidate as C
from ..sources.tables import load
from .registry import query


def _source(spark, sf, status, ts_name):
    li = load(spark, sf, "lineitem").filter(F.col("l_linestatus") == status)
    src = li.select("l_orderkey", F.col("l_returnflag").alias("flag"),
                    F.col("l_partkey").alias("part"), F.col("l_shipdate").alias(ts_name))
    return C.dedup_keep_latest(src, ["l_orderkey"], ts_name, tiebreak=["flag", "part"])


def merged_sources(spark, sf):
    x = _source(spark, sf, "O", "open_ts")
    y = _source(spark, sf, "F", "done_ts")
    return C.full_outer_merge(x, y, "l_orderkey")


_SQL_SOURCES = """
WITH x AS (
  SELECT l_orderkey, flag, part, open_ts FROM (
    SELECT l_orderkey, l_returnflag AS flag, l_partkey AS part, l_shipdate AS open_ts,
           row_number() OVER (PARTITION BY l_orderkey
                              ORDER BY l_shipdate DESC, l_returnflag DESC, l_partkey DESC) AS rn
    FROM lineitem WHERE l_linestatus = 'O') WHERE rn = 1),
y AS (
  SELECT l_orderkey, flag, part, done_ts FROM (
    SELECT l_orderkey, l_returnflag AS flag, l_partkey AS part, l_shipdate AS done_ts,
           row_number() OVER (PARTITION BY l_orderkey
                              ORDER BY l_shipdate DESC, l_returnflag DESC, l_partkey DESC) AS rn
    FROM lineitem WHERE l_linestatus = 'F') WHERE rn = 1),
m AS (
  SELECT coalesce(x.l_orderkey, y.l_orderkey) AS l_orderkey,
         x.flag AS flag_x, x.part AS part_x, x.open_ts,
         y.flag AS flag_y, y.part AS part_y, y.done_ts
  FROM x FULL OUTER JOIN y ON x.l_orderkey = y.l_orderkey)
"""


@query("dedup_keep_latest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC) AS rn
      FROM lineitem) WHERE rn = 1
""")
def q_dedup_keep_latest(spark, sf):
    return C.dedup_keep_latest(load(spark, sf, "lineitem"),
                               ["l_orderkey", "l_linenumber"], "l_shipdate")


@query("join_full_outer", _SQL_SOURCES + "SELECT * FROM m")
def q_join_full_outer(spark, sf):
    return merged_sources(spark, sf)


@query("conflict_count", _SQL_SOURCES + """
SELECT 'flag' AS attribute,
       count_if(flag_x IS NOT NULL AND flag_y IS NOT NULL AND flag_x <> flag_y) AS n_conflicts FROM m
UNION ALL
SELECT 'part', count_if(part_x IS NOT NULL AND part_y IS NOT NULL AND part_x <> part_y) FROM m
""")
def q_conflict_count(spark, sf):
    return C.conflict_counts(merged_sources(spark, sf), ["flag", "part"])


@query("conflict_rows", _SQL_SOURCES + """
SELECT * FROM m WHERE part_x IS NOT NULL AND part_y IS NOT NULL
""")
def q_conflict_rows(spark, sf):
    return C.conflict_rows(merged_sources(spark, sf), "part")


@query("survivorship", _SQL_SOURCES + """
SELECT l_orderkey, open_ts, done_ts,
       coalesce(CASE WHEN coalesce(open_ts > done_ts, false) THEN flag_x ELSE flag_y END,
                flag_x, flag_y) AS flag_final,
       coalesce(CASE WHEN coalesce(open_ts > done_ts, false) THEN part_x ELSE part_y END,
                part_x, part_y) AS part_final
FROM m
""")
def q_survivorship(spark, sf):
    return C.survivorship(merged_sources(spark, sf), ["flag", "part"], "open_ts", "done_ts")
