"""Queries: binning, normalisation, encoding (2.5) and ordering, sampling,
splits (2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import binning as B
from ..operators import encoding as E
from ..operators import ordering as O
from ..operators import sampling as SP
from ..operators import scaling as SC
from ..sources.tables import load
from .common import rounded
from .registry import query

_PART_RANGE = """
WITH s AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi,
                  (max(p_retailprice) - min(p_retailprice)) / {k} AS w FROM part),
t AS (SELECT p_partkey, p_retailprice,
             CAST(least(coalesce(greatest(ceil((p_retailprice - lo) / w) - 1, 0), 0), {km1}) AS INTEGER) AS bin
      FROM part, s)
"""


def _part(spark, sf):
    return load(spark, sf, "part").select("p_partkey", "p_retailprice")


@query("bin_boundaries", """
WITH s AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 4 AS w
           FROM lineitem)
SELECT CAST(i AS INTEGER) AS i, round(lo + i * w, 6) AS boundary FROM range(1, 4) r(i), s
""")
def q_bin_boundaries(spark, sf):
    return rounded(B.bin_boundaries(load(spark, sf, "lineitem"), "l_extendedprice", 4))


@query("bin_equal_width", _PART_RANGE.format(k=4, km1=3) + "SELECT * FROM t")
def q_bin_equal_width(spark, sf):
    return B.equal_width_bins(_part(spark, sf), "p_retailprice", 4)


@query("bin_equal_width_cursor", _PART_RANGE.format(k=4, km1=3) + """
, r AS (SELECT p_retailprice, bin, row_number() OVER (ORDER BY p_retailprice) - 1 AS i FROM t)
SELECT p_retailprice,
       CAST(least(bin, i + min(bin - i) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING)) AS INTEGER) AS bin
FROM r
""")
def q_bin_equal_width_cursor(spark, sf):
    out = B.equal_width_bins(_part(spark, sf), "p_retailprice", 4, mode="cursor")
    return out.select("p_retailprice", "bin")


@query("smooth_by_mean", _PART_RANGE.format(k=4, km1=3) + """
SELECT p_partkey, p_retailprice, bin, round(avg(p_retailprice) OVER (PARTITION BY bin), 6) AS smoothed
FROM t
""")
def q_smooth_by_mean(spark, sf):
    binned = B.equal_width_bins(_part(spark, sf), "p_retailprice", 4)
    return B.smooth_by_mean(binned, "p_retailprice")


@query("smooth_width_boundary", _PART_RANGE.format(k=4, km1=3) + """
SELECT p_partkey, p_retailprice, bin,
       CASE WHEN abs(p_retailprice - (lo + bin * w)) <= abs(p_retailprice - (lo + bin * w + w))
            THEN lo + bin * w ELSE lo + bin * w + w END AS smoothed
FROM t, s
""")
def q_smooth_width_boundary(spark, sf):
    binned = B.equal_width_bins(_part(spark, sf), "p_retailprice", 4)
    return B.smooth_width_boundary(binned, "p_retailprice", 4)


_DEPTH = """
WITH r AS (SELECT p_retailprice, row_number() OVER (ORDER BY p_retailprice) AS rn FROM part),
t AS (SELECT p_retailprice,
             CAST(floor((rn - 1) / greatest(floor((SELECT count(*) FROM part) / 4), 1)) AS INTEGER) AS bin
      FROM r)
"""


@query("bin_equal_depth", _DEPTH + "SELECT * FROM t")
def q_bin_equal_depth(spark, sf):
    return B.equal_depth_bins(_part(spark, sf).select("p_retailprice"), "p_retailprice", 4)


@query("smooth_depth_boundary", _DEPTH + """
SELECT p_retailprice, bin,
       CASE WHEN abs(p_retailprice - min(p_retailprice) OVER (PARTITION BY bin))
                 <= abs(p_retailprice - max(p_retailprice) OVER (PARTITION BY bin))
            THEN min(p_retailprice) OVER (PARTITION BY bin)
            ELSE max(p_retailprice) OVER (PARTITION BY bin) END AS smoothed
FROM t
""")
def q_smooth_depth_boundary(spark, sf):
    binned = B.equal_depth_bins(_part(spark, sf).select("p_retailprice"), "p_retailprice", 4)
    return B.smooth_depth_boundary(binned, "p_retailprice")


@query("norm_minmax", """
SELECT p_partkey, (p_retailprice - (SELECT min(p_retailprice) FROM part))
       / ((SELECT max(p_retailprice) FROM part) - (SELECT min(p_retailprice) FROM part)) AS p_retailprice
FROM part
""")
def q_norm_minmax(spark, sf):
    return SC.minmax(_part(spark, sf), ["p_retailprice"])


@query("norm_zscore_pop", """
SELECT p_partkey, round((p_retailprice - (SELECT avg(p_retailprice) FROM part))
       / (SELECT stddev_pop(p_retailprice) FROM part), 6) AS p_retailprice FROM part
""")
def q_norm_zscore_pop(spark, sf):
    return rounded(SC.zscore(_part(spark, sf), ["p_retailprice"], ddof=0))


@query("norm_zscore_sample", """
SELECT p_partkey, round((p_retailprice - (SELECT avg(p_retailprice) FROM part))
       / (SELECT stddev_samp(p_retailprice) FROM part), 6) AS p_retailprice FROM part
""")
def q_norm_zscore_sample(spark, sf):
    return rounded(SC.zscore(_part(spark, sf), ["p_retailprice"], ddof=1))


@query("norm_robust", """
WITH m AS (SELECT quantile_cont(p_retailprice, 0.5) AS med FROM part),
d AS (SELECT quantile_cont(abs(p_retailprice - med), 0.5) AS mad FROM part, m)
SELECT p_partkey, round((p_retailprice - med) / mad, 6) AS p_retailprice FROM part, m, d
""")
def q_norm_robust(spark, sf):
    return rounded(SC.robust(_part(spark, sf), ["p_retailprice"]))


@query("standard_scaler", """
WITH f AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
                  avg(l_extendedprice) AS me, stddev_pop(l_extendedprice) AS se
           FROM lineitem WHERE l_linestatus = 'F')
SELECT l_orderkey, l_linenumber,
       round((l_quantity - mq) / CASE WHEN sq = 0 THEN 1.0 ELSE sq END, 6) AS l_quantity,
       round((l_extendedprice - me) / CASE WHEN se = 0 THEN 1.0 ELSE se END, 6) AS l_extendedprice
FROM lineitem, f WHERE l_linestatus = 'O'
""")
def q_standard_scaler(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus",
                                            "l_quantity", "l_extendedprice")
    cols = ["l_quantity", "l_extendedprice"]
    fit = SC.standard_fit(li.filter(F.col("l_linestatus") == "F"), cols)
    test = li.filter(F.col("l_linestatus") == "O").drop("l_linestatus")
    return rounded(SC.standard_transform(test, fit, cols))


_SEL_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("scale_selected", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(CASE WHEN (SELECT (max({c}) - min({c})) > 2.5 * stddev_samp({c}) FROM lineitem) "
    f"THEN ({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 "
    f"ELSE stddev_pop({c}) END FROM lineitem) ELSE {c} END, 6) AS {c}" for c in _SEL_COLS)
    + " FROM lineitem")
def q_scale_selected(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_SEL_COLS)
    return rounded(SC.scale_selected(li, _SEL_COLS))


@query("onehot_drop_first", """
SELECT c_custkey,
       CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS c_mktsegment_BUILDING,
       CAST(c_mktsegment = 'FURNITURE' AS DOUBLE) AS c_mktsegment_FURNITURE,
       CAST(c_mktsegment = 'HOUSEHOLD' AS DOUBLE) AS c_mktsegment_HOUSEHOLD,
       CAST(c_mktsegment = 'MACHINERY' AS DOUBLE) AS c_mktsegment_MACHINERY
FROM customer
""")
def q_onehot_drop_first(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return E.onehot_drop_first(c, "c_mktsegment", E.categories(c, "c_mktsegment"))


@query("onehot_sparse", """
WITH i AS (SELECT c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS k FROM (
             SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL))
SELECT c_custkey, c_mktsegment, CASE WHEN k > 0 THEN CAST(k - 1 AS INTEGER) END AS hot,
       CAST((SELECT count(*) - 1 FROM i) AS BIGINT) AS hot_size
FROM customer LEFT JOIN i USING (c_mktsegment)
""")
def q_onehot_sparse(spark, sf):
    """Any number of categories: the place of the 1 and the width of the code."""
    return E.onehot_sparse(load(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", out="hot")


@query("label_encode", """
SELECT o_orderkey, o_orderstatus,
       CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS o_orderstatus_index
FROM orders
""")
def q_label_encode(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return E.label_encode(o, "o_orderstatus")


@query("label_decode", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS o_orderstatus_index,
       o_orderstatus AS decoded
FROM orders
""")
def q_label_decode(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    idx = E.label_index(o, "o_orderstatus")
    enc = E.label_encode(o, "o_orderstatus", index=idx).drop("o_orderstatus")
    return E.label_decode(enc, "o_orderstatus_index", idx, "decoded")


# ------------------------------------------------------------ 2.6

@query("sort_multi", """
SELECT o_orderkey, o_custkey, o_orderdate,
       row_number() OVER (ORDER BY o_custkey ASC, o_orderdate DESC, o_orderkey ASC) AS position FROM orders
""")
def q_sort_multi(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return O.sort_multi(o, ["o_custkey", "o_orderdate", "o_orderkey"], [True, False, True], position="position")


@query("head_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def q_head_n(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.head_n(o, 10, ["o_orderkey"])


@query("tail_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 10")
def q_tail_n(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.tail_n(o, 10, ["o_orderkey"])


@query("row_range", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 100")
def q_row_range(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.row_range(o, 100, 120, ["o_orderkey"])


_HASH = "((o_orderkey % 1000003) * 2654435761) % 1000003"


@query("sample_frac", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_HASH} < 0.3 * 1000003")
def q_sample_frac(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return SP.sample_frac(o, "o_orderkey", 0.3)


@query("sample_n", f"SELECT o_orderkey, o_custkey FROM orders ORDER BY {_HASH}, o_orderkey LIMIT 1000")
def q_sample_n(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return SP.sample_n(o, "o_orderkey", 1000)


@query("split_random", f"""
SELECT o_orderkey, CASE WHEN {_HASH} < 0.8 * 1000003 THEN 'train' ELSE 'test' END AS split FROM orders
""")
def q_split_random(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    return SP.split_hash(o, "o_orderkey", (0.8, 0.2), ("train", "test"))


@query("split_positional", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n
           FROM orders)
SELECT o_orderkey, CASE WHEN rn <= floor(n * 0.7) THEN 'train'
                        WHEN rn <= floor(n * (CAST(0.7 AS DOUBLE) + CAST(0.1 AS DOUBLE))) THEN 'val' ELSE 'test' END AS split
FROM r
""")
def q_split_positional(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    return SP.split_positional(o, ["o_orderkey"], (0.7, 0.1, 0.2))


@query("split_stratified", f"""
WITH r AS (SELECT o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HASH}, o_orderkey) AS rn,
                  count(*) OVER (PARTITION BY o_orderstatus) AS ny FROM orders)
SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= round(ny * 0.1) THEN 'test' ELSE 'train' END AS split
FROM r
""")
def q_split_stratified(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return SP.split_stratified(o, "o_orderstatus", "o_orderkey", 0.1)


def _bootstrap_sql():
    cdf = SP.poisson1_cdf()
    cases = " ".join(f"WHEN u < CAST('{c!r}' AS DOUBLE) THEN {j}" for j, c in enumerate(cdf))
    return f"""
WITH r AS (SELECT o_orderkey, o_totalprice,
                  CASE {cases} ELSE {len(cdf)} END AS reps
           FROM (SELECT o_orderkey, o_totalprice,
                        ((((o_orderkey % 1000003) + 7) * {SP.HASH_MULT + 2 * (7 * 40_503 % SP.HASH_MOD)} % 1000003)
                          * 2654435761 + 7) % 1000003 / 1000003.0 AS u
                 FROM orders))
SELECT o_orderkey, o_totalprice, CAST(unnest(range(1, reps + 1)) AS INTEGER) AS _copy FROM r WHERE reps > 0
"""


@query("sample_bootstrap", _bootstrap_sql())
def q_sample_bootstrap(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return SP.bootstrap(o, "o_orderkey", seed=7)
