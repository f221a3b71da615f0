"""Queries: projection, null handling, recoding (2.2) and aggregates,
profiling, data quality (2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import association as A
from ..operators import distribution as D
from ..operators import profile as P
from ..operators import quality as Q
from ..operators import sketches as SK
from ..operators import stats as S
from ..sources.tables import load
from .common import HOLEY_CUSTOMER_SQL, holey_customer, rounded, sig_round, sig_round_sql
from .registry import query

HC = "WITH " + HOLEY_CUSTOMER_SQL
HC_ATTRS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_phone"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ------------------------------------------------------------ flagship

@query("column_profile", """
WITH s AS (
  SELECT 'l_quantity' AS "column", count(*) AS n_rows, count(l_quantity) AS n_non_null,
         count(DISTINCT l_quantity) AS n_distinct, avg(l_quantity) AS mean, stddev_samp(l_quantity) AS std,
         min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS q25, quantile_cont(l_quantity, 0.5) AS q50,
         quantile_cont(l_quantity, 0.75) AS q75, max(l_quantity) AS max FROM lineitem
  UNION ALL
  SELECT 'l_extendedprice', count(*), count(l_extendedprice), count(DISTINCT l_extendedprice),
         avg(l_extendedprice), stddev_samp(l_extendedprice), min(l_extendedprice),
         quantile_cont(l_extendedprice, 0.25), quantile_cont(l_extendedprice, 0.5),
         quantile_cont(l_extendedprice, 0.75), max(l_extendedprice) FROM lineitem
  UNION ALL
  SELECT 'l_discount', count(*), count(l_discount), count(DISTINCT l_discount), avg(l_discount),
         stddev_samp(l_discount), min(l_discount), quantile_cont(l_discount, 0.25),
         quantile_cont(l_discount, 0.5), quantile_cont(l_discount, 0.75), max(l_discount) FROM lineitem
  UNION ALL
  SELECT 'l_tax', count(*), count(l_tax), count(DISTINCT l_tax), avg(l_tax), stddev_samp(l_tax),
         min(l_tax), quantile_cont(l_tax, 0.25), quantile_cont(l_tax, 0.5),
         quantile_cont(l_tax, 0.75), max(l_tax) FROM lineitem)
SELECT "column", n_rows, n_rows - n_non_null AS n_missing,
       round(100.0 * n_non_null / n_rows, 6) AS completeness, n_distinct,
       {mean} AS mean, {std} AS std, round(min, 6) AS min, round(q25, 6) AS q25,
       round(q50, 6) AS q50, round(q75, 6) AS q75, round(max, 6) AS max
FROM s
""".format(mean=sig_round_sql("mean"), std=sig_round_sql("std")))
def q_column_profile(spark, sf):
    out = P.column_profile(load(spark, sf, "lineitem"), LI_NUM)
    out = out.withColumn("mean", sig_round(F.col("mean"))).withColumn("std", sig_round(F.col("std")))
    return rounded(out, skip=("mean", "std"))


# ------------------------------------------------------------ 2.2

@query("select_cols", "SELECT l_orderkey, l_quantity FROM lineitem")
def q_select_cols(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_quantity")


@query("schema_profile", """
WITH cnt AS (SELECT count(*) AS n_rows, count(c_custkey) AS c_custkey, count(c_name) AS c_name,
                    count(c_nationkey) AS c_nationkey, count(c_acctbal) AS c_acctbal,
                    count(c_mktsegment) AS c_mktsegment FROM customer),
u AS (UNPIVOT (SELECT * EXCLUDE (n_rows) FROM cnt) ON COLUMNS(*) INTO NAME col VALUE n_non_null)
SELECT CAST(i.ordinal_position - 1 AS INTEGER) AS position, i.column_name AS "column",
       CASE i.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                        WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                        ELSE lower(i.data_type) END AS dtype,
       (SELECT n_rows FROM cnt) AS n_rows, u.n_non_null, CAST(5 AS INTEGER) AS n_cols,
       (SELECT n_rows FROM cnt) * 5 AS size
FROM information_schema.columns i JOIN u ON u.col = i.column_name
WHERE i.table_name = 'customer'
""")
def q_schema_profile(spark, sf):
    return P.schema_profile(load(spark, sf, "customer"))


@query("select_by_dtype", "SELECT c_name, c_mktsegment FROM customer")
def q_select_by_dtype(spark, sf):
    return P.select_by_dtype(load(spark, sf, "customer"), "string")


@query("drop_cols", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_returnflag, l_linestatus, l_shipdate FROM lineitem
""")
def q_drop_cols(spark, sf):
    # a missing name is ignored, as pandas drop(errors='ignore')
    return load(spark, sf, "lineitem").drop("l_tax", "l_discount", "l_comment")


@query("rows_any_null", HC + """
SELECT * FROM hc WHERE c_name IS NULL OR c_nationkey IS NULL OR c_acctbal IS NULL
   OR c_mktsegment IS NULL
""")
def q_rows_any_null(spark, sf):
    return P.rows_any_null(holey_customer(spark, sf), HC_ATTRS[:-1])


@query("rows_all_null", HC + """
SELECT * FROM hc WHERE c_name IS NULL AND c_nationkey IS NULL AND c_acctbal IS NULL
   AND c_mktsegment IS NULL AND c_phone IS NULL
""")
def q_rows_all_null(spark, sf):
    return P.rows_all_null(holey_customer(spark, sf), HC_ATTRS)


@query("null_mask", HC + """
SELECT c_custkey, c_name IS NULL AS c_name, c_nationkey IS NULL AS c_nationkey,
       c_acctbal IS NULL AS c_acctbal, c_mktsegment IS NULL AS c_mktsegment,
       c_phone IS NULL AS c_phone FROM hc
""")
def q_null_mask(spark, sf):
    return P.null_mask(holey_customer(spark, sf), keep=["c_custkey"])


@query("dropna_any", HC + """
SELECT * FROM hc WHERE c_name IS NOT NULL AND c_nationkey IS NOT NULL
   AND c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL
""")
def q_dropna_any(spark, sf):
    return P.dropna(holey_customer(spark, sf), "any", subset=HC_ATTRS[:-1])


@query("dropna_all", HC + """
SELECT * FROM hc WHERE NOT (c_name IS NULL AND c_nationkey IS NULL AND c_acctbal IS NULL
   AND c_mktsegment IS NULL AND c_phone IS NULL)
""")
def q_dropna_all(spark, sf):
    return P.dropna(holey_customer(spark, sf), "all", subset=HC_ATTRS)


@query("dropna_thresh", HC + """
SELECT * FROM hc WHERE (CAST(c_name IS NOT NULL AS INT) + CAST(c_nationkey IS NOT NULL AS INT)
   + CAST(c_acctbal IS NOT NULL AS INT) + CAST(c_mktsegment IS NOT NULL AS INT)
   + CAST(c_phone IS NOT NULL AS INT)) >= 3
""")
def q_dropna_thresh(spark, sf):
    return P.dropna(holey_customer(spark, sf), thresh=3, subset=HC_ATTRS)


@query("dropna_cols", HC + "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM hc")
def q_dropna_cols(spark, sf):
    return P.dropna_columns(holey_customer(spark, sf))


@query("fill_const", HC + """
SELECT c_custkey, c_name, coalesce(c_nationkey, 0) AS c_nationkey,
       coalesce(c_acctbal, 0) AS c_acctbal, c_mktsegment, c_phone FROM hc
""")
def q_fill_const(spark, sf):
    return P.fill_const(holey_customer(spark, sf), 0)


@query("fill_mean", HC + """
SELECT c_custkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM hc)), 6) AS c_acctbal FROM hc
""")
def q_fill_mean(spark, sf):
    df = holey_customer(spark, sf).select("c_custkey", "c_acctbal")
    return rounded(P.fill_mean(df, ["c_acctbal"]))


@query("fill_median", HC + """
SELECT c_custkey, round(coalesce(c_acctbal, (SELECT quantile_cont(c_acctbal, 0.5) FROM hc)), 6)
       AS c_acctbal FROM hc
""")
def q_fill_median(spark, sf):
    df = holey_customer(spark, sf).select("c_custkey", "c_acctbal")
    return rounded(P.fill_median(df, ["c_acctbal"]))


@query("fill_mode", HC + """
, m AS (SELECT c_mktsegment AS v FROM hc WHERE c_mktsegment IS NOT NULL
        GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)
SELECT c_custkey, coalesce(c_mktsegment, (SELECT v FROM m)) AS c_mktsegment FROM hc
""")
def q_fill_mode(spark, sf):
    df = holey_customer(spark, sf).select("c_custkey", "c_mktsegment")
    return P.fill_mode(df, ["c_mktsegment"])


@query("map_values", """
SELECT o_orderkey, o_orderpriority,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
                            WHEN '3-MEDIUM' THEN 3 END AS priority_code
FROM orders
""")
def q_map_values(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return P.map_values(o, "o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3},
                        out="priority_code")


@query("label_rule", """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, l_quantity,
         CASE WHEN l_quantity >= 40 THEN 1 WHEN l_quantity <= 10 THEN 0 ELSE 2 END AS label
  FROM lineitem) WHERE label <> 2
""")
def q_label_rule(spark, sf):
    from ..functions.text import band_label
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return (li.withColumn("label", band_label(F.col("l_quantity"), lo=10, hi=40))
              .filter(F.col("label") != 2))


@query("cast_cols", """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, TRY_CAST(l_quantity AS INTEGER) AS l_quantity,
       TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag FROM lineitem
""")
def q_cast_cols(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    return P.cast_cols(li, {"l_orderkey": "string", "l_quantity": "int", "l_returnflag": "int"})


@query("parse_dates", """
SELECT event_id, CAST(strptime(split_part(strftime(ts, '%d/%m/%Y') || 't' || strftime(ts, '%H:%M:%S'),
                                          't', 1), '%d/%m/%Y') AS DATE) AS event_date,
       CAST(year(ts) AS INTEGER) AS event_year
FROM events
""")
def q_parse_dates(spark, sf):
    from ..functions.text import parse_day_month_year
    ev = load(spark, sf, "events")
    raw = F.concat(F.date_format("ts", "dd/MM/yyyy"), F.lit("t"), F.date_format("ts", "HH:mm:ss"))
    d = parse_day_month_year(raw)
    return ev.select("event_id", d.alias("event_date"), F.year(d).alias("event_year"))


@query("digits_only", "SELECT c_custkey, regexp_replace(c_name, '\\D', '', 'g') AS digits FROM customer")
def q_digits_only(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", F.regexp_replace("c_name", r"\D", "").alias("digits"))


@query("first_digit", """
SELECT c_custkey, c_acctbal, TRY_CAST(substring(CAST(c_acctbal AS VARCHAR), 1, 1) AS INTEGER) AS digit
FROM customer
""")
def q_first_digit(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", "c_acctbal", Q.first_digit(F.col("c_acctbal")).alias("digit"))


@query("unique_values", "SELECT DISTINCT c_mktsegment FROM customer")
def q_unique_values(spark, sf):
    return P.unique_values(load(spark, sf, "customer"), "c_mktsegment")


@query("image_norm_affine", """
SELECT l_orderkey, l_linenumber, (l_discount - 0.5) / 0.5 AS l_discount_n,
       (l_tax - 0.5) / 0.5 AS l_tax_n FROM lineitem
""")
def q_image_norm_affine(spark, sf):
    from ..operators.scaling import affine
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return affine(li, {"l_discount": (0.5, 0.5), "l_tax": (0.5, 0.5)}, suffix="_n").drop(
        "l_discount", "l_tax")


# ------------------------------------------------------------ 2.4

def _per_col_sql(cols, exprs: dict, table="lineitem", digits=6):
    parts = []
    for c in cols:
        sel = ", ".join(f"round({e.format(c=c)}, {digits}) AS {name}" if r else f"{e.format(c=c)} AS {name}"
                        for name, (e, r) in exprs.items())
        parts.append(f"SELECT '{c}' AS \"column\", {sel} FROM {table}")
    return "\nUNION ALL\n".join(parts)


@query("agg_basic", _per_col_sql(LI_NUM, {
    "min": ("CAST(min({c}) AS DOUBLE)", True), "max": ("CAST(max({c}) AS DOUBLE)", True),
    "count": ("count({c})", False), "mean": ("avg({c})", True)}))
def q_agg_basic(spark, sf):
    return rounded(P.basic_stats(load(spark, sf, "lineitem"), LI_NUM))


@query("agg_median", _per_col_sql(LI_NUM, {"median": ("quantile_cont({c}, 0.5)", True)}))
def q_agg_median(spark, sf):
    return rounded(P.median(load(spark, sf, "lineitem"), LI_NUM))


@query("agg_median_approx", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, true AS within_error FROM lineitem" for c in LI_NUM))
def q_agg_median_approx(spark, sf):
    """Medians from sketches of slices, merged: whether their exact rank is
    within the stated error of one half."""
    li = load(spark, sf, "lineitem")
    slices = SK.sketch_columns(li, LI_NUM, by=["l_returnflag"])
    merged = SK.merge_sketches(slices)
    found = SK.approx_quantiles(merged, [0.5]).join(merged.select("column", "n"), "column")
    ranked = S.ranked_values(li, LI_NUM).select("column", F.col("value").alias("v"), F.col("n").alias("c"), "cum")
    below, upto = (F.max(F.when(F.col("v") < F.col("value"), F.col("cum"))), F.max(F.when(F.col("v") <= F.col("value"), F.col("cum"))))
    at = ranked.join(F.broadcast(found), "column").groupBy("column", "n").agg(
        F.coalesce(below, F.lit(0)).alias("lo"), F.coalesce(upto, F.lit(0)).alias("hi"))
    error = SK.rank_error()
    return at.select("column", "n", ((F.col("lo") <= (0.5 + error) * F.col("n")) & (F.col("hi") >= (0.5 - error) * F.col("n"))
                                     ).alias("within_error"))


@query("agg_mode", """
WITH c AS (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity)
SELECT l_quantity FROM c WHERE n = (SELECT max(n) FROM c)
""")
def q_agg_mode(spark, sf):
    return S.mode_values(load(spark, sf, "lineitem"), "l_quantity")


@query("agg_mean_abs_dev", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(avg(abs({c} - (SELECT avg({c}) FROM lineitem))), 6) AS mad "
    f"FROM lineitem" for c in LI_NUM))
def q_agg_mean_abs_dev(spark, sf):
    return rounded(P.mean_abs_dev(load(spark, sf, "lineitem"), LI_NUM))


@query("agg_var_std", _per_col_sql(LI_NUM, {"var": ("var_samp({c})", True),
                                           "std": ("stddev_samp({c})", True)}))
def q_agg_var_std(spark, sf):
    return rounded(P.var_std(load(spark, sf, "lineitem"), LI_NUM))


@query("agg_skew", _per_col_sql(LI_NUM, {"skew": ("skewness({c})", True)}))
def q_agg_skew(spark, sf):
    li = load(spark, sf, "lineitem")
    return rounded(P.multi_agg(li, LI_NUM, {"skew": S.corrected_skewness}))


@query("agg_kurt", _per_col_sql(LI_NUM, {"kurt": ("kurtosis({c})", True)}))
def q_agg_kurt(spark, sf):
    li = load(spark, sf, "lineitem")
    return rounded(P.multi_agg(li, LI_NUM, {"kurt": S.corrected_kurtosis}))


@query("describe_numeric", _per_col_sql(LI_NUM, {
    "count": ("count({c})", False), "mean": ("avg({c})", True), "std": ("stddev_samp({c})", True),
    "min": ("CAST(min({c}) AS DOUBLE)", True), "max": ("CAST(max({c}) AS DOUBLE)", True),
    "q25": ("quantile_cont({c}, 0.25)", True), "q50": ("quantile_cont({c}, 0.5)", True),
    "q75": ("quantile_cont({c}, 0.75)", True)}))
def q_describe_numeric(spark, sf):
    return rounded(P.describe_numeric(load(spark, sf, "lineitem"), LI_NUM))


@query("describe_categorical", """
WITH v AS (
  SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
  UNION ALL
  SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rn FROM v)
SELECT "column", sum(n) AS count, count(*) AS unique,
       max(CASE WHEN rn = 1 THEN value END) AS top, max(CASE WHEN rn = 1 THEN n END) AS freq
FROM r GROUP BY "column"
""")
def q_describe_categorical(spark, sf):
    return P.describe_categorical(load(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


_MISSING_SQL = HC + """
, m AS (UNPIVOT (SELECT count_if(c_custkey IS NULL) AS c_custkey, count_if(c_name IS NULL) AS c_name,
          count_if(c_nationkey IS NULL) AS c_nationkey, count_if(c_acctbal IS NULL) AS c_acctbal,
          count_if(c_mktsegment IS NULL) AS c_mktsegment, count_if(c_phone IS NULL) AS c_phone FROM hc)
        ON COLUMNS(*) INTO NAME "column" VALUE missing)
"""


@query("missing_counts", _MISSING_SQL + "SELECT * FROM m")
def q_missing_counts(spark, sf):
    return P.missing_counts(holey_customer(spark, sf))


@query("missing_counts_positive", _MISSING_SQL + "SELECT * FROM m WHERE missing > 0")
def q_missing_counts_positive(spark, sf):
    return P.missing_counts(holey_customer(spark, sf), only_positive=True)


@query("missing_patterns", HC + """
SELECT CAST(c_name IS NOT NULL AS INTEGER) AS c_name, CAST(c_acctbal IS NOT NULL AS INTEGER) AS c_acctbal,
       CAST(c_mktsegment IS NOT NULL AS INTEGER) AS c_mktsegment, count(*) AS n
FROM hc GROUP BY ALL
""")
def q_missing_patterns(spark, sf):
    return P.missing_patterns(holey_customer(spark, sf), ["c_name", "c_acctbal", "c_mktsegment"])


@query("dq_completeness", HC + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(count({c}) * 100.0 / count(*), 6) AS completeness FROM hc"
    for c in HC_ATTRS))
def q_dq_completeness(spark, sf):
    return rounded(Q.completeness(holey_customer(spark, sf), HC_ATTRS))


@query("dq_validity", HC + """
SELECT 'c_acctbal' AS "column", round(count_if(c_acctbal > 0) * 100.0 / count(c_acctbal), 6) AS validity FROM hc
UNION ALL
SELECT 'c_mktsegment', round(count_if(contains(c_mktsegment, 'U')) * 100.0 / count(c_mktsegment), 6) FROM hc
""")
def q_dq_validity(spark, sf):
    hc = holey_customer(spark, sf)
    return rounded(Q.validity(hc, {"c_acctbal": F.col("c_acctbal") > 0,
                                   "c_mktsegment": F.col("c_mktsegment").contains("U")}))


@query("dq_uniqueness", HC + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(count(DISTINCT {c}) * 100.0 / count(*), 6) AS uniqueness FROM hc"
    for c in ["c_name", "c_nationkey", "c_mktsegment"]))
def q_dq_uniqueness(spark, sf):
    return rounded(Q.uniqueness(holey_customer(spark, sf), ["c_name", "c_nationkey", "c_mktsegment"]))


@query("dq_uniqueness_nonblank", HC + """
SELECT 'c_mktsegment' AS "column", count(DISTINCT c_mktsegment) AS n_distinct, count(*) AS n_non_blank,
       round(count(DISTINCT c_mktsegment) * 100.0 / count(*), 6) AS uniqueness
FROM hc WHERE c_mktsegment IS NOT NULL AND c_mktsegment <> ''
""")
def q_dq_uniqueness_nonblank(spark, sf):
    return rounded(Q.uniqueness_nonblank(holey_customer(spark, sf), "c_mktsegment"))


def _age_years(later, earlier):
    """Whole years between two timestamps (anniversary rule)."""
    before = ((F.month(later) < F.month(earlier))
              | ((F.month(later) == F.month(earlier)) & (F.dayofmonth(later) < F.dayofmonth(earlier))))
    return F.year(later) - F.year(earlier) - before.cast("int")


@query("dq_consistency", """
WITH j AS (
  SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE
           year(l_shipdate) - year(o_orderdate)
           - CAST(month(l_shipdate) < month(o_orderdate)
                  OR (month(l_shipdate) = month(o_orderdate) AND day(l_shipdate) < day(o_orderdate))
                  AS INTEGER) END AS recorded,
         year(l_shipdate) - year(o_orderdate) AS expected
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT count(*) AS n_rows, sum(CAST(coalesce(recorded = expected, false) AS INTEGER)) AS n_consistent,
       round(avg(CAST(coalesce(recorded = expected, false) AS INTEGER)) * 100, 6) AS consistency_rate
FROM j
""")
def q_dq_consistency(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    recorded = F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).otherwise(
        _age_years(F.col("l_shipdate"), F.col("o_orderdate")))
    expected = F.year("l_shipdate") - F.year("o_orderdate")
    out = Q.consistency_rate(j, recorded, expected)
    return rounded(out.withColumn("n_consistent", F.col("n_consistent").cast("long")))


@query("value_distribution", """
SELECT o_orderpriority, count(*) AS n, count(*) / (SELECT count(o_orderpriority) FROM orders) AS share,
       CAST(round(count(*) / (SELECT count(o_orderpriority) FROM orders) * 100, 1) AS VARCHAR) || '%'
       AS percent
FROM orders GROUP BY o_orderpriority
""")
def q_value_distribution(spark, sf):
    return P.value_distribution(load(spark, sf, "orders"), "o_orderpriority", as_percent_string=True)


@query("benford_test", """
WITH d AS (
  SELECT 'l_extendedprice' AS "column",
         TRY_CAST(substring(CAST(l_extendedprice AS VARCHAR), 1, 1) AS INTEGER) AS digit FROM lineitem
  UNION ALL
  SELECT 'l_quantity', TRY_CAST(substring(CAST(l_quantity AS VARCHAR), 1, 1) AS INTEGER) FROM lineitem),
c AS (SELECT "column", digit, count(*) AS n FROM d WHERE digit IS NOT NULL GROUP BY ALL),
o AS (SELECT "column", digit, n * 100.0 / sum(n) OVER (PARTITION BY "column") AS observed FROM c),
g AS (SELECT col AS "column", CAST(dg AS INTEGER) AS digit, log10(1 + 1 / dg) * 100 AS expected
      FROM (VALUES ('l_extendedprice'), ('l_quantity')) t(col), range(1, 10) r(dg)),
j AS (SELECT g."column", g.digit, g.expected, coalesce(o.observed, 0.0) AS observed
      FROM g LEFT JOIN o ON g."column" = o."column" AND g.digit = o.digit),
l AS (SELECT "column", sum(abs(observed - expected)) AS l1_distance FROM j GROUP BY "column")
SELECT j."column", j.digit, round(j.expected, 6) AS expected, round(j.observed, 6) AS observed,
       round(l.l1_distance, 6) AS l1_distance, l.l1_distance < 15 AS follows_benford
FROM j JOIN l ON j."column" = l."column"
""")
def q_benford_test(spark, sf):
    out = Q.benford_test(load(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])
    return rounded(out.select("column", "digit", "expected", "observed", "l1_distance",
                              "follows_benford"))


@query("crosstab", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL
""")
def q_crosstab(spark, sf):
    return A.crosstab(load(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("crosstab_wide", "SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{v}') AS \"{v}\"" for v in _PRIORITIES)
    + " FROM orders GROUP BY o_orderstatus")
def q_crosstab_wide(spark, sf):
    """Wide contingency table: one column per named priority."""
    return A.crosstab_wide(load(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", _PRIORITIES)


_CHI_SQL = """
WITH ct AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {t} GROUP BY ALL),
r AS (SELECT a, sum(n) AS r FROM ct GROUP BY a), c AS (SELECT b, sum(n) AS c FROM ct GROUP BY b),
tot AS (SELECT sum(n) AS n, (SELECT count(*) FROM r) AS nr, (SELECT count(*) FROM c) AS nc FROM ct),
grid AS (SELECT r.a, c.b, r.r, c.c, coalesce(ct.n, 0) AS n FROM r CROSS JOIN c
         LEFT JOIN ct ON ct.a = r.a AND ct.b = c.b),
e AS (SELECT n, r * c / (SELECT n FROM tot) AS e FROM grid),
stat AS (SELECT CASE WHEN (SELECT nr FROM tot) = 2 AND (SELECT nc FROM tot) = 2
                THEN sum(pow(abs(n - e) - least(0.5, abs(n - e)), 2) / e)
                ELSE sum(pow(n - e, 2) / e) END AS chi2 FROM e)
"""


def _chi_sql(a, b, t, final):
    return _CHI_SQL.format(a=a, b=b, t=t) + final


_CHI_FINAL = """
SELECT round(chi2, 6) AS chi2, CAST((nr - 1) * (nc - 1) AS BIGINT) AS dof, n, nr AS n_rows, nc AS n_cols
FROM stat, tot
"""


@query("chi_square", _chi_sql("o_orderstatus", "o_orderpriority", "orders", _CHI_FINAL))
def q_chi_square(spark, sf):
    return rounded(A.chi_square(load(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"))


def _big_qty(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_linestatus", (F.col("l_quantity") > 25).alias("big_qty"))


@query("chi_square_2x2", _chi_sql("l_linestatus", "l_quantity > 25", "lineitem", _CHI_FINAL))
def q_chi_square_2x2(spark, sf):
    return rounded(A.chi_square(_big_qty(spark, sf), "l_linestatus", "big_qty"))


@query("cramers_v", _chi_sql("o_orderstatus", "o_orderpriority", "orders", """
SELECT round(chi2, 6) AS chi2, n, round(sqrt(chi2 / (n * (least(nr, nc) - 1))), 6) AS cramers_v
FROM stat, tot
"""))
def q_cramers_v(spark, sf):
    return rounded(A.cramers_v(load(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"))


@query("corr_pair", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem")
def q_corr_pair(spark, sf):
    return rounded(A.corr_pair(load(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


def _corr_matrix_sql(cols, table="lineitem"):
    parts = []
    for a in cols:
        for b in cols:
            e = "max(1.0)" if a == b else f"corr({a}, {b})"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round({e}, 6) AS corr FROM {table}")
    return "\nUNION ALL\n".join(parts)


@query("corr_matrix", _corr_matrix_sql(LI_NUM))
def q_corr_matrix(spark, sf):
    return rounded(A.corr_matrix(load(spark, sf, "lineitem"), LI_NUM))


@query("corr_drop_candidates", """
WITH li AS (SELECT l_quantity, l_extendedprice, l_extendedprice * (1 - l_discount) AS l_netprice,
                   l_discount, l_tax FROM lineitem),
p AS (SELECT 'l_extendedprice' AS col, abs(corr(l_quantity, l_extendedprice)) AS c FROM li
      UNION ALL SELECT 'l_netprice', abs(corr(l_quantity, l_netprice)) FROM li
      UNION ALL SELECT 'l_netprice', abs(corr(l_extendedprice, l_netprice)) FROM li
      UNION ALL SELECT 'l_discount', abs(corr(l_quantity, l_discount)) FROM li
      UNION ALL SELECT 'l_discount', abs(corr(l_extendedprice, l_discount)) FROM li
      UNION ALL SELECT 'l_discount', abs(corr(l_netprice, l_discount)) FROM li
      UNION ALL SELECT 'l_tax', abs(corr(l_quantity, l_tax)) FROM li
      UNION ALL SELECT 'l_tax', abs(corr(l_extendedprice, l_tax)) FROM li
      UNION ALL SELECT 'l_tax', abs(corr(l_netprice, l_tax)) FROM li
      UNION ALL SELECT 'l_tax', abs(corr(l_discount, l_tax)) FROM li)
SELECT DISTINCT col AS "column" FROM p WHERE c > 0.9
""")
def q_corr_drop_candidates(spark, sf):
    li = load(spark, sf, "lineitem").withColumn(
        "l_netprice", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return A.corr_drop_candidates(li, ["l_quantity", "l_extendedprice", "l_netprice",
                                       "l_discount", "l_tax"], 0.9)


@query("quantile_bounds", _per_col_sql(["l_extendedprice", "l_quantity"], {
    "lower": ("quantile_cont({c}, 0.00001)", True), "upper": ("quantile_cont({c}, 0.99999)", True)}))
def q_quantile_bounds(spark, sf):
    return rounded(D.quantile_bounds(load(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"]))


@query("truncate_outliers", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount FROM lineitem
WHERE l_extendedprice BETWEEN (SELECT quantile_cont(l_extendedprice, 0.00001) FROM lineitem)
                          AND (SELECT quantile_cont(l_extendedprice, 0.99999) FROM lineitem)
  AND l_quantity BETWEEN (SELECT quantile_cont(l_quantity, 0.00001) FROM lineitem)
                     AND (SELECT quantile_cont(l_quantity, 0.99999) FROM lineitem)
  AND l_discount BETWEEN (SELECT quantile_cont(l_discount, 0.00001) FROM lineitem)
                     AND (SELECT quantile_cont(l_discount, 0.99999) FROM lineitem)
""")
def q_truncate_outliers(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                            "l_quantity", "l_discount")
    return D.truncate_outliers(li, ["l_extendedprice", "l_quantity", "l_discount"])


@query("needs_scaling", _per_col_sql(LI_NUM, {
    "min": ("CAST(min({c}) AS DOUBLE)", True), "max": ("CAST(max({c}) AS DOUBLE)", True),
    "std": ("stddev_samp({c})", True),
    "needs_scaling": ("(max({c}) - min({c})) > 2.5 * stddev_samp({c})", False)}))
def q_needs_scaling(spark, sf):
    return rounded(D.needs_scaling(load(spark, sf, "lineitem"), LI_NUM))


@query("histogram", """
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin,
             count(*) AS n FROM lineitem, b GROUP BY 1)
SELECT CAST(g.i AS INTEGER) AS bin, round(lo + g.i * ((hi - lo) / 50), 6) AS lower,
       round(lo + (g.i + 1) * ((hi - lo) / 50), 6) AS upper, coalesce(c.n, 0) AS n
FROM range(50) g(i) CROSS JOIN b LEFT JOIN c ON c.bin = g.i
""")
def q_histogram(spark, sf):
    return rounded(D.histogram(load(spark, sf, "lineitem"), "l_extendedprice", 50))


@query("histogram_shared", """
WITH b AS (SELECT least(min(l_discount), min(l_tax)) AS lo, greatest(max(l_discount), max(l_tax)) AS hi
           FROM lineitem),
v AS (SELECT 'l_discount' AS "column", l_discount AS x FROM lineitem
      UNION ALL SELECT 'l_tax', l_tax FROM lineitem),
c AS (SELECT "column", CAST(least(floor((x - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin, count(*) AS n
      FROM v, b GROUP BY 1, 2),
g AS (SELECT col AS "column", i FROM (VALUES ('l_discount'), ('l_tax')) t(col), range(50) r(i))
SELECT g."column", CAST(g.i AS INTEGER) AS bin, round(lo + g.i * ((hi - lo) / 50), 6) AS lower,
       round(lo + (g.i + 1) * ((hi - lo) / 50), 6) AS upper, coalesce(c.n, 0) AS n
FROM g CROSS JOIN b LEFT JOIN c ON c."column" = g."column" AND c.bin = g.i
""")
def q_histogram_shared(spark, sf):
    return rounded(D.histogram_shared(load(spark, sf, "lineitem"), ["l_discount", "l_tax"], 50))


@query("kde", """
WITH s AS (SELECT count(l_quantity) AS n, stddev_samp(l_quantity) * pow(count(l_quantity), -0.2) AS h,
                  min(l_quantity) AS lo, max(l_quantity) - min(l_quantity) AS rng FROM lineitem),
d AS (SELECT l_quantity AS x, count(*) AS m FROM lineitem GROUP BY 1),
g AS (SELECT i, (lo - rng * 0.5) + i * ((rng * 2.0) / 999) AS gx FROM range(1000) r(i), s)
SELECT CAST(g.i AS INTEGER) AS point, round(g.gx, 6) AS x,
       round(sum(d.m * exp(-0.5 * pow((g.gx - d.x) / s.h, 2))) / (s.n * s.h * sqrt(2 * pi())), 9)
       AS density
FROM g, d, s GROUP BY g.i, g.gx, s.n, s.h
""")
def q_kde(spark, sf):
    out = D.kde(load(spark, sf, "lineitem"), "l_quantity", 1000)
    return out.select("point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@query("boxplot_stats", """
WITH v AS (SELECT 'l_extendedprice' AS "column", l_extendedprice AS x FROM lineitem
           UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem),
q AS (SELECT "column", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1)
SELECT q."column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), 6) AS whisker_lo,
       round(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_hi,
       count_if(x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM v JOIN q ON v."column" = q."column" GROUP BY q."column", q1, median, q3
""")
def q_boxplot_stats(spark, sf):
    return rounded(D.boxplot_stats(load(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"]))
