"""Invariants for the rows-only (model) queries, plan-shape checks that
guard the scale design, and the streaming helpers."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tables_dir import SF_SMALL
from sparkprep.operators import neighbours as NB
from sparkprep.operators.ordering import global_rank
from sparkprep.operators.scan import grouped_scan

Q = entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_logistic_scores_are_probabilities(spark):
    out = Q["logistic"](spark, SF_SMALL)
    assert out.count() > 0
    assert out.filter((F.col("p") < 0) | (F.col("p") > 1)).count() == 0


def test_model_io_round_trip_equals_in_memory(spark):
    a = Q["model_io"](spark, SF_SMALL).select("vec_id", F.round("p", 12).alias("p"))
    b = Q["logistic"](spark, SF_SMALL).select("vec_id", F.round("p", 12).alias("p"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_kmeans_assignments_cover_all_rows(spark):
    out = Q["kmeans_cosine"](spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    assert out.count() == n
    assert out.filter((F.col("cluster") < 0) | (F.col("cluster") > 3)).count() == 0


@pytest.fixture(scope="module")
def rules(spark):
    return Q["tree_rules"](spark, SF_SMALL).orderBy("node").collect()


def test_tree_rules_form_a_tree(rules):
    assert rules and rules[0]["parent"] is None
    ids = {r["node"] for r in rules}
    assert all(r["parent"] in ids for r in rules[1:])


def test_bootstrap_is_deterministic(spark):
    a = Q["sample_bootstrap"](spark, SF_SMALL)
    b = Q["sample_bootstrap"](spark, SF_SMALL)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_global_rank_is_a_permutation_and_spreads_a_hot_key(spark):
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).alias("k"))
    r = global_rank(df, ["k"], "rk", num_partitions=6)
    got = sorted(x["rk"] for x in r.select("rk").collect())
    assert got == list(range(1, 3001))
    # one key holds a third of the rows: no partition may hold it all
    sizes = r.groupBy(F.spark_partition_id()).count().collect()
    assert max(s["count"] for s in sizes) < 1500


def test_grouped_scan_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"),
                                  (F.col("id") * 7 % 11).alias("v"))
    got = grouped_scan(df, ["g"], ["o"], {"s": ("sum", "v"), "m": ("max", "v"), "n": ("count", F.lit(1))})
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("g", "o", "v", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"),
                    F.count(F.lit(1)).over(w).alias("n"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = _plan(Q["dedup_keep_latest"](spark, SF_SMALL))
    # map-side partial step: a hot key is cut to one row per task first
    pre_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in pre_shuffle and "Partial" in pre_shuffle


def test_projection_and_filter_reach_the_scan(spark):
    plan = _plan(Q["select_cols"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    plan = _plan(Q["standard_scaler"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)]" in plan


@pytest.mark.parametrize("name", ["knn_join", "geocode_reverse", "kmeans_assign", "cosine_pairwise",
                                  "gaussian_nb", "cosine_rank"])
def test_no_cross_products(spark, name):
    plan = _plan(Q[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_reverse_geocode_keeps_repeated_points(spark):
    from sparkprep.plans.q_models import _gazetteer
    pts = spark.createDataFrame([(1, 10.0, 20.0), (1, 10.0, 20.0), (2, None, 3.0), (3, 89.9, 0.0)],
                                "k long, lat double, lng double")
    got = NB.geocode_reverse(pts, "lat", "lng", _gazetteer(spark, SF_SMALL)).orderBy("k").collect()
    assert [r["k"] for r in got] == [1, 1, 2, 3]
    assert got[0] == got[1] and got[0]["place"] is not None and got[2]["place"] is None and got[3]["place"] is not None
    none = _gazetteer(spark, SF_SMALL).limit(0)
    assert NB.geocode_reverse(pts, "lat", "lng", none).where("place is null").count() == 4


def test_knn_does_not_depend_on_pivots_and_rings(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    e = e.unionByName(e.where("vec_id % 5 = 0").withColumn("label", F.col("label") + 1))  # tied distances
    q, t = e.filter(F.col("vec_id") < 50), e.filter(F.col("vec_id") >= 50)
    a = NB.knn_classify(q, t, "vec_id", "embedding", "label", 3)
    b = NB.knn_classify(q, t, "vec_id", "embedding", "label", 3, pivots=5, ring_rows=9)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_sparse_onehot_takes_any_number_of_categories(spark):
    from sparkprep.operators.encoding import onehot_sparse
    df = spark.range(12_000).select("id", F.format_string("c%05d", "id").alias("v")).unionByName(
        spark.createDataFrame([(-1, None)], "id long, v string"))
    got = {r["id"]: (r["v_hot"], r["v_hot_size"]) for r in onehot_sparse(df, "v").collect()}
    assert len(got) == 12_001 and got[0] == (None, 11_999) and got[7] == (6, 11_999) and got[-1] == (None, 11_999)


def test_tree_dump_counts_every_training_row(rules):
    rows = rules
    by = {r["node"]: r for r in rows}
    for r in rows:
        assert sum(r["class_counts"]) == r["n_samples"]
        kids = [k for k in rows if k["parent"] == r["node"]]
        assert len(kids) in (0, 2) and (not kids or sum(k["n_samples"] for k in kids) == r["n_samples"])
        assert r["depth"] == (0 if r["parent"] is None else by[r["parent"]]["depth"] + 1)


def test_mlp_step_size_takes_effect(spark):
    from sparkprep.operators import ml as ML
    df = ML.vectorize(spark.range(60).select((F.col("id") % 2).cast("double").alias("label"),
                                             (F.col("id") % 7).cast("double").alias("x")), ["x"])
    a, b = (ML.mlp([1, 3, 2], s, max_iter=5).fit(df).weights.toArray().tolist() for s in (0.03, 0.3))
    assert a != b


def test_streaming_token_counts_equal_batch(spark):
    from sparkprep.streaming.micro_batch import read_stream, running_token_counts
    s = read_stream(spark, SF_SMALL, "doc_id long, text string, lang string, source string, n_chars long",
                    glob="documents.parquet")
    q = running_token_counts(s, table="tok_stream_test")
    q.awaitTermination(120)
    streamed = spark.table("tok_stream_test")
    batch = Q["bow_counts"](spark, SF_SMALL).groupBy("token").agg(F.sum("tf").alias("n"))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_grouped_scan_spreads_a_hot_group(spark):
    # one group holds a third of the rows; its running count must still be
    # computed across several tasks and stay exact
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
                                  F.col("id").alias("o"))
    out = grouped_scan(df, ["g"], ["o"], {"n": ("count", F.lit(1))}, num_partitions=6)
    hot = out.filter(F.col("g") == 0)
    assert sorted(r["n"] for r in hot.select("n").collect()) == list(range(1, hot.count() + 1))
    per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_task) < 1000 + 100


def test_apply_to_stream_writes_cleaned_rows(spark, tmp_path):
    from sparkprep.functions.text import clean_text, LATIN_KEEP
    from sparkprep.streaming.micro_batch import apply_to_stream, read_stream
    s = read_stream(spark, SF_SMALL, "page_id long, url string, html string", glob="pages.parquet")
    sink = str(tmp_path / "clean")
    q = apply_to_stream(s, lambda d: d.select("page_id", clean_text(F.col("html"), LATIN_KEEP).alias("text")), sink)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    exp = Q["clean_html_cjk"](spark, SF_SMALL)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


@pytest.mark.parametrize("name", ["mlp_grid", "defects_pipeline"])
def test_grid_fits_read_a_stored_table(spark, monkeypatch, name):
    """No fit of a grid computes its input again."""
    from sparkprep.operators import ml as ML
    seen = []

    class Enough(Exception):
        pass

    def search(train, val, *args, **kw):
        seen.extend([train, val])
        raise Enough

    monkeypatch.setattr(ML, "grid_search", search)
    with pytest.raises(Enough):
        Q[name](spark, SF_SMALL)
    for df in seen:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Scan ExistingRDD" in plan and "Exchange" not in plan and "FileScan" not in plan
