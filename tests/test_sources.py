"""CSV inference by pandas' rules, mergeable sketches and one-hot categories."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import encoding as E
from sparkprep.operators import sketches as SK
from sparkprep.sources import files as IO

FILE = """id,gaps,number,flag,holed,word,date,none,big,mixed,spaced
1,5,1.5,True,True,a,2020-01-01,,9223372036854775807,1, 3
2,NA,2,False,,"b ""q""
x",2020-01-02,NaN,1,x, 4
-3,7,1e3,TRUE,False,NA,2020-01-03,,2,2.5,5
"""


def test_inference_follows_pandas(spark, tmp_path):
    (tmp_path / "t.csv").write_text(FILE)
    got = IO.read_csv_inferred(spark, str(tmp_path / "t.csv"))
    want = pd.read_csv(tmp_path / "t.csv")
    kinds = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}
    assert dict(got.dtypes) == {c: kinds[str(t)] for c, t in want.dtypes.items()}
    rows = sorted((r.asDict() for r in got.collect()), key=lambda r: r["id"])
    for mine, (_, theirs) in zip(rows, want.astype(object).sort_values("id").iterrows()):
        for c, v in mine.items():
            if pd.isna(theirs[c]):
                assert v is None
            else:
                assert v == theirs[c] or str(v) == str(theirs[c])


def test_inference_reads_all_rows_and_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n" + "1,2\n" * 3000)
    (folder / "b.csv").write_text("x,y\n1,2\n2.5,word\n")
    assert dict(IO.read_csv_inferred(spark, str(folder)).dtypes) == {"x": "double", "y": "string"}


def test_inferred_equals_declared(spark, tmp_path):
    n = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    path = IO.write_csv(n, str(tmp_path / "nation"))
    declared = IO.read_csv(spark, path, ", ".join(f"{c} {'long' if t in ('int', 'bigint') else t}" for c, t in n.dtypes))
    inferred = IO.read_csv_inferred(spark, path)
    assert inferred.dtypes == declared.dtypes
    assert inferred.exceptAll(declared).count() == 0 and declared.exceptAll(inferred).count() == 0


def test_rank_error_of_merged_and_whole_sketches(spark):
    rng = np.random.default_rng(6)
    x = np.sort(np.concatenate([rng.lognormal(0, 2, 20_000), np.full(5_000, 3.0)]))
    df = spark.createDataFrame(pd.DataFrame({"x": rng.permutation(x), "day": rng.integers(0, 9, len(x))}))
    df = df.unionByName(spark.createDataFrame([(float("nan"), 1), (None, 2)], "x double, day long"))
    for sketches in (SK.sketch_columns(df, ["x"]), SK.merge_sketches(SK.sketch_columns(df, ["x"], ["day"]))):
        assert sketches.first()["n"] == len(x)
        for r in SK.approx_quantiles(sketches, [0.1, 0.5, 0.9]).collect():
            lo, hi = np.searchsorted(x, r["value"], "left") / len(x), np.searchsorted(x, r["value"], "right") / len(x)
            assert lo - SK.rank_error() <= r["prob"] <= hi + SK.rank_error()
    assert SK.approx_median(df.where("x is null"), ["x"]).first()["median"] is None


def test_dense_categories_are_checked(spark):
    df = spark.range(30).select(F.format_string("c%02d", F.col("id") % 12).alias("v")).unionByName(
        spark.createDataFrame([(None,)], "v string"))
    assert E.categories(df, "v") == [f"c{k:02d}" for k in range(12)]
    with pytest.raises(ValueError, match="onehot_sparse"):
        E.categories(df, "v", limit=11)
