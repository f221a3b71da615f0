"""NaN is missing after every source: the statistics, scalers and binnings give
what pandas gives on the same column."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import association as A
from sparkprep.operators import binning as B
from sparkprep.operators import distribution as D
from sparkprep.operators import profile as P
from sparkprep.operators import scaling as S
from sparkprep.operators.stats import corrected_kurtosis, corrected_skewness
from sparkprep.sources.tables import load


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(2)
    x, y = rng.normal(10, 4, 60), rng.normal(0, 1, 60)
    x[[3, 17, 40]] = np.nan
    y[[3, 22]] = np.nan
    return pd.DataFrame({"c_custkey": np.arange(60), "c_acctbal": x, "c_other": y + np.nan_to_num(x) / 5})


@pytest.fixture(scope="module")
def df(spark, frame, tmp_path_factory):
    folder = tmp_path_factory.mktemp("nan")
    pairs = [(int(r.c_custkey), float(r.c_acctbal), float(r.c_other)) for r in frame.itertuples()]
    raw = spark.createDataFrame(pairs, "c_custkey long, c_acctbal double, c_other double")
    raw.coalesce(1).write.parquet(f"{folder}/customer.parquet")
    assert raw.where(F.isnan("c_acctbal")).count() == 3
    return load(spark, str(folder), "customer")


def by_key(out, col):
    rows = out.select("c_custkey", col).toPandas().sort_values("c_custkey")
    return pd.to_numeric(rows[col]).to_numpy(dtype=float)


def close(a, b):
    return np.allclose(np.asarray(a, float), np.asarray(b, float), equal_nan=True, atol=1e-9)


def test_aggregates(df, frame):
    x = frame["c_acctbal"]
    row = {k: v for k, v in P.describe_numeric(df, ["c_acctbal"]).first().asDict().items()}
    assert row["count"] == 57
    d = x.describe()
    for name in ("mean", "std", "min", "max"):
        assert close(row[name], d[name])
    got = df.agg(corrected_skewness("c_acctbal"), corrected_kurtosis("c_acctbal"), F.var_samp("c_acctbal")).first()
    assert close(got, [x.skew(), x.kurt(), x.var()])
    mad = P.mean_abs_dev(df, ["c_acctbal"]).first()
    assert any(close(v, (x - x.mean()).abs().mean()) for v in mad if isinstance(v, float))
    holes = {r[0]: r[1] for r in P.missing_counts(df).collect()}
    assert holes["c_acctbal"] == 3 and holes["c_other"] == 2
    assert close(by_key(P.fill_mean(df, ["c_acctbal"]), "c_acctbal"), x.fillna(x.mean()))


def test_correlation(df, frame):
    want = frame["c_acctbal"].corr(frame["c_other"])
    assert close(A.corr_pair(df, "c_acctbal", "c_other").first()[0], want)
    matrix = {(r["a"], r["b"]): r["corr"] for r in A.corr_matrix(df, ["c_acctbal", "c_other"]).collect()}
    assert close(matrix["c_acctbal", "c_other"], want)
    assert A.corr_drop_candidates(df, ["c_acctbal", "c_other"], abs(want) - 0.01).count() == 1


def test_scalers(df, frame):
    x = frame["c_acctbal"]
    assert close(by_key(S.minmax(df, ["c_acctbal"]), "c_acctbal"), (x - x.min()) / (x.max() - x.min()))
    for ddof in (0, 1):
        assert close(by_key(S.zscore(df, ["c_acctbal"], ddof), "c_acctbal"), (x - x.mean()) / x.std(ddof=ddof))
    fit = S.standard_fit(df, ["c_acctbal"])
    assert close(by_key(S.standard_transform(df, fit, ["c_acctbal"]), "c_acctbal"), (x - x.mean()) / x.std(ddof=0))
    wide = (x.max() - x.min()) > 2.5 * x.std()
    assert close(by_key(S.scale_selected(df, ["c_acctbal"]), "c_acctbal"), (x - x.mean()) / x.std(ddof=0) if wide else x)
    assert [r[-1] for r in D.needs_scaling(df, ["c_acctbal"]).collect()] == [wide]


def test_bins(df, frame):
    x = frame["c_acctbal"]
    width = by_key(B.equal_width_bins(df, "c_acctbal", 4), "bin")
    lo, w = x.min(), (x.max() - x.min()) / 4
    want = np.minimum(3, np.floor((x - lo) / w))
    assert close(width, want)
    depth = by_key(B.equal_depth_bins(df, "c_acctbal", 4), "bin")
    assert close(depth, (x.rank() - 1) // (57 // 4))  # the row left over opens a bin of its own
    counts, _ = np.histogram(x.dropna(), 10)
    got = [r for r in D.histogram(df, "c_acctbal", 10).collect()]
    assert sorted(v for r in got for k, v in r.asDict().items() if k in ("n", "count")) == sorted(counts.tolist())
    k = D.kde(df, "c_acctbal", 20).toPandas()
    assert len(k) == 20 and not k.isna().any().any()


def test_few_values_give_null(spark):
    for n in (1, 2, 3):
        d = spark.range(n).select((F.col("id") * F.col("id")).cast("double").alias("x"))
        skew, kurt = d.agg(corrected_skewness("x"), corrected_kurtosis("x")).first()
        assert (skew is None) == (n < 3) and kurt is None
    one = spark.createDataFrame([("a", "x"), ("a", "y")], "p string, q string")
    assert A.cramers_v(one, "p", "q").first()["cramers_v"] is None
