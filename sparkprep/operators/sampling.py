"""Deterministic sampling and train/validation/test splits.

``randomSplit``/``sample`` depend on the partition layout, so results move
when data is repartitioned. Here membership is a pure function of a key:
``h(key) = ((key mod P) * M) mod P`` with P = 1 000 003 and M = 2 654 435 761
(a multiplicative hash kept far from 64-bit overflow for any key), and a
row is in a fraction f when h < f * P.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import global_rank
from .scan import grouped_scan

# Modulus and multiplier of the key hash.
HASH_MOD = 1_000_003
HASH_MULT = 2_654_435_761


def _key_number(key: Column) -> Column:
    """The key modulo P; a key that is no integer enters by its crc32."""
    number = F.coalesce(key.try_cast("long"), F.crc32(key.cast("string").cast("binary")))
    return F.pmod(number, F.lit(HASH_MOD))


def key_hash(key: Column) -> Column:
    return F.pmod(_key_number(key) * F.lit(HASH_MULT), F.lit(HASH_MOD))


def sample_frac(df: DataFrame, key: str, frac: float) -> DataFrame:
    return df.filter(key_hash(F.col(key)) < F.lit(frac * HASH_MOD))


def sample_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly ``n`` rows: the n smallest (hash, key) — a top-k."""
    return df.orderBy(key_hash(F.col(key)), F.col(key)).limit(n)


def poisson1_cdf(tail: float = 1e-18) -> list[float]:
    """Cumulative probabilities of Poisson(1), until the rest is under
    ``tail``."""
    import math
    cdf, acc, j = [], 0.0, 0
    while True:
        p = math.exp(-1) / math.factorial(j)
        acc += p
        cdf.append(acc)
        j += 1
        if p < tail:
            return cdf


def seeded_uniform(key: Column, seed: int) -> Column:
    """A uniform in [0, 1) from (key, seed) with the portable key hash. The
    seed picks its own multiplier, so draws for different seeds are not
    shifted copies of one draw."""
    mult = HASH_MULT + 2 * (seed * 40_503 % HASH_MOD)
    h = F.pmod((_key_number(key) + F.lit(seed)) * F.lit(mult), F.lit(HASH_MOD))
    return F.pmod(h * F.lit(HASH_MULT) + F.lit(seed), F.lit(HASH_MOD)) / F.lit(float(HASH_MOD))


def bootstrap(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Sample with replacement, deterministic per key: each row is repeated
    Poisson(1) times, drawn by inverse CDF from a per-row uniform derived
    from (key, seed). ``_copy`` numbers the repeats 1..n."""
    u = seeded_uniform(F.col(key), seed)
    cdf = poisson1_cdf()
    reps = F.lit(len(cdf))
    for j in reversed(range(len(cdf))):
        reps = F.when(u < cdf[j], F.lit(j)).otherwise(reps)
    return (df.withColumn("_reps", reps)
              .filter(F.col("_reps") > 0)
              .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_reps"))))
              .drop("_reps"))


def split_hash(df: DataFrame, key: str, fractions=(0.8, 0.2), names=("train", "test"),
               out: str = "split") -> DataFrame:
    """Label each row with a split by cumulative hash thresholds."""
    h = key_hash(F.col(key))
    expr, acc = None, 0.0
    for f, name in zip(fractions[:-1], names[:-1]):
        acc += f
        cond = h < F.lit(acc * HASH_MOD)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = expr.otherwise(F.lit(names[-1])) if expr is not None else F.lit(names[-1])
    return df.withColumn(out, expr)


def split_positional(df: DataFrame, order_by, fractions=(0.7, 0.1, 0.2),
                     names=("train", "val", "test"), out: str = "split") -> DataFrame:
    """First floor(f1*n) rows in order -> first split, next up to
    floor((f1+f2)*n) -> second, rest -> last (list slicing)."""
    ranked = global_rank(df, order_by, "_rk")
    n = ranked.select(F.coalesce(F.max("_rk"), F.lit(0))).scalar()
    expr, acc = None, 0.0
    for f, name in zip(fractions[:-1], names[:-1]):
        acc += f
        cond = F.col("_rk") <= F.floor(n * F.lit(acc))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return ranked.withColumn(out, expr.otherwise(F.lit(names[-1]))).drop("_rk")


def split_stratified(df: DataFrame, label: str, key: str, test_frac: float = 0.1,
                     out: str = "split") -> DataFrame:
    """Per class y, the round(test_frac * n_y) rows with the smallest
    (hash, key) go to test. The in-class rank comes from a segmented scan,
    so a dominant class is spread over all tasks."""
    h = key_hash(F.col(key))
    ranked = grouped_scan(df.withColumn("_h", h), [label], ["_h", key],
                          {"_rk": ("count", F.lit(1))})
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_ny"))
    return (ranked.join(sizes, label)
                  .withColumn(out, F.when(F.col("_rk") <= F.round(F.col("_ny") * test_frac),
                                          F.lit("test")).otherwise(F.lit("train")))
                  .drop("_rk", "_ny", "_h"))
