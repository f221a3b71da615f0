"""Driver tables: one parquet file per table under an ``sf`` folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters. NaN is
    missing, as after every source (``nan_to_null``)."""
    if name not in TABLES:
        raise KeyError(name)
    return nan_to_null(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over all cores when a scan yields fewer input
    splits than there are task slots (a few large row groups of long
    texts). On a cluster reading many files this is a no-op."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """pandas treats NaN as missing; Spark keeps NaN distinct from NULL and
    NaN poisons aggregates. Map NaN to NULL in float/double columns."""
    if not any(isinstance(f.dataType, (T.DoubleType, T.FloatType)) for f in df.schema.fields):
        return df
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            cols.append(F.when(F.isnan(c), F.lit(None)).otherwise(c).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
