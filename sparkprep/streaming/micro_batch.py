"""Run the library's operators on Structured Streaming sources.

The reference has no streaming workload, so nothing stateful is ported.
What streams naturally is the row-local part of the library (text
cleaning, tokenising, recoding, validity flags): those operators are plain
column expressions and work unchanged on a streaming DataFrame. Counts
(token frequencies, value distributions) are kept as streaming state.
Checkpoints go under the session's shared checkpoint directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import ensure_checkpoint_dir


def read_stream(spark: SparkSession, folder: str, schema: str, glob: str | None = None,
                fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def _checkpoint(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sparkprep-stream/{name}-{uuid.uuid4().hex}"


def apply_to_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink: str,
                    fmt: str = "parquet", available_now: bool = True):
    """Apply a row-local operator to every micro-batch and append the
    result to ``sink`` (exactly-once through the file sink's log)."""
    spark = stream.sparkSession
    q = (transform(stream).writeStream.format(fmt).outputMode("append")
         .option("path", sink).option("checkpointLocation", _checkpoint(spark, "apply")))
    q = q.trigger(availableNow=True) if available_now else q
    return q.start()


def running_token_counts(stream: DataFrame, text: str = "text", table: str = "token_counts",
                         available_now: bool = True):
    """Token frequencies over everything seen so far, kept as streaming
    aggregation state and published as an in-memory table (complete
    mode; for tests and notebooks)."""
    spark = stream.sparkSession
    toks = stream.select(F.explode(T.vectorizer_tokens(F.col(text))).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    q = (counts.writeStream.format("memory").queryName(table).outputMode("complete")
         .option("checkpointLocation", _checkpoint(spark, "tokens")))
    q = q.trigger(availableNow=True) if available_now else q
    return q.start()
