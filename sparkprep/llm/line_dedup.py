"""Line deduplication: keep bitmaps instead of text.

Each line becomes a 128-bit hash of its key (white space stripped at both
ends, A-Z lower-cased). The rows (hash, document, position) are
range-partitioned by all three, so the lines of one key lie in document
order and a key that a third of all documents share spreads over many
partitions. Inside a partition a running window streams the first document
of each key; a table with one row per partition (its last key and that key's
first document) carries the answer over partition borders. A line is dropped
when its key's first document is another one. Only dropped positions go on,
packed into 64-bit words per document; words without a drop are not stored.
Text is touched again only to apply the bitmaps. DataFrame functions only.

A null or empty text is one empty line. Keys shorter than ``min_chars`` code
points are never dropped, and a key repeated in one document only stays
whole. The smallest doc_id keeps a key; a null doc_id counts as the smallest.
Rows that repeat a doc_id count as one document for the rule and get a bitmap
for each different text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import hash128, saved

MIN_CHARS = 10
_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The stripped line with A-Z lower-cased (other letters as they are)."""
    bare = F.btrim(line, F.lit(_SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def _row_key(text: Column) -> Column:
    return F.xxhash64(text)


def keep_bitmaps(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row_key, keep) for each document that loses a line: ``keep``
    maps the number of a 64-line word to its keep bits; absent words are
    kept whole. ``row_key`` is xxhash64 of the text."""
    at = ["h1", "h2", "doc_id", "row_key", "pos"]
    lines = (docs.select(F.col(id_col).alias("doc_id"), _row_key(F.col(text_col)).alias("row_key"),
                         F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
                 .withColumn("key", line_key(F.col("line")))
                 .where(F.char_length("key") >= min_chars))
    h1, h2 = hash128(F.col("key"))
    # written first: range partitioning samples its input before it reads it
    hashed = saved(lines.select(h1.alias("h1"), h2.alias("h2"), "doc_id", "row_key", "pos"))
    ranged = cut_lineage(hashed.repartitionByRange(*at).sortWithinPartitions(*at)
                               .withColumn("pid", F.spark_partition_id()))
    stream = Window.partitionBy("pid", "h1", "h2").orderBy("doc_id", "row_key", "pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("first", F.first("doc_id").over(stream))
    key = F.struct("h1", "h2")
    # one row per partition: where a key goes on in the next partition, its
    # first document is the one the earliest partition saw
    carry = (local.groupBy("pid").agg(F.max(key).alias("k"), F.max_by(F.struct("first"), key).alias("f"))
                  .groupBy("k").agg(F.min_by("f", "pid").alias("f"))
                  .select(F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2"), "f"))
    first = F.when(F.col("f").isNotNull(), F.col("f.first")).otherwise(F.col("first"))
    dropped = (local.join(F.broadcast(carry), ["h1", "h2"], "left")
                    .where(~F.col("doc_id").eqNullSafe(first)))
    words = (dropped.groupBy("doc_id", "row_key", F.expr("cast(pos div 64 as int)").alias("word"))
                    .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")))
    return words.groupBy("doc_id", "row_key").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits")))).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  kept_col: str = "__kept", lines_col: str = "__n_lines", dropped_col: str = "__n_dropped") -> DataFrame:
    """``docs`` with the remaining text and the line counts of each row."""
    b = bitmaps.select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__row"), F.col("keep").alias("__keep"))
    joined = docs.join(b, F.col(id_col).eqNullSafe(F.col("__id")) & (_row_key(F.col(text_col)) == F.col("__row")), "left")
    lines = _lines(F.col(text_col))

    def stays(_, i):
        bits = F.coalesce(F.try_element_at("__keep", (i / 64).cast("int")), F.lit(-1).cast("long"))
        return F.getbit(bits, (i % 64).cast("int")) == 1

    rest = F.when(F.col("__keep").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(
        F.array_join(F.filter(lines, stays), "\n"))
    lost = F.when(F.col("__keep").isNull(), F.lit(0).cast("long")).otherwise(
        F.aggregate(F.map_values("__keep"), F.lit(0).cast("long"),
                    lambda acc, w: acc + F.bit_count(F.bitwise_not(w))))
    return joined.select(*[docs[c] for c in docs.columns], rest.alias(kept_col),
                         F.size(lines).cast("long").alias(lines_col), lost.alias(dropped_col))


def digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Line counts and the hash of the remaining text of every document."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = apply_bitmaps(source, keep_bitmaps(source, min_chars=min_chars))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.sha2(F.col("__kept").cast("binary"), 256).alias("kept_sha256"))


def drop_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text; a text that
    loses nothing (a null one too) stays as it is."""
    out = apply_bitmaps(docs, keep_bitmaps(docs, id_col=id_col, text_col=text_col, min_chars=min_chars),
                        id_col=id_col, text_col=text_col)
    new = F.when(F.col("__n_dropped") > 0, F.col("__kept")).otherwise(F.col(text_col))
    return out.select(*[new.alias(c) if c == text_col else F.col(c) for c in docs.columns])
