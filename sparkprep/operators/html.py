"""Record extraction from stored HTML with regular expressions (the page
text is processed in the JVM; no DOM parser per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Extraction patterns (Java regex). Names match in any case and
# elements may span lines.
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
ANCHOR = r"(?is)<a\b([^>]*)>(.*?)</a\s*>"
HREF = r"(?is)(?:^|\s)href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
TABLE = r"(?is)<table\b[^>]*>(.*?)</table\s*>"
TABLE_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
TABLE_CELL = r"(?is)<td\b[^>]*>(.*?)</td\s*>"
LIST_ITEM = r"(?is)<li\b[^>]*>(.*?)</li\s*>"
TAG = r"(?s)<[^>]*>"


def text_content(inner: Column) -> Column:
    """Text of an element: tags removed, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(inner, TAG, ""), r"\s+", " "))


def _href(attrs: Column) -> Column:
    """Value of ``href`` among an element's attributes, in any quoting and
    place; null if there is none."""
    value = F.concat(*[F.regexp_extract(attrs, HREF, k) for k in (1, 2, 3)])
    return F.when(F.regexp_like(attrs, F.lit(HREF)), value)


def _anchors(html) -> Column:
    """Anchors as structs (attrs, inner)."""
    return F.arrays_zip(F.regexp_extract_all(html, F.lit(ANCHOR), 1).alias("attrs"),
                        F.regexp_extract_all(html, F.lit(ANCHOR), 2).alias("inner"))


def title(df: DataFrame, html: str = "html", keys=("page_id",)) -> DataFrame:
    """Text of the first ``<title>``; null if there is none."""
    return df.select(*keys, F.when(F.regexp_like(html, F.lit(TITLE)), text_content(
        F.regexp_extract(html, TITLE, 1))).alias("title"))


def links(df: DataFrame, html: str = "html", keys=("page_id",)) -> DataFrame:
    """Every anchor with its position on the page: href (null without one),
    all attributes as written, and text."""
    a = df.select(*keys, F.posexplode(_anchors(F.col(html))).alias("idx", "a"))
    return a.select(*keys, "idx", _href(F.col("a.attrs")).alias("href"), F.trim("a.attrs").alias("attrs"),
                    text_content(F.col("a.inner")).alias("text"))


def nth_link(df: DataFrame, n: int, html: str = "html", keys=("page_id",)) -> DataFrame:
    """The n-th (1-based) anchor of every page: href, attributes, text."""
    a = F.try_element_at(_anchors(F.col(html)), F.lit(n))
    return df.select(*keys, a.alias("a")).select(
        *keys, _href(F.col("a.attrs")).alias("href"), F.trim("a.attrs").alias("attrs"),
        text_content(F.col("a.inner")).alias("text"))


def nth_tag(df: DataFrame, tag: str, n: int, html: str = "html", keys=("page_id",)) -> DataFrame:
    """Inner HTML of the n-th (1-based) ``<tag>`` element; null if absent."""
    pat = f"(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>"
    return df.select(*keys, F.try_element_at(F.regexp_extract_all(html, F.lit(pat), 1), F.lit(n))
                     .alias(f"{tag}_{n}"))


def anchor_records(df: DataFrame, html: str = "html", keys=("page_id",)) -> DataFrame:
    """Repeated records: each ``<li>`` holding an anchor becomes a row
    ``(idx, href, text)`` of its first anchor; others are skipped."""
    items = df.select(*keys, F.posexplode(F.regexp_extract_all(html, F.lit(LIST_ITEM), 1)).alias("idx", "_item"))
    first = items.withColumn("_a", F.try_element_at(_anchors(F.col("_item")), F.lit(1)))
    return (first.filter(F.col("_a").isNotNull())
                 .select(*keys, "idx", _href(F.col("_a.attrs")).alias("href"),
                         text_content(F.col("_a.inner")).alias("text")))


def table_rows(df: DataFrame, cells=None, html: str = "html", keys=("page_id",), table: int | None = None) -> DataFrame:
    """``<tr>`` rows (of the ``table``-th table, 1-based, or of the whole
    page) -> arrays of ``<td>`` texts; rows without ``<td>`` (headers) are
    skipped; ``cells`` picks 1-based cell positions."""
    source = F.col(html) if table is None else F.try_element_at(
        F.regexp_extract_all(html, F.lit(TABLE), 1), F.lit(table))
    rows = df.select(*keys, F.posexplode(F.regexp_extract_all(source, F.lit(TABLE_ROW), 1)).alias("row", "_tr"))
    out = rows.select(*keys, "row", F.transform(
        F.regexp_extract_all("_tr", F.lit(TABLE_CELL), 1), text_content).alias("cells"))
    out = out.filter(F.size("cells") > 0)
    if cells:
        out = out.select(*keys, "row", *[F.try_element_at("cells", F.lit(i)).alias(f"cell_{i}")
                                         for i in cells])
    return out
