"""Connected components of a link table, as Spark joins.

Each round hooks every vertex to its smallest neighbour, follows the hooks to
their roots by pointer jumping, and contracts the links to the roots; links
inside a contracted vertex go. The number of vertices that still have links
at least halves in a round, so few rounds are needed. Every table between
steps is written to the shared folder, so both sides of each join are plain
scans whose skewed keys (a hub with a third of all links) Spark splits, and a
lost executor costs no recomputation. Nothing is collected but row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_empty, saved


def _roots(hooks: DataFrame) -> DataFrame:
    """Follow (id, up) to the roots, doubling the distance each time."""
    while True:
        up = hooks.select(F.col("id").alias("up"), F.col("up").alias("upper"))
        jumped = saved(hooks.join(up, "up").select("id", F.col("upper").alias("up"), F.col("up").alias("was")))
        if is_empty(jumped.where("up <> was")):
            return jumped.select("id", "up")
        hooks = jumped.select("id", "up")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for each id with a link the smallest id reachable.
    Links may repeat, and may join an id with itself."""
    links = saved(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    label = None
    while not is_empty(links):
        near = links.select(F.explode(F.array(
            F.struct(F.col("a").alias("id"), F.col("b").alias("o")),
            F.struct(F.col("b").alias("id"), F.col("a").alias("o")))).alias("x"))
        hooks = saved(near.groupBy(F.col("x.id").alias("id")).agg(F.min("x.o").alias("o"))
                          .select("id", F.least("id", "o").alias("up")))
        roots = _roots(hooks)
        if label is None:
            label = roots.select("id", F.col("up").alias("component"))
        else:
            above = roots.select(F.col("id").alias("component"), "up")
            label = saved(label.join(above, "component", "left")
                               .select("id", F.coalesce("up", "component").alias("component")))
        ra = roots.select(F.col("id").alias("a"), F.col("up").alias("ra"))
        rb = roots.select(F.col("id").alias("b"), F.col("up").alias("rb"))
        half = saved(links.join(ra, "a").select("ra", "b").where("ra <> b"))
        links = saved(half.join(rb, "b").where("ra <> rb")
                          .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if label is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return label
