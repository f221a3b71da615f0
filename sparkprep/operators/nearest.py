"""Exact nearest query by TF-IDF cosine with impact bounds (MaxScore).

Queries are dealt into blocks of a bounded number of postings. For every
block the largest unit weight of each term is known (its maximum impact), so
a document's best cosine with any query of a block is at most the sum of its
weights times those impacts. Each document first visits the block of its
highest bound; the cosine found there is the score to beat, and only blocks
whose bound reaches it are visited after that.

Inside a block a document's terms are read in the order of their bounds. When
what the remaining terms can add is less than the distance between the best
query and another one, that one is out; as soon as few are left, the common
terms at the end of the order are read for those alone, from the queries'
side. So one row a document and visited block is made, not one a document and
query that share a term.

State of a task: one block's postings and up to ``DOCS_PER_TASK`` documents'
terms (those that some query holds). A block that many documents visit is
dealt to several tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, store
from .bags import Block, as_bags, meet
from .scan import grouped_scan

BLOCK_POSTINGS = 1 << 18
DOCS_PER_TASK = 2_000
#: (term, block) impacts that may be broadcast; more are joined by shuffles
BROADCAST_IMPACTS = 100_000
FEW = 4
SLACK = 2e-9  # cosines are compared after rounding to 9 digits


def query_blocks(query_weights: DataFrame, query: str, token: str, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``(block, query, token, x)``: unit weights, in blocks of consecutive
    queries with about ``block_postings`` postings."""
    size = query_weights.groupBy(query).agg(F.count(F.lit(1)).alias("_n"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    placed = grouped_scan(size.where("_norm > 0"), [], [query], {"_upto": ("sum", "_n")})
    block = F.floor((F.col("_upto") - F.col("_n")) / block_postings).cast("long")
    return query_weights.join(placed.select(query, "_norm", block.alias("block")), query).select(
        "block", F.col(query).alias("query"), F.col(token).alias("token"), (F.col("w") / F.col("_norm")).alias("x"))


def _gather(begin, count):
    before = np.cumsum(count) - count
    return np.repeat(begin - before, count) + np.arange(int(count.sum()))


class BlockIndex:
    """Postings of one block of queries by term and by query."""

    def __init__(self, postings: pa.Table):
        term = postings.column("token").combine_chunks().dictionary_encode()
        self.terms = term.dictionary
        t = term.indices.to_numpy().astype(np.int64)
        self.queries, q = np.unique(postings.column("query").to_numpy(), return_inverse=True)
        x = postings.column("x").to_numpy()
        n, m = len(self.terms), len(self.queries)
        order = np.argsort(t, kind="stable")
        self.q, self.x = q[order], x[order]
        self.count = np.bincount(t, minlength=n)
        self.begin = np.cumsum(self.count) - self.count
        self.impact = np.maximum.reduceat(self.x, self.begin) if n else np.empty(0)
        order = np.argsort(q, kind="stable")
        self.t_of, self.x_of = t[order], x[order]
        self.size = np.bincount(q, minlength=m)
        self.first = np.cumsum(self.size) - self.size

    def best(self, t: np.ndarray, w: np.ndarray, floor: float) -> tuple[int, float, int]:
        """(place of the best query or -1, its cosine, postings read) for a
        document's terms and unit weights; queries that cannot come within
        rounding of ``floor`` may be passed over."""
        bound = w * self.impact[t]
        order = np.argsort(-bound, kind="stable")
        t, w, bound = t[order], w[order], bound[order]
        rest = np.concatenate([np.cumsum(bound[::-1])[::-1][1:], [0.0]])  # what later terms can add
        score = np.zeros(len(self.queries))
        lo, step, read = 0, 2, 0
        while lo < len(t):
            hi = min(len(t), lo + step)
            at = _gather(self.begin[t[lo:hi]], self.count[t[lo:hi]])
            score += np.bincount(self.q[at], self.x[at] * np.repeat(w[lo:hi], self.count[t[lo:hi]]), len(score))
            read += len(at)
            lo, step = hi, step * 2
            left = rest[hi - 1]
            alive = np.flatnonzero(score + left >= max(floor, score.max()) - SLACK)
            if len(alive) == 0:
                return -1, 0.0, read
            if len(alive) <= FEW and lo < len(t):
                dense = np.zeros(len(self.terms))
                dense[t] = w
                score[:] = -1.0
                for k in alive:
                    s = slice(self.first[k], self.first[k] + self.size[k])
                    score[k] = dense[self.t_of[s]] @ self.x_of[s]
                    read += self.size[k]
                break
        top = np.round(score, 9)
        k = int(np.argmax(top))  # the smallest query among ties
        return (k, float(top[k]), read) if top[k] > 0 else (-1, 0.0, read)


def _visit(docs: pa.Table, postings: pa.Table) -> pa.Table:
    schema = pa.schema([("doc", docs.schema.field("doc").type), ("query", postings.schema.field("query").type),
                        ("cosine", pa.float64()), ("postings_read", pa.int64())])
    if not docs.num_rows or not postings.num_rows:
        return schema.empty_table()
    index = BlockIndex(postings)
    terms = docs.column("terms").combine_chunks()
    flat = terms.flatten()
    place = pc.index_in(flat.field("token"), value_set=index.terms)
    t, w = pc.fill_null(place, -1).to_numpy().astype(np.int64), flat.field("w").to_numpy()
    offs = terms.offsets.to_numpy() - terms.offsets[0].as_py()
    floor = docs.column("floor").to_numpy()
    found = []
    for r in range(docs.num_rows):
        s = slice(offs[r], offs[r + 1])
        known = t[s] >= 0
        found.append(index.best(t[s][known], w[s][known], floor[r]))
    hit = np.array([k >= 0 for k, _, _ in found])
    return pa.table([docs.column("doc").filter(pa.array(hit)),
                     pa.array(index.queries[[k for k, _, _ in found if k >= 0]], schema.field("query").type),
                     pa.array([c for k, c, _ in found if k >= 0], pa.float64()),
                     pa.array([n for k, _, n in found if k >= 0], pa.int64())], schema=schema)


def _unit_terms(b: Block) -> pa.Table:
    """Unit weights of the terms that some query holds."""
    w = b.values * b.table.column("idf").to_numpy()[b.at]
    norm = np.sqrt(b.per_doc(w * w))[b.row]
    asked = b.table.column("asked").to_numpy()[b.at].astype(bool)
    return b.lists((norm > 0) & asked, w=np.divide(w, norm, out=np.zeros(len(w)), where=norm > 0)).drop_columns(["block"])


def _score(visits: DataFrame, vectors: DataFrame, blocks: DataFrame, docs_per_task: int) -> DataFrame:
    """Best query of each visited (doc, block)."""
    parts = cut_lineage(visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / docs_per_task).cast("int").alias("parts")))
    left = visits.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")).join(
        vectors, "doc").select("block", "part", "doc", "floor", "terms")
    copies = parts.select(F.col("block").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"))
    right = blocks.join(copies, F.col("block") == F.col("b")).select("b", "p", "query", "token", "x")
    kinds = dict(left.dtypes) | dict(right.dtypes)
    return left.groupBy("block", "part").cogroup(right.groupBy("b", "p")).applyInArrow(
        _visit, f"doc {kinds['doc']}, query {kinds['query']}, cosine double, postings_read long")


def nearest_query(tf: DataFrame, query_tf: DataFrame, idf: DataFrame, doc: str = "doc_id", token: str = "token",
                  query: str = "query", block_postings: int = BLOCK_POSTINGS,
                  docs_per_task: int = DOCS_PER_TASK) -> DataFrame:
    """``(doc, query, cosine)``: for every document that has a term in common
    with some query the nearest one by TF-IDF cosine (9 digits; ties: the
    smallest query). Weights are tf * idf of the terms that ``idf`` knows."""
    return visited(tf, query_tf, idf, doc, token, query, block_postings, docs_per_task).groupBy("doc").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), F.col("query").alias("q"))).alias("b")).select(
        F.col("doc").alias(doc), F.col("b.q").alias(query), (-F.col("b.c")).alias("cosine"))


def visited(tf: DataFrame, query_tf: DataFrame, idf: DataFrame, doc: str = "doc_id", token: str = "token",
            query: str = "query", block_postings: int = BLOCK_POSTINGS, docs_per_task: int = DOCS_PER_TASK) -> DataFrame:
    """One row a document and visited block: its best query there."""
    weigh = lambda df: df.join(idf, token).withColumn("w", F.col("tf") * F.col("idf"))
    blocks = cut_lineage(query_blocks(weigh(query_tf).select(query, token, "w"), query, token, block_postings))
    impacts = cut_lineage(blocks.groupBy("token", "block").agg(F.max("x").alias("impact")))
    # norms take all terms; from here on only terms that some query holds
    known = idf.select(F.col(token).alias("token"), "idf").join(
        impacts.select("token").distinct().withColumn("asked", F.lit(True)), "token", "left").select(
        "token", "idf", F.col("asked").isNotNull().alias("asked"))
    bags = as_bags(tf, doc, token)
    vectors = store(meet(bags, known, _unit_terms, f"doc {dict(bags.rows.dtypes)['doc']}, tokens {dict(bags.rows.dtypes)['tokens']}, w array<double>"
                         ).select("doc", F.arrays_zip(F.col("tokens").alias("token"), "w").alias("terms")))
    unit = vectors.select("doc", F.inline("terms"))
    small = impacts.count() <= BROADCAST_IMPACTS
    bounds = cut_lineage(unit.join(F.broadcast(impacts) if small else impacts, "token").groupBy("doc", "block").agg(
        F.sum(F.col("w") * F.col("impact")).alias("bound")))
    first = bounds.withColumn("_r", F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("bound"), "block")))
    opening = first.where("_r = 1").select("doc", "block", F.lit(0.0).alias("floor"))
    best = cut_lineage(_score(opening, vectors, blocks, docs_per_task))
    more = (bounds.join(opening.select("doc", "block"), ["doc", "block"], "left_anti")
                  .join(best.select("doc", F.col("cosine").alias("floor")), "doc", "left")
                  .withColumn("floor", F.coalesce("floor", F.lit(0.0))).where(F.col("bound") >= F.col("floor") - SLACK))
    return best.unionByName(_score(cut_lineage(more.select("doc", "block", "floor")), vectors, blocks, docs_per_task))
