"""Prefix trie of conversations from sorted sequences.

Every conversation is rebuilt from its turns (see ``rebuilt``), a turn being
known by a 128-bit hash of (role, text). Distinct sequences of first turns are
the nodes of a trie; the conversations that start with one are its members.

1. Sequences are range-partitioned in lexicographic order and sorted, equal
   ones by id, so a large group of copies is spread over several tasks.
2. In a task the LCPs (common first turns of neighbours) go into a sparse
   table for range minima. Each candidate prefix (row, depth) binary-searches
   the table to the left and to the right, independently of all others, for
   the farthest rows between which no LCP is under its depth: its members. A
   candidate whose left end is another row repeats that row's prefix. Counts
   and sums over members and subtrees are differences of running sums.
3. A node that touches the first or last row of a task may go on in the
   neighbouring ones. Only such pieces (at most two paths of the trie a task)
   are shuffled. A piece that follows another of its node is no new node: what
   its task counted as one more child, leaf or text is taken back, by a table
   with one row a task, and the pieces are added up.
4. The ids that end at a node are hashed where they lie together, and streamed
   task by task through one hash where they are spread.

Memory of a task: its share of the sequences (``TASK_TURNS`` turns on
average) at about 150 bytes a turn. A conversation is one row of 24 bytes a
turn; texts are hashed in the scan and never shuffled.

Null role or text counts as ''. Rows without a conv_id belong to no
conversation and are left out. Turns of one conversation with equal ``turn``
(null first) are ordered by their hash: fixed, but otherwise arbitrary; rows
that are equal in all four columns are turns of their own. ``c % 5`` has the
sign of c. Texts are hashed whole. Other columns are not looked at. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _powers, bounded_batches, hash128, mix, saved

GROUP = 5
HEAD = 9  # heads have 0 to HEAD - 1 turns
TASK_TURNS = 500_000
BROADCAST_ROWS = 100_000

_EMPTY = hashlib.sha256(b"").hexdigest()
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): the turns of each conversation in order, as hashes and
    bytes of text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    h1, h2 = hash128(role, text)
    turn = F.struct("turn", h1.alias("h1"), h2.alias("h2"), F.octet_length(text).cast("long").alias("b"))
    ordered = turns.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("seq"))
    return ordered.select("conv_id", F.transform("seq", lambda t: F.struct(t["h1"].alias("h1"), t["h2"].alias("h2"),
                                                                          t["b"].alias("b"))).alias("seq"))


def rebuilt(turns: DataFrame, *, group: int = GROUP, head: int = HEAD) -> DataFrame:
    """(conv_id, seq): each conversation c with its first h turns replaced by
    those of conversation c - c % ``group``, h = crc32(c as text) % ``head``."""
    own = saved(sequences(turns).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
                .withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).cast("int")))
    heads = own.select(F.col("conv_id").alias("base"), F.slice("seq", 1, head).alias("first"))
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    none = F.slice("seq", 1, 0)
    return own.join(heads, "base", "left").select("conv_id", F.concat(F.coalesce(
        F.slice("first", F.lit(1), F.col("h")), none), rest).alias("seq"))


# ---------------------------------------------------------------- range minima

class RangeMinimum:
    """Sparse table: row k holds the minima of 2^k neighbours."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while len(self.rows[-1]) > (half := 1 << (len(self.rows) - 1)):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum of values[a:b + 1], a <= b, of each pair."""
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[a[at]], row[b[at] - (1 << k) + 1])
        return out

    def right(self, a: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first position from ``a`` on whose value is under the bound
        (the number of values where there is none)."""
        at = a.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            inside = at < len(row)
            ok = inside & (row[np.where(inside, at, 0)] >= bound) if len(row) else inside
            at[ok] += 1 << k
        return at

    def left(self, a: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last position up to ``a`` whose value is under the bound (-1
        where there is none)."""
        at = a.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row, start = self.rows[k], at - (1 << k) + 1
            inside = start >= 0
            ok = inside & (row[np.where(inside, start, 0)] >= bound) if len(row) else inside
            at[ok] -= 1 << k
        return at


# ---------------------------------------------------------------- pieces

_PIECE = ("pid int, k1 long, k2 long, depth long, p1 long, p2 long, conv_id long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved_tokens long, before long, through long, head boolean, tail boolean, "
          "last boolean, up boolean, ends string, ends_sha256 string")


def _lcps(h1, h2, start, size) -> np.ndarray:
    """Common first turns of each row with the row before; -1 for the first,
    which every search may reach but not pass."""
    n = len(size)
    lcp = np.zeros(n, np.int64)
    lcp[:1] = -1
    both = np.minimum(size[1:], size[:-1])
    live = np.flatnonzero(both > 0) + 1
    d = 0
    while len(live):
        a, b = start[live] + d, start[live - 1] + d
        live = live[(h1[a] == h1[b]) & (h2[a] == h2[b])]
        d += 1
        lcp[live] = d
        live = live[both[live - 1] > d]
    return lcp


def _pieces(table: pa.Table, pid: int) -> pa.RecordBatch:
    """Nodes of a sorted run of sequences, as far as this run shows them."""
    conv = table.column("conv_id").to_numpy()
    seq = table.column("seq").combine_chunks()
    turn = seq.flatten()
    h1, h2, b = (turn.field(k).to_numpy(zero_copy_only=False) for k in ("h1", "h2", "b"))
    h1, h2 = h1.view(np.uint64), h2.view(np.uint64)
    n = len(conv)
    offs = seq.offsets.to_numpy().astype(np.int64)
    start, size = offs[:-1] - offs[0], np.diff(offs)
    lcp = _lcps(h1, h2, start, size)
    table_of = RangeMinimum(lcp)

    # candidates: each row's prefixes of 0 to all turns
    first = start + np.arange(n)  # candidate of depth 0
    row = np.repeat(np.arange(n), size + 1)
    depth = np.arange(len(row)) - first[row]
    left = table_of.left(row, depth)  # the row whose LCP breaks the interval is its first
    right = table_of.right(row + 1, depth) - 1
    own = left == row

    # keys, and bytes of the first turns, by candidate
    power, _ = _powers(int(size.max(initial=0)) + 1)
    pos = np.arange(len(h1)) - np.repeat(start, size)
    slot = np.flatnonzero(depth > 0)

    def running(values):
        total = np.zeros(len(values) + 1, values.dtype)
        np.cumsum(values, out=total[1:])
        return total[(start[row] + depth)] - total[start[row]]

    level = depth.astype(np.uint64) * _GOLD
    k1, k2 = (mix(mix(running(mix(h) * power[pos])) + level).view(np.int64) for h in (h1, h2))
    through = running(b)
    whole = through[first + size]  # bytes of a row's turns

    at = np.flatnonzero(own)
    l, r, d = row[at], right[at], depth[at]
    up = np.maximum(at - 1, 0)  # the same row's prefix that is one turn shorter
    parent = first[left[up]] + depth[up]
    children = np.bincount(parent[d > 0], minlength=len(row))[at]
    convs = RangeMinimum(conv)
    node_conv = np.empty(len(row), np.int64)
    node_conv[at] = convs.least(l, r)
    n_convs = r - l + 1

    leaf = np.ones(n, np.int64)
    leaf[:-1] = lcp[1:] < size[:-1]
    new = whole - through[first + np.maximum(lcp, 0)]
    total = lambda x: np.concatenate([[0], np.cumsum(x)])
    leaves, bytes_all, bytes_new = total(leaf), total(whole), total(new)
    before = np.where(d > 0, through[up], 0)
    saved_tokens = (bytes_all[r + 1] - bytes_all[l] - n_convs * before) - (
        bytes_new[r + 1] - bytes_new[l + 1] + whole[l] - before)

    head, tail = l == 0, r == n - 1
    spine = np.zeros(len(row), bool)
    spine[at] = head | tail
    # rows of exactly d turns come first among the members
    longer = np.flatnonzero(np.r_[(lcp[1:] < size[:-1]) | (size[1:] > size[:-1]), True]) if n else np.empty(0, int)
    stop = longer[np.searchsorted(longer, l)] + 1
    n_ends = np.where(size[l] == d, stop - l, 0)
    names = conv.astype(str)
    ends, digest = np.full(len(at), None, object), np.full(len(at), _EMPTY, object)
    for k in np.flatnonzero(n_ends):
        text = ",".join(names[l[k]:l[k] + n_ends[k]])
        if head[k] or tail[k]:
            ends[k] = text
        else:
            digest[k] = hashlib.sha256(text.encode()).hexdigest()

    root = d == 0
    long = lambda x: pa.array(x.astype(np.int64))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(at), pid, np.int32)), pa.array(k1[at]), pa.array(k2[at]), long(d),
        pa.array(k1[up], mask=root), pa.array(k2[up], mask=root), pa.array(node_conv[at]),
        pa.array(node_conv[parent], mask=root), long(n_convs), long(children), long(leaves[r + 1] - leaves[l]),
        long(saved_tokens), long(before), long(through[at]), pa.array(head), pa.array(tail),
        pa.array(tail & (d == size[-1])), pa.array(spine[parent] & ~root), pa.array(ends, pa.string()),
        pa.array(digest, pa.string())], names=[c.split()[0] for c in _PIECE.split(", ")])


def _run(batches):
    held = [b for b in batches if b.num_rows]
    if held:
        out = _pieces(pa.Table.from_batches(held), TaskContext.get().partitionId())
        for k in range(0, out.num_rows, 50_000):
            yield out.slice(k, 50_000)


def _streamed(batches):
    """SHA-256 of the texts of each node, which follow one another."""
    key, sha = None, None
    done = {"k1": [], "k2": [], "depth": [], "ends_sha256": []}

    def close():
        for name, value in zip(done, (*key, sha.hexdigest())):
            done[name].append(value)

    for batch in batches:
        for k1, k2, depth, text in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "depth", "ends"))):
            if (k1, k2, depth) != key:
                if key:
                    close()
                key, sha = (k1, k2, depth), hashlib.sha256(text.encode())
            else:
                sha.update(b"," + text.encode())
    if key:
        close()
    yield pa.RecordBatch.from_arrays([pa.array(done[c], pa.int64()) for c in ("k1", "k2", "depth")] + [
        pa.array(done["ends_sha256"], pa.string())], names=list(done))


def _merged(pieces: DataFrame) -> DataFrame:
    """Nodes of the pieces that touch a task's border."""
    node = ["k1", "k2", "depth"]
    at_node = Window.partitionBy(*node)  # a piece a task at most
    spine = (pieces.where("head or tail").withColumn("again", F.col("pid") > F.min("pid").over(at_node))
                   .withColumn("on", F.col("pid") < F.max("pid").over(at_node)))
    # one row a task: turns that its first row shares with the task before and
    # their bytes; whether its last row's node goes on or is extended
    border = spine.groupBy(F.col("pid").alias("at")).agg(
        F.max(F.when(F.col("again"), F.col("depth"))).alias("shared"),
        F.max(F.when(F.col("again"), F.col("through"))).alias("shared_bytes"),
        F.max(F.when(F.col("last"), F.col("on"))).alias("open"))
    old = F.col("head") & (F.col("depth") <= F.col("shared"))
    fixed = (spine.join(F.broadcast(border), F.col("pid") == F.col("at"))
                  .withColumn("saved_tokens", F.col("saved_tokens") + F.when(
                      old, F.col("shared_bytes") - F.col("before")).otherwise(0))
                  .withColumn("n_children", F.col("n_children") - F.when(
                      F.col("head") & (F.col("depth") < F.col("shared")), 1).otherwise(0))
                  .withColumn("n_leaves", F.col("n_leaves") - F.when(F.col("tail") & F.col("open"), 1).otherwise(0)))
    summed = fixed.groupBy(*node).agg(
        F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    ends = (pieces.where("ends is not null").repartition("k1", "k2", "depth").sortWithinPartitions(*node, "pid")
                  .select(*node, "ends").mapInArrow(_streamed, "k1 long, k2 long, depth long, ends_sha256 string"))
    return summed.join(ends, node, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))


def trie(turns: DataFrame, *, group: int = GROUP, head: int = HEAD, task_turns: int = TASK_TURNS) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    spark = turns.sparkSession
    bounded_batches(spark)
    rows = saved(rebuilt(turns, group=group, head=head))
    count = rows.agg(F.sum(F.size("seq") + 1)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // task_turns))
    pieces = saved(rows.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
                       .mapInArrow(_run, _PIECE))
    border = saved(_merged(pieces))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = pieces.where("not (head or tail)")
    # nodes whose parent touches a border learn its smallest member from there
    under = inner.where("up").drop("parent_conv_id").select("p1", "p2", "depth", *[c for c in out if c not in (
        "depth", "parent_conv_id")]).unionByName(border.select("p1", "p2", *[c for c in out if c != "parent_conv_id"]))
    above = border.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    if border.count() <= BROADCAST_ROWS:
        above = F.broadcast(above)
    return inner.where("not up").select(*out).unionByName(under.join(above, ["p1", "p2"], "left").select(*out))
