"""The prefix trie against a brute-force one."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sparkprep.llm import prefix_trie as PT

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows, group=5, head=9):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    nodes = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % head
        seq = own.get(c - int(np.fmod(c, group)), [])[:h] + own[c][h:]
        for d in range(len(seq) + 1):
            nodes[tuple(seq[:d])].append((c, len(seq)))
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    leaves, tokens = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        here = (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        tokens[p] = here + sum(tokens[k] for k in kids[p])
    out = []
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c, n in members if n == len(p))))
        out.append((min(members)[0], len(p), min(nodes[p[:-1]])[0] if p else None, len(members), len(kids[p]), leaves[p],
                    tokens[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **options):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, TURNS)
    for name in ("seq", "depth", "k1", "ends"):
        df = df.withColumn(name, F.lit("x"))
    got = PT.trie(df.repartition(3), **options)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    assert {t for _, t in got.dtypes[:-1]} == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def shared(n, seed):
    """Conversations over few texts, with copies, so that they share much."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.4:
            turns = [("user", "hi"), ("assistant", "hello é")] * 2
        else:
            turns = [(("user", "assistant")[k % 2], f"t{rng.integers(0, 3)}") for k in range(rng.integers(1, 12))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("task_turns", [PT.TASK_TURNS, 40])
def test_driver_table(spark, task_turns):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    check(spark, rows, task_turns=task_turns)


@pytest.mark.parametrize("seed, task_turns", [(1, 10**6), (2, 60), (3, 15)])
def test_shared_prefixes_across_borders(spark, seed, task_turns):
    check(spark, shared(120, seed), task_turns=task_turns)


def test_copies_only(spark):
    rows = [(c, k, "user", f"t{k}") for c in range(0, 300) for k in range(3)]
    check(spark, rows, task_turns=50)


def test_edges(spark):
    rows = [(None, 0, "user", "no id"), (0, None, None, None), (0, 0, "user", ""), (0, 1, "user", "x" * 100_000),
            (1, 5, "user", "only"), (7, 0, "user", "base absent"), (12, 0, "a", "b"), (12, 0, "a", "b"), (12, 1, None, "c"),
            (-3, 0, "user", "negative"), (-5, 0, "user", "negative base"), (2**40, 0, "user", "large")]
    rows += [(20, k, "user", f"long {k}") for k in range(3000)]
    check(spark, rows, task_turns=100)
    check(spark, rows[1:2], task_turns=100)
    assert PT.trie(spark.createDataFrame([], TURNS)).count() == 0


def test_all_turnless(spark):
    # their base is absent and they are shorter than their heads: the root is a leaf
    ids = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1]
    check(spark, [(c, 0, "user", "x") for c in ids], task_turns=20)


def test_range_minimum():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 64, 100):
        v = rng.integers(0, 5, n)
        t = PT.RangeMinimum(v)
        a = rng.integers(0, n, 200)
        b = np.minimum(n - 1, a + rng.integers(0, n, 200))
        bound = rng.integers(0, 6, 200)
        assert t.least(a, b).tolist() == [v[x:y + 1].min() for x, y in zip(a, b)]
        assert t.right(a, bound).tolist() == [next((k for k in range(x, n) if v[k] < q), n) for x, q in zip(a, bound)]
        assert t.left(a, bound).tolist() == [next((k for k in range(x, -1, -1) if v[k] < q), -1) for x, q in zip(a, bound)]
