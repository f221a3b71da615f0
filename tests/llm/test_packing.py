import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from sparkprep.llm import packing as P


def padding(bounds, lengths, counts):
    return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts))


def test_bounds_are_optimal():
    rnd = random.Random(1)
    for _ in range(200):
        m = rnd.randint(1, 7)
        x = rnd.sample(range(1, 40), m)
        c = [rnd.randint(1, 9) for _ in x]
        k = rnd.randint(1, 5)
        bounds, total = P.best_bounds(x, c, k)
        best = min(padding(b, x, c) for r in range(1, min(k, m) + 1) for b in itertools.combinations(x, r)
                   if max(b) == max(x))
        assert padding(bounds, x, c) == total == best and len(bounds) <= k


def check(rows, got, max_len, buckets, budget):
    want = {}
    for i, t in rows:
        n = len(re.findall(r"[^\W_]+|[^\w\s]|_", t or ""))
        want.setdefault(i, []).append(n)
    have = {}
    for r in got:
        if r["piece"] == 0:
            have.setdefault(r["doc_id"], [])
    pieces = sorted((str(r["doc_id"]), r["piece"], r["first_token"], r["n_tokens"]) for r in got)
    plain = sorted((str(i), k, k * max_len, min(max_len, n - k * max_len))
                   for i, ns in want.items() for n in ns for k in range(max(1, -(-n // max_len))))
    assert pieces == plain
    full = [r for r in got if r["n_tokens"] > 0]
    assert all(r["bucket"] is None for r in got if r["n_tokens"] == 0)
    lengths = sorted({r["n_tokens"] for r in full})
    counts = [sum(r["n_tokens"] == x for r in full) for x in lengths]
    bounds, total = P.best_bounds(lengths, counts, buckets)
    assert sum(r["bucket_len"] - r["n_tokens"] for r in full) == total
    assert all(r["bucket_len"] == bounds[r["bucket"]] == min(b for b in bounds if b >= r["n_tokens"]) for r in full)
    for b, bound in enumerate(bounds):
        mine = sorted((r["batch"], r["slot"]) for r in full if r["bucket"] == b)
        per = budget // bound
        assert mine == [divmod(k, per) for k in range(len(mine))]
        order = [r["doc_id"] for r in sorted((r for r in full if r["bucket"] == b), key=lambda r: (r["batch"], r["slot"]))
                 if r["doc_id"] is not None]
        assert order == sorted(order)


def test_packing_matches_brute_force(make_docs, edge_rows, sample):
    rnd = random.Random(3)
    made = [(k, "word, " * rnd.randint(0, 60)) for k in range(200)]
    for rows, opt in ((made, (50, 4, 200)), (edge_rows, (64, 3, 256)), (sample, (2048, 16, 65536))):
        got = P.pack(make_docs(rows).repartition(5), max_len=opt[0], buckets=opt[1], batch_tokens=opt[2]).collect()
        check(rows, got, *opt)
    assert P.pack(make_docs([])).count() == 0


def test_length_column(make_docs):
    df = make_docs([(1, "a"), (2, "b"), (3, "c")]).withColumn("len", F.when(F.col("doc_id") < 3, F.col("doc_id") * 5 - 6))
    got = {r["doc_id"]: r["n_tokens"] for r in P.pack(df, length_col="len", max_len=10, batch_tokens=20).collect()}
    assert got == {1: 0, 2: 4, 3: 0}
    with pytest.raises(ValueError):
        P.pack(df, max_len=30, batch_tokens=20)
