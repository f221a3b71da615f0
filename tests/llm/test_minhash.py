import random
import re

import numpy as np

from sparkprep.llm import minhash as M
from sparkprep.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    w = WORD.findall((text or "").encode().translate(LOW))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                up[root(a)] = root(b)
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(rows)) if root(j) == root(k) and sets[j][0] is not None]
        c = min(ids) if ids else None
        c = i if not s else c
        out.append((i, len(s), c, i == c))
    return sorted(out, key=str)


def run(df, **o):
    return sorted((tuple(r) for r in M.near_duplicates(df, **o).collect()), key=str)


def chains(seed=3):
    """Groups in which neighbours are near and ends are far, copies, and
    texts just under the threshold."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    rows, k = [], 0
    for _ in range(6):
        base = [word() for _ in range(90)]
        for step in range(6):
            text = base[step * 6:] + [word() for _ in range(step * 6)]
            rows.append((k, " ".join(text)))
            k += 1
            if step % 2:
                rows.append((k, " ".join(text).upper()))
                k += 1
    rows += [(k + j, " ".join(word() for _ in range(40))) for j in range(20)]
    rnd.shuffle(rows)
    return rows


def test_chains_match_brute_force(make_docs):
    rows = chains()
    assert run(make_docs(rows)) == brute(rows)


def test_driver_documents(spark, sample):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert run(df) == brute(sample)


def test_edge_rows(make_docs, edge_rows):
    assert run(make_docs(edge_rows)) == brute(edge_rows)


def test_empty_table(make_docs):
    assert run(make_docs([])) == []


def test_one_stays_of_each_group(make_docs):
    rows = chains()
    df = make_docs(rows)
    out = M.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r[0] for r in brute(rows) if r[3])


def test_estimate_follows_similarity():
    rnd = np.random.default_rng(5)
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(30):
            both = rnd.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            rest = int(400 * (1 - share))
            one = np.concatenate([both, rnd.integers(0, 2**63, rest // 2, dtype=np.uint64)])
            two = np.concatenate([both, rnd.integers(0, 2**63, rest // 2, dtype=np.uint64)])
            low = [M.mix(np.array([((x ^ M._XOR[k]) * M._MUL[k]).min() for k in range(M.PERMUTATIONS)])) & np.uint64(15)
                   for x in (one, two)]
            true = len(both) / (len(both) + 2 * (rest // 2))
            errors.append(M.estimate(int((low[0] == low[1]).sum())) - true)
        assert abs(np.mean(errors)) < 0.03


def test_components_of_paths_and_hubs(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(3, 7), (5, 5)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {k: 100 for k in range(100, 161)} | {k: 3 for k in [3, 7, *range(200, 260)]}
    assert got == want


def test_bands_with_several_components_are_compared_across(spark, monkeypatch):
    rnd = np.random.default_rng(9)
    sig = rnd.integers(0, 2**62, 8).tolist()
    other = rnd.integers(0, 2**62, 8).tolist()
    same = " ".join(f"w{k}" for k in range(60))
    texts = [(r, same + (f" x{r}" if r else "")) for r in range(10)] + [(50, same + " y"), (51, same), (52, "a b c d e f")]
    rows = [(1, r, 1, sig) for r in range(10)] + [(1, 50, 50, sig), (1, 51, 51, other), (1, 52, 52, sig)]
    df = spark.createDataFrame(rows, "band long, rep long, component long, sig array<long>")
    t = spark.createDataFrame(texts, "rep long, t string")
    for block in (1024, 3):
        monkeypatch.setattr(M, "BLOCK", block)
        got = {(r["a"], r["b"]) for r in M._across(df, 100, t, 5, (75, 100)).collect()}
        # 51 fails the estimate, 52 the codes
        assert got == {(r, 50) for r in range(10)}


def test_set_by_set_counts_equal_bit_rows():
    rnd = np.random.default_rng(2)
    codes = [np.unique(rnd.integers(0, 300, 80).astype(np.uint32)) for _ in range(20)]
    fast = M._shared(codes)
    for k in range(19):
        at = np.arange(k + 1, 20)
        assert fast(k, at).tolist() == [len(np.intersect1d(codes[k], codes[j])) for j in at]


def test_ids_with_several_texts_and_null_ids(make_docs):
    a, b = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = [(1, a), (None, a), (2, a), (2, b), (3, b), (4, b), (4, b), (4, b + " end"), (None, "c d e f g h"), (None, ""), (7, None)]
    df = make_docs(rows)
    assert run(df) == brute(rows)
    out = M.drop_near_duplicates(df)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (None, "c d e f g h"), (None, ""), (7, None)], key=str)


def test_rows_that_repeat_stay_once(make_docs):
    a = " ".join(f"a{k}" for k in range(30))
    assert [(r["doc_id"], r["text"]) for r in M.drop_near_duplicates(make_docs([(5, a), (5, a), (6, a)])).collect()] == [(5, a)]
    assert M.drop_near_duplicates(make_docs([(None, a), (None, a)])).count() == 1


def test_sets_that_collide_in_32_bits_are_not_lost(make_docs, monkeypatch):
    import pyarrow as pa
    high = np.uint64(7 << 32)
    one = np.sort(np.array([high + np.uint64(k) for k in (1, 2)] + [1 << 40, 1 << 41], np.uint64))
    two = np.sort(np.append(one[:3], np.uint64(1 << 50)))
    three = np.sort(np.append(one[:1], np.array([1 << 51, 1 << 52, 1 << 53], np.uint64)))
    codes = [np.unique((x >> np.uint64(32)).astype(np.uint32)).tobytes() for x in (one, two, three)]
    table = pa.table({"rep": [1, 2, 3], "component": [1, 2, 3], "sig": [[0] * 8] * 3, "n": [4, 4, 4],
                      "codes": pa.array(codes, pa.binary())})
    # 3 of 5 shared reach 60 in 100, though only 2 codes are; 1 of 7 does not
    assert M._compare(table, 1, (60, 100)).to_pylist() == [{"a": 1, "b": 2}]
