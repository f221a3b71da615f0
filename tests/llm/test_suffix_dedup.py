import hashlib
import random

import numpy as np

from sparkprep.llm import suffix_dedup as S


def brute(rows):
    docs = sorted({(-(1 << 63) if i is None else i, (t or "").encode(), i) for i, t in rows}, key=lambda r: r[:2])
    seen, out = set(), {}
    for _, b, i in docs:
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            k = b[s:s + 100]
            if k in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(k)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for x in range(len(b)) if gone[x] and (x == 0 or not gone[x - 1]))
        out[i, b] = (i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted((out[i, (t or "").encode()] for i, t in rows), key=str)


def run(df, **o):
    return sorted((tuple(r) for r in S.digest(df, **o).collect()), key=str)


def texts(seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(30) for _ in range(4)]
    rows = []
    for k in range(60):
        parts = [prose(rnd.randint(0, 40)) for _ in range(3)]
        parts.insert(rnd.randint(0, 3), rnd.choice(shared)[rnd.randint(0, 20):])
        rows.append((k * 3, rnd.choice(["\n", "", " "]).join(parts)))
    rows += [(500, rows[3][1]), (1, rows[9][1]), (501, "ab" * 400), (502, "x" + "ab" * 150), (503, shared[0] + shared[1]),
             (504, shared[1][:99]), (505, shared[1][5:105])]
    return rows


def test_brute_force(make_docs):
    rows = texts()
    assert run(make_docs(rows)) == brute(rows)


def test_small_buckets_cut_hot_suffixes(make_docs):
    rows = texts(2)
    base = rows[5][1]
    rows += [(1000 + k, f"{k} {base[:200 + k]}") for k in range(40)]
    assert run(make_docs(rows), bucket_rows=40) == brute(rows)


def test_edge_rows(make_docs, edge_rows):
    assert run(make_docs(edge_rows)) == brute(edge_rows)


def test_empty_table(make_docs):
    assert run(make_docs([])) == []


def test_driver_documents(spark, sample):
    assert run(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")) == brute(sample)


def test_multikey_quicksort_and_prefixes():
    rnd = np.random.default_rng(4)
    rows = rnd.integers(97, 99, (300, 30)).astype(np.uint8)
    rows[100:200, :20] = rows[0, :20]
    order = S.multikey_quicksort(S._words(rows))
    plain = [r.tobytes() for r in rows]
    assert [plain[k] for k in order] == sorted(plain)
    lcp = S.common_prefixes(S._words(rows), order)
    for n, (a, b) in zip(lcp, zip(order[:-1], order[1:])):
        true = next((k for k in range(30) if plain[a][k] != plain[b][k]), 32)
        assert n == true


def hot_line(n=300, line=40):
    """Unique texts around a line shorter than 100 bytes; a few repeat more."""
    rnd = random.Random(7)
    junk = lambda k: "".join(rnd.choice("abcdefghij ") for _ in range(k))
    hot = junk(line)
    rows = [(k, junk(150) + hot + junk(150)) for k in range(n)]
    rows += [(n + k, junk(9) + rows[k * 7][1][90:260] + junk(9)) for k in range(20)]
    return rows


def test_hot_line_between_unique_texts(make_docs):
    for line in (40, 99):
        rows = hot_line(line=line)
        assert run(make_docs(rows), bucket_rows=20) == brute(rows)


def test_border_strings_of_a_hot_line_spread_over_all_parts():
    import pyarrow as pa
    rows = hot_line()
    data = [t.encode() for _, t in rows]
    anchors = S.Anchors(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(b) for b in data]), 100, 24)
    start = np.cumsum([0] + [len(b) for b in data])
    wanted = [[int(p - start[r]) for p in anchors.pos[anchors.row == r]] for r in range(len(rows))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in rows]), pa.array(data, pa.binary()), pa.array([0] * len(rows), pa.int64()),
         pa.array(wanted, pa.list_(pa.int32()))], names=["doc", "text", "chk", "at"])
    kept = list(S._kept_suffixes([batch], 100, 24))
    keys = np.sort(np.concatenate([S._keys(s.right, s.doc, s.pos, 24) for s in kept]))
    cuts = keys[::40][1:]
    buckets = list(S._deal_suffixes([batch], cuts, 100, 24))
    leads = frozenset(bytes(c)[:24] for c in cuts)
    found = [b for b in S._resolve(buckets, leads, 100, 24) if b.num_rows and b.column("z")[0].as_py()]
    border = [pa.RecordBatch.from_arrays([b.column("n"), b.column("z")], names=["n", "z"]) for b in found]
    dealt = list(S._deal_strings(border, 100, 24, 8))
    size = np.zeros(8, int)
    for b in dealt:
        np.add.at(size, b.column("part").to_numpy(), b.column("n").to_numpy())
    assert sum(x.column("strings")[0].as_py() for x in found) == size.sum() > 5000
    assert size.max() < 1.3 * size.mean()


def test_a_splitter_tells_positions_of_one_document_apart():
    same = np.tile(np.frombuffer(b"x" * 100, np.uint8), (3, 1))
    keys = S._keys(same, np.array([4, 4, 4]), np.array([10, 300, 70000]), 24)
    assert keys[0] < keys[1] < keys[2]


def test_buckets_follow_the_rows(make_docs, sample, monkeypatch):
    """As many buckets as the rows ask for, none much larger than asked."""
    import numpy as np
    seen = {}
    plain, resolve = S._splitters, S._deal_suffixes

    def splitters(source, wanted, buckets, rows, length, gram):
        cuts, lead = plain(source, wanted, buckets, rows, length, gram)
        sizes = source.join(wanted, "doc").select("doc", "text", "chk", "at").mapInArrow(
            lambda it: resolve(it, cuts, length, gram), "part int, n int, z binary").groupBy("part").sum("n").toPandas()
        seen.update(asked=buckets, got=len(cuts) + 1, largest=int(sizes.iloc[:, 1].max()))
        return cuts, lead

    monkeypatch.setattr(S, "_splitters", splitters)
    rows = [(i, t) for i, t in sample]
    got = S.digest(make_docs(rows), bucket_rows=20).count()
    assert got == len(rows)
    assert seen["asked"] > 50 and seen["got"] >= 0.9 * seen["asked"]
    assert seen["largest"] <= 8 * 20
