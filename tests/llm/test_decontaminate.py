import hashlib
import re

from sparkprep.llm import decontaminate as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return WORD.findall((text or "").encode().translate(LOW))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = [0] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                got = windows.get(tuple(w[k:k + n]))
                if got:
                    found |= got
                    hit[k:k + n] = [1] * n
        names = ",".join(sorted("" if i is None else str(i) for i in found))
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
                    sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out, key=str)


COLS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def run(docs, bench, **o):
    return sorted((tuple(r) for r in D.digest(D.matches(docs, bench, **o)).select(*COLS).collect()), key=str)


ITEMS = [(1, "Alpha beta, gamma!"), (2, None), (3, ""), (4, " ".join(f"w{k}" for k in range(20))),
         (4, " ".join(f"w{k}" for k in range(20))), (5, "éa éb " * 8), (6, "the the the the the the the the the the the the the the")]


def make_texts():
    long = " ".join(f"w{k}" for k in range(20))
    return [(1, "x ALPHA beta gamma y"), (2, long), (3, f"{long[:30]} {long}"), (4, None), (5, ""), (6, "the " * 60),
            (7, "éa éb " * 9), (8, "clean words " * 40), (8, "clean words " * 40), (None, "alpha-beta.gamma"),
            (9, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 q w12 w13"), (10, "z " * 2000 + long)]


def test_matches_brute_force(spark, make_docs):
    docs = make_texts()
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert run(make_docs(docs), bench) == brute(docs, ITEMS)


def test_parts_of_a_large_benchmark_give_the_same(spark, make_docs):
    docs = make_texts() + [(8, "alpha beta gamma")]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert run(make_docs(docs), bench, max_broadcast_bytes=200) == brute(docs, ITEMS)


def test_driver_tables(spark, sample):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    assert run(docs, bench) == brute(sample, items)


def test_filter_keeps_columns_and_clean_rows(spark, make_docs):
    docs = make_docs(make_texts())
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    bad = sorted((r[0] for r in brute(make_texts(), ITEMS) if r[5]), key=str)
    for bound in (1 << 25, 200):
        out = D.decontaminate(docs, bench, max_broadcast_bytes=bound)
        assert out.columns == docs.columns
        left = [r["doc_id"] for r in out.collect()]
        assert sorted(left, key=str) == sorted((d for d, _ in make_texts() if d not in bad), key=str)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = make_texts()
    assert run(make_docs(docs), none) == brute(docs, [])
    assert D.digest(D.matches(make_docs([]), none)).count() == 0


def test_longest_match_and_place(spark, make_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: r for r in D.digest(D.matches(make_docs(make_texts()), bench)).collect()}
    assert (got[10]["longest"], got[10]["longest_at"], got[10]["longest_item"]) == (20, 2000, "4")
    assert got[8]["longest"] == 0 and got[8]["longest_item"] is None


def test_ids_of_other_types(spark):
    from sparkprep.llm import decontaminate as D
    item = spark.createDataFrame([("b", " ".join(f"w{k}" for k in range(14)))], "item_id string, text string")
    for kind, value in (("smallint", 3), ("double", 3.5), ("decimal(9,0)", None), ("date", None)):
        df = spark.createDataFrame([(value, "x " + " ".join(f"w{k}" for k in range(14)))], f"doc_id {kind}, text string")
        got = D.digest(D.matches(df, item)).collect()
        assert [(r["doc_id"], r["n_hit"], r["contaminated"]) for r in got] == [(value, 14, True)]
