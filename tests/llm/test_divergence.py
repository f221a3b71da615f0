"""Source divergence against a brute-force count."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sparkprep.llm import divergence as DV
from sparkprep.llm.common import buffers

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string"


def brute(rows, min_docs=10, top=10):
    seen, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        seen[lang].update(set(words))
        count[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= min_docs]
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (count[lang, s][t] + 2) // (total[s] + 2 * len(kept)) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (sum(count[lang, s][t] for s in sources) + 2) // (sum(total.values()) + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(items[:limit])]
    return sorted(out)


def cases(sample):
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "a", "b", "c", "d")[i % 5]) for i, t in sample]
    rows += [(900, None, "en", "empty"), (901, "", "xx", "only"), (902, "1 2 3", "yy", "u"), (903, "word", "yy", "v")]
    rows += [(904, "Große ÉTÉ ÉTÉ größe", "en", "a")] * 12 + [(905, "same " * 20_000, "en", "b")]
    return rows


@pytest.mark.parametrize("block, entries", [(DV.BLOCK_POSTINGS, DV.SHARD_ENTRIES), (300, 50)])
def test_equals_brute_force(spark, sample, block, entries):
    from pyspark.sql import functions as F
    rows = cases(sample[:80])
    df = spark.createDataFrame(rows, DOCS).withColumn("value", F.lit("x")).withColumn("rank", F.lit(1)).repartition(5)
    got = DV.audit(df, block_postings=block, shard_entries=entries)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert [t for _, t in got.dtypes][-2:] == ["bigint", "int"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_tiles_smaller_than_the_sources(spark, sample, monkeypatch):
    monkeypatch.setattr(DV, "TILE", 2)
    monkeypatch.setattr(DV, "MAX_TILES", 2)
    rows = [(i, t, "en", f"s{i % 7}") for i, t in sample[:60]]
    index = DV.frequencies(spark.createDataFrame(rows, DOCS)).toArrow()
    names = sorted({r[3] for r in rows})
    n = {s: 0 for s in names}
    for sources, counts in zip(index["sources"].to_pylist(), index["counts"].to_pylist()):
        for s, c in zip(sources, counts):
            n[s] += c
    groups = {"en": (names, np.array([n[s] for s in names]), index.num_rows)}
    total = Counter()
    for batch in DV._corrections(index.to_batches(), groups):
        for a, b, v in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["value"].to_pylist()):
            total[a, b] += v
    want = {(i, x): v for _, s, part, x, v, _ in brute(rows) if part == "pair" for i in [s]}
    none = DV.share(np.zeros(7, np.int64), groups["en"][1], index.num_rows)
    for (a, b) in ((i, j) for i in range(7) for j in range(i + 1, 7)):
        base = index.num_rows * int(DV.gap(none[a], none[b]))
        assert base + total[a, b] == want[names[a], names[b]]


def test_shares_are_exact():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(0, 4 * 10**15))
        v, c = int(rng.integers(1, 10**9)), int(rng.integers(0, n + 1))
        assert int(DV.share(np.array([c]), n, v)[0]) == 1 + 10**9 * (c + 2) // (n + 2 * v)


def test_terms_end_with_their_text():
    terms, row = DV.terms_of(*buffers(pa.array(["Ab", "Cd", None, "", "é1É"], pa.string())))
    assert list(zip(terms.to_pylist(), row.tolist())) == [("ab", 0), ("cd", 1), ("é", 4), ("É", 4)]


def test_empty_table(spark):
    assert DV.audit(spark.createDataFrame([], DOCS)).count() == 0
