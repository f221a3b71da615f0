import corpus_pipeline as C
import pytest

import __spark_entry__ as entry
from sparkprep.llm import queries


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {q[:q.index("_") + 1] for q in names if q.startswith("op")}
    assert "pipeline" in names and set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.fixture(scope="module")
def stages(spark):
    sf = "/root/testdata/sf0.001"
    docs, out = C.table(spark, sf, "documents"), []
    for name, stage in C.STAGES:
        nxt = C.saved(stage(spark, docs, sf))
        out.append((name, docs, nxt))
        docs = nxt
    return sf, out


def test_stages_follow_their_operators(spark, stages):
    sf, steps = stages
    by = {name: (a, b) for name, a, b in steps}
    assert [name for name, _, _ in steps] == ["quality_filter", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, a, b in steps[:-1]:
        assert b.columns == a.columns
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    rows = lambda df: sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())

    from tests.llm import test_decontaminate as td
    from tests.llm import test_minhash as tm
    a, b = by["line_dedup"]
    assert ids(a) == ids(b)
    a, b = by["near_dedup"]
    assert ids(b) == sorted(r[0] for r in tm.brute(rows(a)) if r[3])
    a, b = by["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(sf + "/benchmark.parquet").collect()]
    assert ids(b) == sorted(r[0] for r in td.brute(rows(a), items) if not r[5])
    a, b = by["packing"]
    assert ids(a) == sorted({r["doc_id"] for r in b.collect()})


def test_run_equals_the_stages(spark, stages):
    sf, steps = stages
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert key(C.run(spark, sf)) == key(steps[-1][2])
