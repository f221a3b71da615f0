"""SentencePiece through the distinct-chunk table against the library."""

import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkprep.llm import sentencepieces as SP
from sparkprep.llm.common import buffers
from sparkprep.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def model():
    return SP.read_model(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


ODD = [(20, " "), (21, "  "), (22, "a "), (23, " a"), (24, "  a  b "), (25, "▁x ▁ y▁"), (26, "é ﬁ ½ 漢字 \U0001f600"),
       (27, "tab\there\r\nnew \n line"), (28, "\x00 nul"), (29, "<s> </s> <0x41>"), (30, "x" * 9000),
       (31, "the " * 5000 + " "), (32, "�� ﻿a　b\xa0c")]


def expected(library, rows):
    out = []
    for i, t in rows:
        ids = library.encode(t or "")
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [SP.BLOCK_BYTES, 500])
def test_equals_the_library(spark, make_docs, sample, edge_rows, model, library, block_bytes):
    rows = sample[:60] + edge_rows + ODD
    got = SP.digest(make_docs(rows).repartition(3), model, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(library, rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é▁\n漢 ", max_size=12), max_size=6))
def test_chunks_rebuild_the_marked_text(texts):
    import pyarrow as pa
    texts = [t.replace("▁", " ") for t in texts]
    chunks, counts = SP.chunks_of(*buffers(pa.array(texts, pa.string())))
    got, k = chunks.to_pylist(), 0
    for t, n in zip(texts, counts):
        assert "".join("▁" + c.replace(" ", "▁") for c in got[k:k + n]) == ("▁" + t.replace(" ", "▁") if t else "")
        k += n
    assert k == len(got)


def test_ids_of_any_type_and_empty_table(spark, model, library):
    df = spark.createDataFrame([("a", "one two"), ("a", "one two"), (None, None)], "name string, body string")
    got = SP.decode(SP.encode(df, model, id_col="name", text_col="body"), model).collect()
    ids = library.encode("one two")
    assert sorted((r["name"] or "", r["ids"], r["decoded"]) for r in got) == [("", [], ""), ("a", ids, "one two"),
                                                                          ("a", ids, "one two")]
    assert SP.digest(df.limit(0), model, id_col="name", text_col="body").count() == 0


def test_a_frequent_word_is_one_entry_of_a_list(model):
    import pyarrow as pa
    text = pa.array(["the " * 1000, "the end"])
    batch = next(SP._block(pa.array([1, 2]), text, 0, 4, pa.int64()))
    lists = [SP._strings(*SP._unpack(b.as_py())[:2]).to_pylist() for b, s in zip(batch["blob"], batch["shard"]) if s.as_py() >= 0]
    assert sorted(x for names in lists for x in names) == ["", "end", "the"]


def test_models_that_cannot_be_cut_are_refused(tmp_path, monkeypatch):
    class Crossing:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    monkeypatch.setattr(SP, "_processor", lambda model: Crossing())
    with pytest.raises(ValueError, match="crosses"):
        SP.read_model(PATH)


def test_gather_takes_ranges():
    flat = np.arange(10)
    assert SP._gather(flat, np.array([7, 0, 3]), np.array([2, 0, 3])).tolist() == [7, 8, 3, 4, 5]


def test_a_changed_order_is_noticed(model):
    import pyarrow as pa
    one, two = (pa.Table.from_batches(list(SP._block(pa.array([1, 2]), pa.array(t), 0, 4, pa.int64())))
                for t in (["a b", "c d e"], ["c d e", "a b"]))
    answers = pa.Table.from_batches(list(SP._answered(two.slice(1).to_batches(), model)))
    with pytest.raises(RuntimeError, match="another order"):
        SP._joined(one.slice(0, 1), answers)


def test_digest_hands_the_jvm_hashes_only(spark, make_docs, model):
    plan = SP.digest(make_docs([(1, "one two")]), model)._jdf.queryExecution().executedPlan().toString()
    assert "concat_ws" not in plan and "decoded#" not in plan and "ids#" not in plan.split("FlatMapCoGroupsInArrow")[0]
