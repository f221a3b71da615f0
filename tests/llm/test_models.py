"""Quality classifier and toxicity grammar."""
import random
import zlib

import numpy as np
import pytest

from sparkprep.llm import quality as Q
from sparkprep.llm import toxicity as T


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def corpus(n=600, seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("aeioudlmnrst") for _ in range(rnd.randint(2, 8)))
    rows, quality, toxic = [], [], []
    for k in range(n):
        words = [word() for _ in range(rnd.randint(5, 120))]
        bad = rnd.random() < .25
        if bad:
            kind = rnd.randint(0, 2)
            words = ([w + "$$$" for w in words] if kind == 0 else [w for w in words[:9] for _ in range(9)] if kind == 1
                     else [w.upper() + "!!" for w in words])
        mean = rnd.random() < .3
        if mean:
            for _ in range(rnd.randint(1, 3)):
                words.insert(rnd.randint(0, len(words)), rnd.choice(["moron", "zorgal", "zorgit"]))
        rows.append((k, " ".join(words)))
        quality.append(int(not bad))
        toxic.append(int(mean))
    return rows, quality, toxic


@pytest.fixture(scope="module")
def data(spark, make_docs):
    rows, quality, toxic = corpus()
    labels = spark.createDataFrame([(i, q, t) for (i, _), q, t in zip(rows, quality, toxic)],
                                   "doc_id long, quality int, toxic int")
    return make_docs(rows), labels, dict(enumerate(quality)), dict(enumerate(toxic))


def test_sum_of_squares_identity():
    rnd = np.random.default_rng(1)
    m = Q.Machine(0.3, rnd.normal(size=Q.WIDTH), rnd.normal(size=(Q.WIDTH, 4)))
    idx, val = np.array([3, 9, 40, 7, 8]), np.array([.5, -1., 2., .1, .7])
    got = m.raw(np.array([0, 3, 5]), idx, val)
    for row, want in zip((slice(0, 3), slice(3, 5)), got):
        j, x = idx[row], val[row]
        y = m.w0 + (m.w[j] * x).sum() + sum((m.v[j[a]] @ m.v[j[b]]) * x[a] * x[b]
                                            for a in range(len(j)) for b in range(a))
        assert abs(y - want) < 1e-9


def test_features_do_not_depend_on_the_slice():
    rows, _, _ = corpus(40)
    texts = [t.encode() for _, t in rows] + [b""]
    offs = np.r_[0, np.cumsum([len(t) for t in texts])]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds, idx, val = Q.features(data, offs)
    for k, t in enumerate(texts):
        b1, i1, v1 = Q.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        a, b = bounds[k], bounds[k + 1]
        assert sorted(zip(i1, v1.round(9))) == sorted(zip(idx[a:b], val[a:b].round(9)))


def test_quality_held_out_accuracy(data):
    docs, labels, truth, _ = data
    out = Q.score_documents(docs, Q.train(docs, labels)).collect()
    assert len(out) == len(truth)
    assert all(r["held_out"] == is_held(r["doc_id"]) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    unseen = [r for r in out if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in unseen]) > 0.97


def test_held_out_labels_are_never_read(spark, data):
    docs, labels, _, _ = data
    from pyspark.sql import functions as F
    from sparkprep.llm.common import held_out
    twisted = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
                                ).withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = Q.train(docs, labels), Q.train(docs, twisted)
    assert np.array_equal(one.w, two.w) and np.array_equal(one.v, two.v)
    a, b = T.train(docs, labels), T.train(docs, twisted)
    assert a.lexicon.stems == b.lexicon.stems and np.array_equal(a.weights, b.weights)


def test_accept_keeps_columns(data):
    docs, labels, truth, _ = data
    m = Q.train(docs, labels)
    out = Q.accept(docs, m)
    assert out.columns == docs.columns
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in Q.score_documents(docs, m).collect() if r["predicted"] == 1}


def test_edge_rows(spark, make_docs, edge_rows, data):
    docs, labels, _, _ = data
    edge = make_docs(edge_rows)
    for module, model in ((Q, Q.train(docs, labels)), (T, T.train(docs, labels))):
        out = module.score_documents(edge, model).collect()
        assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in edge_rows)
        assert all(0 <= r["score"] <= 1 for r in out)
        assert module.score_documents(make_docs([]), model).count() == 0


def test_without_labels(spark, make_docs):
    docs = make_docs([(1, "some words here"), (2, "you are a moron"), (3, None)])
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in Q.score_documents(docs, Q.train(docs, none)).collect()} == {0.5}
    got = {r["doc_id"]: r["predicted"] for r in T.score_documents(docs, T.train(docs, none)).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_toxicity_held_out_accuracy(data):
    docs, labels, _, truth = data
    g = T.train(docs, labels)
    assert any("zorgal".startswith(s) for s in g.lexicon.stems)  # learned, not listed
    out = T.score_documents(docs, g).collect()
    assert all(r["held_out"] == is_held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in out if r["held_out"]]) > 0.97


def test_clauses():
    lex = T.Lexicon(T.INSULTS)
    kind = lambda t: [int(k) for k in np.flatnonzero(T.clause_counts(t, lex))]
    directed, negated, reported, threat = 4, 2, 1, 8
    assert kind("the weather is fine. you are here") == []
    assert kind("a moron wrote it") == [0]
    assert kind("you stupid moron") == [directed]
    assert kind("he is not stupid") == [directed + negated]
    assert kind("she said that he is stupid") == [directed + reported]
    assert kind('the word "idiot" is old') == [reported]
    assert kind("i will kill the process") == [threat]
    assert kind("i will kill you") == [threat + directed]
    assert kind("how to kill a process") == []
    assert kind("not here. moron") == [0]  # a negation ends with its clause


def test_default_weights_rank_clause_types():
    g = T.Grammar(T.Lexicon(T.INSULTS), *T.default_weights())
    s = [g.score(t) for t in ("fine words", "he is not a moron", "a moron is here", "you moron")]
    assert s == sorted(s) and s[0] < 0.3 < s[2]


def plain_types(symbols):
    """Clause types by looking at every word's surroundings."""
    out, quoted, said = [], False, False
    for k, x in enumerate(symbols):
        if x == T.QUOTE:
            quoted, said = not quoted, False
        elif x == T.REPORT and not quoted:
            said = True
        near = lambda c, lo, hi: int(c in symbols[max(0, lo):hi + 1])
        directed = near(T.TARGET, k - T.REACH, k + T.REACH)
        if x in (T.INSULT, T.WEAK) or (x == T.THREAT and (directed or near(T.WILL, k - T.REACH, k))):
            out.append(T.CORES[x] * 8 + 4 * directed + 2 * near(T.NEGATION, k - T.REACH, k) + int(quoted or said))
    return out


def test_the_composed_machine_equals_a_plain_reading():
    rnd = random.Random(4)
    for _ in range(3000):
        symbols = [rnd.choice([T.OTHER] * 4 + list(range(T.CLASSES))) for _ in range(rnd.randint(0, 25))]
        assert T.clause_types(symbols) == plain_types(symbols)
    assert 100 < len(T.MOVE) <= (T.REACH + 1) ** 3 * 3  # one product of all four parts


def test_negated_and_reported_clauses_change_predictions(spark, make_docs):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("bcdfgaeiou") for _ in range(6))
    rows, toxic = [], []
    for k in range(300):
        said = ["he is a moron here", "you are an idiot now", "they are not a moron now", "she said that he is an idiot",
                'the word "moron" is old', "fine words only"][k % 6]
        rows.append((k, f"{word()} {word()}. {said}. {word()} {word()}"))
        toxic.append(int(k % 6 < 2))
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    g = T.train(make_docs(rows), labels)
    got = {r["doc_id"]: r["predicted"] for r in T.score_documents(make_docs(rows), g).collect()}
    assert got == dict(enumerate(toxic))  # the rule "any insult" has 150 of them wrong
    for text in ("You are not an idiot.", "He said that you are an idiot.", "Nobody is worthless.", 'Never say "moron".'):
        assert g.score(text) < 0.3 and g.score(text) <= g.score("a text without a match")
    assert g.score("You are an idiot.") >= max(0.3, g.score("an idiot"))
    assert g.score("You are not an idiot. You are an idiot.") <= g.score("You are an idiot.")


def test_weak_insults_tell_by_their_number():
    g = T.Grammar(T.Lexicon(T.INSULTS + ["zorg@2"]), *T.default_weights())
    assert g.score("a zorgal here") < 0.3 <= g.score("a zorgal here. a zorgit there")
    assert g.score("not a zorgal here. no zorgit there") < 0.3


def test_repeated_label_rows(spark, make_docs):
    rows = [(k, "a moron" if k % 3 == 0 else "fine words") for k in range(60)]
    once = [(k, k % 3 == 0) for k in range(60)]
    frame = lambda r: spark.createDataFrame([(k, int(t), int(not t)) for k, t in r], "doc_id long, toxic int, quality int")
    for labels in (frame(once), frame(once * 2), frame(once + [(5, True)])):
        docs = make_docs(rows + rows[:10])
        for module in (T, Q):
            out = module.score_documents(docs, module.train(docs, labels)).collect()
            assert len(out) == 70 and all(0 <= r["score"] <= 1 for r in out)
