"""Queries: text, index, retrieval, sequences, HTML (2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stems as ST
from ..functions import text as T
from ..operators import html as H
from ..operators import index as IX
from ..operators import nearest as NQ
from ..operators import retrieval as R
from ..operators import sequences as SQ
from ..operators import simjoin as SJ
from ..operators import text as TX
from ..operators.encoding import label_index
from ..operators.ordering import global_rank
from ..operators.sampling import split_hash
from ..session import cut_lineage
from ..sources.tables import load, spread
from .common import rounded, sig_round, sig_round_sql
from .registry import query


def _q(s: str) -> str:
    return s.replace("'", "''")


def _values(words) -> str:
    return "(VALUES " + ", ".join(f"('{_q(w)}')" for w in words) + ")"


WORD_RE = T.WORD_OR_PUNCT
VEC_RE = T.WORD2
STOPS_SQL = _values(TX.ENGLISH_STOP_WORDS)
STOP_PUNCT_SQL = _values(TX.ENGLISH_STOP_WORDS + TX.PUNCTUATION)

_WORD_TOKENS_SQL = f"""
wt AS (SELECT doc_id, unnest(regexp_extract_all(text, '{WORD_RE}')) AS token FROM documents)
"""
_VEC_TOKENS_SQL = f"""
vt AS (SELECT doc_id, unnest(range(len(arr))) AS pos, unnest(arr) AS token
       FROM (SELECT doc_id, regexp_extract_all(lower(text), '{VEC_RE}') AS arr FROM documents))
"""
_CLEAN_TOKENS_SQL = r"""
ct AS (SELECT doc_id, token FROM (
         SELECT doc_id, unnest(string_split_regex(regexp_replace(lower(regexp_replace(text,
                  '[^\x00-\x7F]', '', 'g')), '[!-/:-@\[-`{-~]', '', 'g'), '\s+')) AS token
         FROM documents)
       WHERE token <> '' AND token NOT IN (SELECT * FROM """ + STOPS_SQL + """))
"""


def _docs(spark, sf):
    return load(spark, sf, "documents")


def _text_table(spark, sf, table, cols):
    """Only the needed columns, spread over all task slots before the
    regex work (see ``tables.spread``)."""
    return spread(load(spark, sf, table).select(*cols))


def word_token_rows(spark, sf):
    docs = _text_table(spark, sf, "documents", ["doc_id", "text"])
    return TX.explode_tokens(docs, "doc_id", T.word_tokens(F.col("text")))


def word_token_lists(spark, sf):
    return _text_table(spark, sf, "documents", ["doc_id", "text"]).select("doc_id", T.word_tokens(F.col("text")).alias("token"))


def vec_token_lists(spark, sf):
    return _text_table(spark, sf, "documents", ["doc_id", "text"]).select(
        "doc_id", T.vectorizer_tokens(F.col("text")).alias("token"))


def vec_token_rows(spark, sf, table="documents", keys=("doc_id",), text="text"):
    df = _text_table(spark, sf, table, [*keys, text])
    return df.select(*keys, F.posexplode(T.vectorizer_tokens(F.col(text))).alias("pos", "token"))


@query("sent_split", r"""
SELECT doc_id, CAST(unnest(range(len(arr))) AS INTEGER) AS sent_idx, unnest(arr) AS sentence
FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)) AS arr
      FROM documents)
""")
def q_sent_split(spark, sf):
    return TX.sentence_rows(_text_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")


@query("word_tokenize", "WITH " + _WORD_TOKENS_SQL + "SELECT token, count(*) AS n FROM wt GROUP BY token")
def q_word_tokenize(spark, sf):
    return TX.token_counts(word_token_rows(spark, sf))


@query("top_tokens", "WITH " + _WORD_TOKENS_SQL +
       "SELECT token, count(*) AS n FROM wt GROUP BY token ORDER BY n DESC, token LIMIT 10")
def q_top_tokens(spark, sf):
    return TX.top_tokens(word_token_rows(spark, sf), 10)


@query("stop_punct_filter", "WITH " + _WORD_TOKENS_SQL + f"""
SELECT token, count(*) AS n FROM wt WHERE token NOT IN (SELECT * FROM {STOP_PUNCT_SQL}) GROUP BY token
""")
def q_stop_punct_filter(spark, sf):
    return TX.token_counts(TX.stop_punct_filter(word_token_rows(spark, sf)))


@query("tokenise_clean", "WITH " + _CLEAN_TOKENS_SQL + "SELECT token, count(*) AS n FROM ct GROUP BY token")
def q_tokenise_clean(spark, sf):
    return TX.token_counts(TX.clean_token_rows(_text_table(spark, sf, "documents", ["doc_id", "text"]),
                                               "doc_id", "text"))


@query("stem_vocab", "WITH " + _CLEAN_TOKENS_SQL + f"""
SELECT CASE WHEN length(token) < {TX.STEM_MIN_LEN} THEN token
            ELSE regexp_replace(token, '{TX.STEM_SUFFIXES}', '', 'g') END AS stem, count(*) AS n
FROM ct GROUP BY 1
""")
def q_stem_vocab(spark, sf):
    return TX.stem_counts(TX.clean_token_rows(_text_table(spark, sf, "documents", ["doc_id", "text"]),
                                              "doc_id", "text"))


def _stems(spark, sf, stem):
    """Counts by stem: the distinct words are stemmed, not their occurrences."""
    vocab = TX.token_counts(TX.clean_token_rows(_text_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text"))
    return stem(vocab, "token").groupBy("stem").agg(F.sum("n").alias("n"))


@query("stem_porter")
def q_stem_porter(spark, sf):
    return _stems(spark, sf, ST.porter)


@query("stem_snowball")
def q_stem_snowball(spark, sf):
    return _stems(spark, sf, ST.snowball)


@query("lemma_lookup", "WITH " + _VEC_TOKENS_SQL + """
, vocab AS (SELECT DISTINCT lower(token) AS form FROM vt),
lem AS (SELECT v.form, substring(v.form, 1, length(v.form) - 1) AS lemma FROM vocab v
        WHERE v.form LIKE '%s' AND length(v.form) > 1
          AND substring(v.form, 1, length(v.form) - 1) IN (SELECT form FROM vocab))
SELECT coalesce(lem.lemma, lower(vt.token)) AS lemma, count(*) AS n
FROM vt LEFT JOIN lem ON lem.form = lower(vt.token) GROUP BY 1
""")
def q_lemma_lookup(spark, sf):
    toks = vec_token_rows(spark, sf)
    # distinct forms meet the lemma table, not occurrences
    forms = cut_lineage(TX.token_counts(toks))
    return TX.lemma_lookup(forms, TX.plural_lemmas(forms)).groupBy("lemma").agg(F.sum("n").alias("n"))


@query("token_pairs", "WITH " + _WORD_TOKENS_SQL + "SELECT DISTINCT token, doc_id FROM wt")
def q_token_pairs(spark, sf):
    return IX.token_pairs(word_token_rows(spark, sf))


@query("inverted_index", "WITH " + _WORD_TOKENS_SQL + """
, tf AS (SELECT token, doc_id, count(*) AS tf FROM wt GROUP BY ALL)
SELECT token, count(*) OVER (PARTITION BY token) AS doc_freq, doc_id, tf FROM tf
""")
def q_inverted_index(spark, sf):
    return IX.inverted_index(word_token_lists(spark, sf))


@query("bow_counts", "WITH " + _VEC_TOKENS_SQL + "SELECT doc_id, token, count(*) AS tf FROM vt GROUP BY ALL")
def q_bow_counts(spark, sf):
    return IX.term_frequencies(vec_token_rows(spark, sf))


_TF_SQL = "WITH " + _VEC_TOKENS_SQL + """
, tf AS (SELECT doc_id, token, count(*) AS tf FROM vt GROUP BY ALL),
dfq AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
nd AS (SELECT count(*) AS n FROM documents)
"""


@query("tfidf_raw", _TF_SQL + """
SELECT tf.doc_id, tf.token, tf.tf, round(tf.tf * ln(nd.n / dfq.df), 6) AS tfidf
FROM tf JOIN dfq USING (token), nd
""")
def q_tfidf_raw(spark, sf):
    tf = IX.term_bags(vec_token_lists(spark, sf))
    return rounded(IX.tfidf_raw(tf, IX.doc_count(_docs(spark, sf))))


@query("tfidf_norm_tf", _TF_SQL + """
, dl AS (SELECT doc_id, sum(tf) AS len FROM tf GROUP BY doc_id)
SELECT tf.doc_id, tf.token, tf.tf, round(tf.tf / dl.len * ln(nd.n / dfq.df), 9) AS tfidf
FROM tf JOIN dfq USING (token) JOIN dl USING (doc_id), nd
""")
def q_tfidf_norm_tf(spark, sf):
    tf = IX.term_bags(vec_token_lists(spark, sf))
    return rounded(IX.tfidf_raw(tf, IX.doc_count(_docs(spark, sf)), normalise_tf=True), 9)


_SMOOTH_SQL = _TF_SQL + """
, idf AS (SELECT token, ln((1 + nd.n) / (1 + df)) + 1 AS idf FROM dfq, nd),
w AS (SELECT doc_id, token, tf * idf AS weight FROM tf JOIN idf USING (token)),
nw AS (SELECT doc_id, token, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS weight FROM w)
"""


def _smooth_fit(spark, sf):
    tf = IX.term_bags(vec_token_lists(spark, sf))
    return tf, IX.idf_smooth_fit(tf, IX.doc_count(_docs(spark, sf)))


def _smooth_doc_weights(spark, sf):
    tf, idf = _smooth_fit(spark, sf)
    return tf, idf, IX.tfidf_smooth_transform(tf, idf)


@query("tfidf_smooth_l2", _SMOOTH_SQL + "SELECT doc_id, token, round(weight, 9) AS weight FROM nw")
def q_tfidf_smooth_l2(spark, sf):
    return rounded(_smooth_doc_weights(spark, sf)[2], 9)


@query("cosine_rank", _SMOOTH_SQL + f"""
, qt AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '{VEC_RE}')) AS token FROM benchmark),
qtf AS (SELECT item_id, token, count(*) AS tf FROM qt GROUP BY ALL),
qw AS (SELECT item_id, token, tf * idf AS q FROM qtf JOIN idf USING (token)),
qn AS (SELECT item_id, sqrt(sum(q * q)) AS qn FROM qw GROUP BY item_id),
dn AS (SELECT doc_id, sqrt(sum(weight * weight)) AS dn FROM w GROUP BY doc_id),
dots AS (SELECT doc_id, item_id, sum(weight * q) AS dot FROM w JOIN qw USING (token) GROUP BY ALL),
c AS (SELECT doc_id, item_id, round(dot / (dn * qn), 9) AS cosine FROM dots JOIN dn USING (doc_id) JOIN qn USING (item_id)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, item_id) AS rn FROM c)
         WHERE rn = 1)
SELECT doc_id, item_id, coalesce(cosine, 0.0) AS cosine FROM documents LEFT JOIN best USING (doc_id)
""")
def q_cosine_rank(spark, sf):
    """The benchmark item nearest to every document, of all items; items are
    passed over by the impact bounds of their blocks and terms."""
    tf, idf = _smooth_fit(spark, sf)
    qtoks = load(spark, sf, "benchmark").select("item_id", F.explode(T.vectorizer_tokens(F.col("text"))).alias("token"))
    best = NQ.nearest_query(tf, IX.term_frequencies(qtoks, "item_id"), idf, query="item_id")
    return (_docs(spark, sf).select("doc_id").join(best, "doc_id", "left")
            .select("doc_id", "item_id", F.coalesce("cosine", F.lit(0.0)).alias("cosine")))


_CLASS_SQL = _SMOOTH_SQL + """
, sig AS (SELECT doc_id, md5(string_agg(token || ' ' || tf, ',' ORDER BY token)) AS h FROM tf GROUP BY doc_id),
cls AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS rep FROM sig)
"""


@query("cosine_join_sparse", _CLASS_SQL + """
, r AS (SELECT nw.* FROM nw JOIN cls USING (doc_id) WHERE doc_id = rep),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, round(sum(a.weight * b.weight), 9) AS cosine
      FROM r a JOIN r b ON a.token = b.token AND a.doc_id < b.doc_id GROUP BY ALL),
n AS (SELECT rep, count(*) AS n FROM cls GROUP BY rep)
SELECT a AS doc_a, b AS doc_b, cosine, x.n AS copies_a, y.n AS copies_b
FROM p JOIN n x ON x.rep = a JOIN n y ON y.rep = b WHERE cosine >= 0.8
""")
def q_cosine_join_sparse(spark, sf):
    """Pairs of documents at a TF-IDF cosine of 0.8 or more; documents with
    equal vectors are counted on their smallest one."""
    tf, idf = _smooth_fit(spark, sf)
    pairs, member = SJ.similarity_join(tf, 0.8, factors=idf)
    n = member.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    return (pairs.join(n.select(F.col("rep").alias("a"), F.col("n").alias("copies_a")), "a")
                 .join(n.select(F.col("rep").alias("b"), F.col("n").alias("copies_b")), "b")
                 .select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b"), "cosine", "copies_a", "copies_b"))


@query("cosine_pairwise_sparse", _SMOOTH_SQL + """
, l AS (SELECT lang, dense_rank() OVER (ORDER BY lang) - 1 AS cluster, doc_id FROM documents),
size AS (SELECT cluster, count(*) AS n FROM l GROUP BY cluster),
c AS (SELECT cluster, token, sum(weight) / any_value(n) AS m FROM nw JOIN l USING (doc_id) JOIN size USING (cluster)
      GROUP BY cluster, token),
cn AS (SELECT cluster, sqrt(sum(m * m)) AS cn FROM c GROUP BY cluster),
d AS (SELECT doc_id, cluster, sum(weight * m) AS dot FROM nw JOIN c USING (token) GROUP BY ALL)
SELECT doc_id, CAST(cn.cluster AS INTEGER) AS cluster, round(1 - coalesce(dot, 0.0) / cn, 9) AS distance
FROM (SELECT DISTINCT doc_id FROM nw) x CROSS JOIN cn LEFT JOIN d USING (doc_id, cluster)
""")
def q_cosine_pairwise_sparse(spark, sf):
    """Distances of sparse TF-IDF rows to dense vectors: the mean row of each language."""
    nw = IX.unit_bags(*_smooth_fit(spark, sf)).stored()
    docs = _docs(spark, sf).select("doc_id", "lang")
    ids = label_index(docs, "lang", "cluster").withColumnRenamed("value", "lang")
    sizes = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).join(ids, "lang")
    # documents meet their language before their terms are rows
    placed = nw.rows.join(docs.join(F.broadcast(sizes), "lang").withColumnRenamed("doc_id", "doc"), "doc")
    cents = (placed.select("cluster", "n", F.inline(F.arrays_zip("tokens", "values")).alias("token", "weight"))
             .groupBy("cluster", "token").agg((F.sum("weight") / F.max("n")).alias("weight")))
    return rounded(SJ.centroid_distances(nw, cents, ids.count()), 9)


# ------------------------------------------------------------ retrieval metrics
# One ranked list per language: documents by length (n_chars desc, doc_id),
# relevant = labelled quality 1 (unlabelled documents are not relevant).

_RANK_SQL = """
WITH d AS (SELECT d.lang, d.doc_id, d.n_chars, CAST(coalesce(l.quality, 0) = 1 AS INTEGER) AS rel
           FROM documents d LEFT JOIN labels l USING (doc_id)),
r AS (SELECT lang, rel, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank,
             sum(rel) OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cum_rel,
             sum(rel) OVER (PARTITION BY lang) AS total_rel FROM d),
curve AS (SELECT lang, rank, cum_rel / rank AS precision, cum_rel / nullif(total_rel, 0) AS recall FROM r)
"""

_AT_K_SQL = _RANK_SQL + """
, ks AS (SELECT unnest([5, 10, 20]) AS k),
m AS (SELECT lang, k, sum(CASE WHEN rank <= k THEN rel ELSE 0 END) AS hits, max(total_rel) AS total_rel
      FROM r, ks GROUP BY lang, k),
p AS (SELECT lang, CAST(k AS INTEGER) AS k, hits / k AS precision, hits / nullif(total_rel, 0) AS recall FROM m)
"""


def _ranked_docs(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    lab = load(spark, sf, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").withColumn(
        "rel", (F.coalesce("quality", F.lit(0)) == 1).cast("int")).drop("quality")


def _order():
    return [F.col("n_chars").desc(), F.col("doc_id").asc()]


def _at_k(spark, sf):
    return R.metrics_at_k(_ranked_docs(spark, sf), "lang", _order(), "rel", (5, 10, 20))


@query("ir_precision_at_k", _AT_K_SQL + "SELECT lang, k, round(precision, 9) AS precision FROM p")
def q_ir_precision_at_k(spark, sf):
    return rounded(_at_k(spark, sf).select("lang", "k", "precision"), 9)


@query("ir_recall_at_k", _AT_K_SQL + "SELECT lang, k, round(recall, 9) AS recall FROM p")
def q_ir_recall_at_k(spark, sf):
    return rounded(_at_k(spark, sf).select("lang", "k", "recall"), 9)


@query("ir_f1_at_k", _AT_K_SQL + """
SELECT lang, k, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                           ELSE 0.0 END, 9) AS f1 FROM p
""")
def q_ir_f1_at_k(spark, sf):
    return rounded(_at_k(spark, sf).select("lang", "k", "f1"), 9)


@query("ir_pr_curve", _RANK_SQL + """
SELECT lang, rank, round(precision, 9) AS precision, round(recall, 9) AS recall FROM curve
""")
def q_ir_pr_curve(spark, sf):
    return rounded(R.pr_curve(_ranked_docs(spark, sf), "lang", _order(), "rel"), 9)


@query("ir_interpolated", _RANK_SQL + """
SELECT lang, rank, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(max(precision) OVER (PARTITION BY lang ORDER BY rank DESC ROWS UNBOUNDED PRECEDING), 9)
       AS interpolated
FROM curve
""")
def q_ir_interpolated(spark, sf):
    curve = R.pr_curve(_ranked_docs(spark, sf), "lang", _order(), "rel")
    return rounded(R.interpolated_precision(curve, "lang"), 9)


@query("ir_interpolated_recall", _RANK_SQL + """
, lv AS (SELECT unnest([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS level)
SELECT lang, CAST(level AS DOUBLE) AS level,
       round(max(CASE WHEN recall >= level THEN precision END), 9) AS interpolated
FROM curve, lv GROUP BY lang, level
""")
def q_ir_interpolated_recall(spark, sf):
    curve = R.pr_curve(_ranked_docs(spark, sf), "lang", _order(), "rel")
    levels = [round(0.1 * i, 1) for i in range(11)]
    return rounded(R.interpolated_at_recall(curve, "lang", levels), 9)


@query("pmi", "WITH " + _VEC_TOKENS_SQL + """
, t AS (SELECT vt.token, d.lang FROM vt JOIN documents d USING (doc_id)),
xy AS (SELECT token, lang, count(*) AS nxy FROM t GROUP BY ALL),
x AS (SELECT token, count(*) AS nx FROM t GROUP BY token),
y AS (SELECT lang, count(*) AS ny FROM t GROUP BY lang),
n AS (SELECT count(*) AS n FROM t)
SELECT token, lang, round(ln((nxy / n) / ((nx / n) * (ny / n))), 9) AS pmi
FROM xy JOIN x USING (token) JOIN y USING (lang), n
""")
def q_pmi(spark, sf):
    from ..operators.association import pmi
    toks = vec_token_rows(spark, sf, keys=("doc_id", "lang"))
    return rounded(pmi(toks, "token", "lang"), 9)


_CONV_SQL = f"""
WITH s AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '{VEC_RE}') AS toks FROM conversations),
f AS (SELECT conv_id, turn, list_concat(['<s>'], toks, ['</s>']) AS fr FROM s),
pairs AS (SELECT conv_id, turn, unnest(list_slice(fr, 1, len(fr) - 1)) AS w1,
                 unnest(list_slice(fr, 2, len(fr))) AS w2 FROM f),
c AS (SELECT w1, w2, count(*) AS c FROM pairs GROUP BY ALL),
h AS (SELECT w1, sum(c) AS ch FROM c GROUP BY w1),
model AS (SELECT w1, w2, c / ch AS p FROM c JOIN h USING (w1))
"""


def _conv_sentences(spark, sf):
    conv = load(spark, sf, "conversations")
    return conv.select("conv_id", "turn", T.vectorizer_tokens(F.col("text")).alias("toks"))


@query("bigram_lm", _CONV_SQL + "SELECT w1, w2, p FROM model")
def q_bigram_lm(spark, sf):
    return SQ.bigram_model(_conv_sentences(spark, sf), "toks")


@query("bigram_sentence_logprob", _CONV_SQL + """
SELECT conv_id, turn, round(sum(ln(p)), 9) AS logprob FROM pairs JOIN model USING (w1, w2) GROUP BY ALL
""")
def q_bigram_sentence_logprob(spark, sf):
    s = _conv_sentences(spark, sf)
    return rounded(SQ.sentence_logprob(s, ["conv_id", "turn"], "toks", SQ.bigram_model(s, "toks")), 9)


_CHAR_V = ".abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "
_CHAR_IDS_SQL = f"""
list_resize(list_slice(list_filter(list_transform(string_split(c_name || '.', ''),
            lambda ch: instr('{_CHAR_V}', ch) + 1), lambda x: x > 1), 1, 20), 20, 0)
"""


@query("char_seq_encode", f"""
SELECT c_custkey, CAST(ids AS INTEGER[]) AS ids,
       CAST(list_concat([1], list_slice(ids, 1, 19)) AS INTEGER[]) AS input_ids
FROM (SELECT c_custkey, {_CHAR_IDS_SQL} AS ids FROM customer)
""")
def q_char_seq_encode(spark, sf):
    c = load(spark, sf, "customer")
    ids = SQ.encode_chars(F.col("c_name"), 20)
    return c.select("c_custkey", ids.alias("ids")).select(
        "c_custkey", "ids", SQ.shift_input(F.col("ids")).alias("input_ids"))


@query("char_lm_loss", f"""
WITH e AS (SELECT c_custkey, {_CHAR_IDS_SQL} AS ids,
                  CASE WHEN ((c_custkey % 1000003) * 2654435761) % 1000003 < 0.9 * 1000003
                       THEN 'train' ELSE 'val' END AS split FROM customer),
p AS (SELECT split, unnest(list_concat([1], list_slice(ids, 1, 19))) AS prev, unnest(ids) AS next FROM e),
pn AS (SELECT * FROM p WHERE next <> 0),
c AS (SELECT prev, next, count(*) AS c FROM pn WHERE split = 'train' GROUP BY ALL),
cp AS (SELECT prev, sum(c) AS cp FROM c GROUP BY prev),
s AS (SELECT -ln((coalesce(c.c, 0) + 1.0) / (coalesce(cp.cp, 0) + 1.0 * 66)) AS nll
      FROM pn LEFT JOIN c USING (prev, next) LEFT JOIN cp USING (prev) WHERE pn.split = 'val')
SELECT round(avg(nll), 9) AS loss, count(*) AS n_chars FROM s
""")
def q_char_lm_loss(spark, sf):
    c = split_hash(load(spark, sf, "customer"), "c_custkey", (0.9, 0.1), ("train", "val"))
    out = SQ.char_bigram_loss(c.filter(F.col("split") == "train"), c.filter(F.col("split") == "val"),
                              "c_name", alpha=1.0)
    return rounded(out, 9)


@query("token_id_encode", "WITH " + _VEC_TOKENS_SQL + """
, cnt AS (SELECT token, count(*) AS n FROM vt GROUP BY token),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS id FROM cnt),
h AS (SELECT doc_id, pos, coalesce(id, 1) AS id FROM vt LEFT JOIN vocab USING (token) WHERE pos < 512),
s AS (SELECT doc_id, list(id ORDER BY pos) AS ids FROM h GROUP BY doc_id),
f AS (SELECT doc_id, coalesce(ids, CAST([] AS INTEGER[])) AS ids FROM documents LEFT JOIN s USING (doc_id))
SELECT doc_id, CAST(list_resize(ids, 512, 0) AS INTEGER[]) AS input_ids,
       CAST(list_resize(list_transform(ids, lambda x: 1), 512, 0) AS INTEGER[]) AS attention_mask FROM f
""")
def q_token_id_encode(spark, sf):
    vocab = SQ.token_vocabulary(vec_token_rows(spark, sf))
    heads = _docs(spark, sf).select("doc_id", F.posexplode_outer(
        F.slice(T.vectorizer_tokens(F.col("text")), 1, 512)).alias("pos", "token"))
    return SQ.encode_tokens(heads, vocab, "doc_id", 512)


@query("doc_mean_vector", "WITH " + _VEC_TOKENS_SQL + """
, cnt AS (SELECT DISTINCT token FROM vt),
vr AS (SELECT token, row_number() OVER (ORDER BY token) AS r FROM cnt),
er AS (SELECT embedding, row_number() OVER (ORDER BY vec_id) AS e FROM embeddings),
ne AS (SELECT count(*) AS ne FROM embeddings),
vv AS (SELECT token, embedding FROM vr, ne JOIN er ON er.e = (vr.r - 1) % ne.ne + 1),
tf AS (SELECT doc_id, token, count(*) AS tf FROM vt GROUP BY ALL),
x AS (SELECT doc_id, tf, unnest(range(64)) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS v FROM tf JOIN vv USING (token)),
m AS (SELECT doc_id, dim, sum(tf * v) / sum(tf) AS value FROM x GROUP BY ALL),
g AS (SELECT doc_id, unnest(range(64)) AS dim FROM documents)
SELECT g.doc_id, CAST(g.dim AS INTEGER) AS dim, {v} AS value
FROM g LEFT JOIN m USING (doc_id, dim)
""".format(v=sig_round_sql("coalesce(m.value, 0.0)", 9)))
def q_doc_mean_vector(spark, sf):
    from ..operators.vectors import doc_mean_vectors
    tf = IX.term_bags(vec_token_lists(spark, sf))
    vectors = token_vectors(spark, sf, tf)
    means = doc_mean_vectors(tf, vectors, "doc_id", "token", "embedding", dim=64)
    # documents without an in-vocabulary token get the zero vector
    docs = _docs(spark, sf).select("doc_id").join(means, "doc_id", "left")
    full = F.coalesce(F.col("mean"), F.array_repeat(F.lit(0.0), 64))
    out = docs.select("doc_id", F.posexplode(full).alias("dim", "value"))
    return out.select("doc_id", "dim", sig_round(F.col("value"), 9).alias("value"))


def token_vectors(spark, sf, tf):
    """Vocabulary vectors: the tokens, numbered in token order, take the
    embedding at the same position (cyclically) of the ``embeddings`` table
    ordered by id."""
    cnt = tf.counts.select("token").distinct()
    vr = global_rank(cnt, ["token"], "r")
    emb = load(spark, sf, "embeddings")
    er = global_rank(emb.select("vec_id", "embedding"), ["vec_id"], "e")
    ne = emb.select(F.count(F.lit(1))).scalar()
    return (vr.withColumn("e", F.pmod(F.col("r") - 1, ne) + 1)
              .join(er.select("e", "embedding"), "e").select("token", "embedding"))


@query("feature_concat", """
SELECT vec_id, list_concat(CAST(embedding AS DOUBLE[]), [CAST(label AS DOUBLE)]) AS features FROM embeddings
""")
def q_feature_concat(spark, sf):
    from ..operators.vectors import concat_features
    e = load(spark, sf, "embeddings")
    return e.select("vec_id", concat_features(F.col("embedding"), F.array(F.col("label"))).alias("features"))


# ------------------------------------------------------------ HTML

_TITLE_SQL = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
_TEXT_SQL = r"trim(regexp_replace(regexp_replace({x}, '(?s)<[^>]*>', '', 'g'), '\s+', ' ', 'g'))"
_HREF_SQL = (r"coalesce(nullif(regexp_extract(attrs, '(?is)(?:^|\s)href\s*=\s*\x22([^\x22]*)\x22', 1), ''), "
             r"nullif(regexp_extract(attrs, '(?is)(?:^|\s)href\s*=\s*\x27([^\x27]*)\x27', 1), ''), "
             r"nullif(regexp_extract(attrs, '(?is)(?:^|\s)href\s*=\s*([^\s\x22\x27>]+)', 1), ''))")
_ANCHOR_RE = r"'(?is)<a\b([^>]*)>(.*?)</a\s*>'"


@query("html_title", f"""
SELECT page_id, CASE WHEN regexp_matches(html, '{_TITLE_SQL}') THEN
  {_TEXT_SQL.format(x=f"regexp_extract(html, '{_TITLE_SQL}', 1)")} END AS title FROM pages
""")
def q_html_title(spark, sf):
    return H.title(load(spark, sf, "pages"))


_ANCHOR_SQL = f"""
a AS (SELECT page_id, CAST(unnest(range(len(x))) AS INTEGER) AS idx, unnest(x) AS attrs, unnest(y) AS inner_html
      FROM (SELECT page_id, regexp_extract_all(html, {_ANCHOR_RE}, 1) AS x,
                   regexp_extract_all(html, {_ANCHOR_RE}, 2) AS y FROM pages)),
l AS (SELECT page_id, idx, {_HREF_SQL} AS href, trim(attrs) AS attrs, {_TEXT_SQL.format(x="inner_html")} AS text FROM a)
"""


@query("html_links", "WITH " + _ANCHOR_SQL + "SELECT * FROM l")
def q_html_links(spark, sf):
    return H.links(load(spark, sf, "pages"))


@query("html_nth_link", "WITH " + _ANCHOR_SQL + """
SELECT page_id, href, attrs, text FROM pages LEFT JOIN (SELECT * FROM l WHERE idx = 1) USING (page_id)
""")
def q_html_nth_link(spark, sf):
    return H.nth_link(load(spark, sf, "pages"), 2)


@query("html_nth", r"""
SELECT page_id, regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>', 1)[2] AS li_2 FROM pages
""")
def q_html_nth(spark, sf):
    return H.nth_tag(load(spark, sf, "pages"), "li", 2)


@query("html_table", """
SELECT n_regionkey AS page_id, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER) AS row,
       n_name AS cell_2, 'no. ' || CAST(n_nationkey AS VARCHAR) AS cell_3 FROM nation
""")
def q_html_table(spark, sf):
    """Second table of pages built from the nations of each region: a header
    row, line breaks inside rows and cells, attributes and inner tags."""
    n = load(spark, sf, "nation")
    row = F.format_string("<TR class='x'>\n<td>%d</td>\n<td align=left><b>%s</b>\n</td><td>no.\n <i>%d</i></td></TR>",
                          "n_regionkey", "n_name", "n_nationkey")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("r")))),
                                    lambda x: x["r"]), "\n")  # a region has few nations
    pages = n.groupBy(F.col("n_regionkey").alias("page_id")).agg(F.concat(
        F.lit("<html><table><tr><td>first</td></tr></table>\n<Table border=1>\n<tr><th>a</th><th>b</th></tr>"),
        body, F.lit("</table></html>")).alias("html"))
    return H.table_rows(pages, cells=(2, 3), table=2)


@query("html_rows", rf"""
WITH i AS (SELECT page_id, CAST(unnest(range(len(a))) AS INTEGER) AS idx, unnest(a) AS item
           FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1) AS a FROM pages)),
f AS (SELECT page_id, idx, regexp_extract(item, {_ANCHOR_RE}, 1) AS attrs,
             regexp_extract(item, {_ANCHOR_RE}, 2) AS inner_html FROM i WHERE regexp_matches(item, {_ANCHOR_RE}))
SELECT page_id, idx, {_HREF_SQL} AS href, {_TEXT_SQL.format(x="inner_html")} AS text FROM f
""")
def q_html_rows(spark, sf):
    return H.anchor_records(load(spark, sf, "pages"))


@query("clean_html_cjk", r"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(html), '<.*?>', '', 'g'),
       '\s+', ' ', 'g'), '[^""" + _q(T.LATIN_KEEP) + r"""]+', ' ', 'g')) AS text FROM pages
""")
def q_clean_html_cjk(spark, sf):
    p = load(spark, sf, "pages")
    return p.select("page_id", T.clean_text(F.col("html"), keep=T.LATIN_KEEP).alias("text"))
