"""Sequence encoders and count-based language models.

Vocabularies are tables built by Spark (ranked distributed, joined back);
per-row work is array higher-order functions, which stay in the JVM.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordering import global_rank

# Character vocabulary of the name generator: padding "",
# "<bos>", ".", a-z, A-Z, 0-9, space (66 symbols, ids in this order).
CHAR_VOCAB = ["", "<bos>", "."] + list(string.ascii_lowercase + string.ascii_uppercase
                                       + string.digits + " ")
PAD_ID, BOS_ID = 0, 1


def _char_map() -> Column:
    kv = []
    for i, c in enumerate(CHAR_VOCAB):
        if len(c) == 1:
            kv += [F.lit(c), F.lit(i)]
    return F.create_map(*kv)


def encode_chars(text: Column, max_len: int = 20, end_mark: str | None = ".") -> Column:
    """Characters -> ids; characters outside the vocabulary dropped;
    truncated or padded with 0 to ``max_len`` (the end mark is appended
    before truncation, so long names lose it)."""
    s = F.concat(text, F.lit(end_mark)) if end_mark else text
    chars = F.split(s, "")
    m = _char_map()
    ids = F.filter(F.transform(chars, lambda ch: F.try_element_at(m, ch)), lambda x: x.isNotNull())
    ids = F.slice(ids, 1, max_len)
    pad = F.array_repeat(F.lit(PAD_ID), F.greatest(F.lit(max_len) - F.size(ids), F.lit(0)))
    return F.concat(ids, pad)


def shift_input(ids: Column) -> Column:
    """Teacher-forcing input: <bos> followed by the target minus its last id."""
    return F.concat(F.array(F.lit(BOS_ID)), F.slice(ids, 1, F.size(ids) - 1))


def char_bigrams(ids: Column) -> Column:
    """(prev, next) pairs of an encoded sequence prefixed by <bos>; pairs
    whose target is padding are dropped."""
    x = shift_input(ids)
    pairs = F.arrays_zip(x.alias("prev"), ids.alias("next"))
    return F.filter(pairs, lambda p: p["next"] != PAD_ID)


def char_bigram_loss(train: DataFrame, val: DataFrame, col: str, alpha: float = 1.0,
                     max_len: int = 20) -> DataFrame:
    """Mean negative log-likelihood per non-pad target character of ``val``
    under an add-``alpha`` character-bigram model counted on ``train``.
    Counts form a table of at most 66 x 66 rows."""
    vocab = len(CHAR_VOCAB)

    def pairs(df):
        return df.select(F.inline(char_bigrams(encode_chars(F.col(col), max_len)))).select(
            F.col("prev"), F.col("next"))

    counts = pairs(train).groupBy("prev", "next").agg(F.count(F.lit(1)).alias("c"))
    ctx = counts.groupBy("prev").agg(F.sum("c").alias("cp"))
    vp = pairs(val)
    scored = (vp.join(F.broadcast(counts), ["prev", "next"], "left")
                .join(F.broadcast(ctx), "prev", "left")
                .select((-F.log((F.coalesce("c", F.lit(0)) + alpha)
                                / (F.coalesce("cp", F.lit(0)) + alpha * vocab))).alias("nll")))
    return scored.agg(F.avg("nll").alias("loss"), F.count(F.lit(1)).alias("n_chars"))


def token_vocabulary(tokens: DataFrame, token: str = "token", first_id: int = 2) -> DataFrame:
    """``(token, id)``: ids by count desc then token, starting at
    ``first_id`` (0 = padding, 1 = unknown)."""
    counts = tokens.groupBy(token).agg(F.count(F.lit(1)).alias("_n"))
    r = global_rank(counts, [F.col("_n").desc(), F.col(token).asc()], "_r")
    return r.select(token, (F.col("_r") - 1 + first_id).cast("int").alias("id"))


def encode_tokens(tokens: DataFrame, vocab: DataFrame, doc: str = "doc_id",
                  max_len: int = 32, token: str = "token", pos: str = "pos") -> DataFrame:
    """``(doc, input_ids, attention_mask)``: the first ``max_len`` tokens of
    every document mapped through ``vocab`` (unknown -> 1), padded with 0.
    Only positions < max_len are joined and collected, so arrays stay
    bounded however long the document is. A row with a null position stands
    for a document without tokens: all padding."""
    head = tokens.filter(F.col(pos).isNull() | (F.col(pos) < max_len))
    ided = head.join(vocab, token, "left").select(doc, pos, F.coalesce("id", F.lit(1)).alias("id"))
    entry = F.when(F.col(pos).isNotNull(), F.struct(pos, "id"))
    seq = ided.groupBy(doc).agg(F.array_sort(F.collect_list(entry)).alias("_s"))
    ids = F.transform("_s", lambda s: s["id"])
    n = F.size(ids)
    pad = F.array_repeat(F.lit(0), F.lit(max_len) - n)
    return seq.select(doc, F.concat(ids, pad).alias("input_ids"),
                      F.concat(F.array_repeat(F.lit(1), n), pad).alias("attention_mask"))


def bigrams(tokens: Column, bos: str = "<s>", eos: str = "</s>") -> Column:
    """(w1, w2) pairs of a token array framed by sentence markers."""
    framed = F.concat(F.array(F.lit(bos)), tokens, F.array(F.lit(eos)))
    return F.arrays_zip(F.slice(framed, 1, F.size(framed) - 1).alias("w1"),
                        F.slice(framed, 2, F.size(framed) - 1).alias("w2"))


def bigram_model(sentences: DataFrame, tokens_col: str) -> DataFrame:
    """Maximum-likelihood ``(w1, w2, p)`` with p = c(w1 w2) / c(w1 .). Both
    counts are stored first: the join then reads plain tables, and the pairs
    of a first word that begins a third of them are split over tasks."""
    pairs = sentences.select(F.inline(bigrams(F.col(tokens_col))))
    c = cut_lineage(pairs.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c")))
    h = cut_lineage(c.groupBy("w1").agg(F.sum("c").alias("ch")))
    return c.join(h, "w1").select("w1", "w2", (F.col("c") / F.col("ch")).alias("p"))


def sentence_logprob(sentences: DataFrame, keys, tokens_col: str, model: DataFrame) -> DataFrame:
    """Sum of ln p over a sentence's bigrams (null if one is unseen)."""
    pairs = sentences.select(*keys, F.inline(bigrams(F.col(tokens_col))))
    scored = pairs.join(model, ["w1", "w2"], "left")
    return scored.groupBy(*keys).agg(
        F.when(F.count_if(F.col("p").isNull()) > 0, F.lit(None))
         .otherwise(F.sum(F.log("p"))).alias("logprob"))


def logprob_of(probs) -> float:
    return sum(math.log(p) for p in probs)
