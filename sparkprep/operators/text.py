"""Tokenising, stop-word removal, stemming, lemma lookup, token counts.

Token streams are long DataFrames ``(doc_id, pos, token)`` produced by
``posexplode`` of a per-row regex split: no shuffle until a count or join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# The English stop-word list of the NLTK corpus (179 words).
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours "
    "yourself yourselves he him his himself she she's her hers herself it it's its "
    "itself they them their theirs themselves what which who whom this that that'll "
    "these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why how all "
    "any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren "
    "aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't "
    "shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# Python's string.punctuation.
PUNCTUATION = list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

# Suffix rule of the regular-expression stemmer example
# (strip a final ing / s / e / able from words of length >= 4).
STEM_SUFFIXES = "ing$|s$|e$|able$"
STEM_MIN_LEN = 4


def word_list(spark, words, col: str = "token") -> DataFrame:
    """A small fixed word list as a one-column DataFrame."""
    return spark.createDataFrame([(w,) for w in words], f"{col} string")


def explode_tokens(df: DataFrame, id_col: str, tokens: Column,
                   pos: str = "pos", token: str = "token") -> DataFrame:
    """``(id, pos, token)`` rows from an array-of-strings expression."""
    return df.select(id_col, F.posexplode(tokens).alias(pos, token))


def sentence_rows(df: DataFrame, id_col: str, text: str) -> DataFrame:
    return df.select(id_col, F.posexplode(T.sentences(F.col(text))).alias("sent_idx", "sentence"))


def token_counts(tokens: DataFrame, token: str = "token") -> DataFrame:
    """``(token, n)``; a hash aggregate with map-side partial counts, so a
    token occurring in a third of all rows costs one row per task."""
    return tokens.groupBy(token).agg(F.count(F.lit(1)).alias("n"))


def top_tokens(tokens: DataFrame, k: int = 10, token: str = "token") -> DataFrame:
    """``Counter.most_common(k)``; ties broken by token (a top-k report)."""
    return token_counts(tokens, token).orderBy(F.col("n").desc(), F.col(token)).limit(k)


def remove_words(tokens: DataFrame, words: DataFrame, token: str = "token") -> DataFrame:
    """Anti join against a word list of any size (a small one is broadcast
    by Spark's own size estimate)."""
    return tokens.join(words.select(F.col(words.columns[0]).alias(token)), token, "left_anti")


def stop_punct_filter(tokens: DataFrame, token: str = "token") -> DataFrame:
    """Drop single punctuation tokens and (case-sensitive) stop words."""
    spark = tokens.sparkSession
    return remove_words(tokens, word_list(spark, ENGLISH_STOP_WORDS + PUNCTUATION), token)


def clean_token_rows(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """ASCII-only, lower-case, punctuation-free tokens without stop words."""
    toks = explode_tokens(df, id_col, T.clean_tokens(F.col(text)))
    return remove_words(toks, word_list(df.sparkSession, ENGLISH_STOP_WORDS))


def regexp_stem(token: Column, suffixes: str = STEM_SUFFIXES, min_len: int = STEM_MIN_LEN) -> Column:
    """Remove every match of ``suffixes`` from words of at least ``min_len``."""
    return F.when(F.length(token) < min_len, token).otherwise(F.regexp_replace(token, suffixes, ""))


def stem_counts(tokens: DataFrame, token: str = "token") -> DataFrame:
    """Counts per stem. Stemming runs once per distinct token (the
    vocabulary), not per occurrence, then the counts are summed."""
    vocab = token_counts(tokens, token)
    return (vocab.select(regexp_stem(F.col(token)).alias("stem"), "n")
                 .groupBy("stem").agg(F.sum("n").alias("n")))


def reduce_pos(tag: Column) -> Column:
    """Penn tag -> WordNet class by its first letter: j -> a; n, v, r kept;
    anything else -> n."""
    t = F.lower(F.substring(tag, 1, 1))
    return F.when(t == "j", F.lit("a")).when(t.isin("n", "v", "r"), t).otherwise(F.lit("n"))


def plural_lemmas(tokens: DataFrame, token: str = "token") -> DataFrame:
    """A lemma table ``(form, pos, lemma)`` derived from the corpus itself:
    a lower-cased form ending in ``s`` maps to the form without it when that
    also occurs in the corpus (nouns)."""
    vocab = tokens.select(F.lower(token).alias("form")).distinct()
    cand = vocab.filter(F.col("form").endswith("s") & (F.length("form") > 1)).select(
        "form", F.expr("substring(form, 1, length(form) - 1)").alias("lemma"))
    return (cand.join(vocab.select(F.col("form").alias("lemma")), "lemma", "left_semi")
                .select("form", F.lit("n").alias("pos"), "lemma"))


def lemma_lookup(tokens: DataFrame, lemmas: DataFrame, token: str = "token",
                 pos: Column | None = None) -> DataFrame:
    """Lemma by (lower-cased form, reduced POS) from a lemma table; the
    lower-cased form itself when the table has no entry."""
    pos = pos if pos is not None else F.lit("n")
    t = tokens.withColumn("_form", F.lower(token)).withColumn("_pos", reduce_pos(pos))
    lem = lemmas.select(F.col("form").alias("_form"), F.col("pos").alias("_pos"),
                        F.col("lemma").alias("_lemma"))
    return (t.join(lem, ["_form", "_pos"], "left")
             .withColumn("lemma", F.coalesce("_lemma", "_form"))
             .drop("_form", "_pos", "_lemma"))
