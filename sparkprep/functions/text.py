"""Text and scalar column expressions (all JVM-side regex/string built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns (Java regex).
# word_tokenize: a run of letters/digits (Latin-1 accented letters included)
# or any single character that is neither such a letter/digit nor space.
WORD_OR_PUNCT = r"[A-Za-zÀ-ÿ0-9]+|[^\sA-Za-zÀ-ÿ0-9]"
# CountVectorizer default token: 2+ word characters (Unicode letters,
# digits, underscore).
WORD2 = r"[\p{L}\p{N}_]{2,}"
# ASCII punctuation: ! through /, : through @, [ through `, { through ~.
ASCII_PUNCT = r"[!-/:-@\[-`{-~]"
NON_ASCII = r"[^\x00-\x7F]"
# Sentence end: one of . ! ? followed by whitespace.
SENT_END = r"([.!?])\s+"
# CJK keep-class of the Chinese review cleaner: CJK unified ideographs and
# the punctuation ，。！？、
CJK_KEEP = "一-鿿，。！？、"
# Latin keep-class used on the (European-language) driver texts.
LATIN_KEEP = "a-z0-9À-ÿ.,!?' "


def band_label(c: Column, lo: float, hi: float) -> Column:
    """>= hi -> 1, <= lo -> 0, anything else (null included) -> 2."""
    return (F.when(c >= hi, F.lit(1)).when(c <= lo, F.lit(0)).otherwise(F.lit(2)))


def parse_day_month_year(raw: Column, sep: str = "t") -> Column:
    """Take the text before the first ``sep`` and parse it as dd/MM/yyyy."""
    head = F.split(raw, sep, 2).getItem(0)
    return F.try_to_timestamp(head, F.lit("dd/MM/yyyy")).cast("date")


def clean_text(c: Column, keep: str = CJK_KEEP) -> Column:
    """Lower-case, drop HTML tags, collapse whitespace, turn every run of
    characters outside ``keep`` into one space, trim."""
    s = F.lower(c)
    s = F.regexp_replace(s, r"<.*?>", "")
    s = F.regexp_replace(s, r"\s+", " ")
    s = F.regexp_replace(s, f"[^{keep}]+", " ")
    return F.trim(s)


def sentences(text: Column) -> Column:
    """Split after ., ! or ? followed by whitespace (rule-based stand-in for
    a trained sentence model)."""
    return F.split(F.regexp_replace(text, SENT_END, "$1\n"), "\n")


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_OR_PUNCT), 0)


def clean_tokens(text: Column) -> Column:
    """Drop non-ASCII, lower, delete ASCII punctuation, split on spaces,
    drop empty strings (``don't`` -> ``dont``)."""
    s = F.regexp_replace(F.lower(F.regexp_replace(text, NON_ASCII, "")), ASCII_PUNCT, "")
    return F.filter(F.split(s, r"\s+"), lambda t: t != "")


def vectorizer_tokens(text: Column) -> Column:
    """Lower-cased tokens of 2+ word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD2), 0)
