"""Porter and Snowball (English) stems as staged column expressions.

Each stage is a projection of the vocabulary: the word, and its shape, where a
``y`` that counts as a consonant is written ``Y``. A rule is (suffix,
replacement, condition on what is before the suffix); the longest suffix that
fits is the stage's only candidate. Conditions read the shape: the measure is
the number of vowel-consonant groups, regions are positions in the word.
Stemming a table of distinct words costs a few projections, whatever the
number of occurrences; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

V, C = "[aeiouy]", "[^aeiouy]"

# The published suffix rules of the two algorithms, in their
# published steps.
PORTER_1A = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
PORTER_2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"),
            ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
            ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"),
            ("biliti", "ble")]
PORTER_3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
PORTER_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
            "ous", "ive", "ize"]
SNOWBALL_WORDS = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
                  "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
                  "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
SNOWBALL_STOP = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
SNOWBALL_2 = [("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("entli", "ent"), ("izer", "ize"),
              ("ization", "ize"), ("ational", "ate"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("aliti", "al"),
              ("alli", "al"), ("fulness", "ful"), ("ousli", "ous"), ("ousness", "ous"), ("iveness", "ive"), ("iviti", "ive"),
              ("biliti", "ble"), ("bli", "ble"), ("ogi", "og"), ("fulli", "ful"), ("lessli", "less"), ("li", "")]
SNOWBALL_3 = [("tional", "tion"), ("ational", "ate"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"),
              ("ful", ""), ("ness", ""), ("ative", "")]
SNOWBALL_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive",
              "ize", "ion"]


def shape(w: Column) -> Column:
    """The word with ``Y`` for each y that follows a vowel or begins it."""
    return F.regexp_replace(F.regexp_replace(w, "^y|(?<=[aeiou])y", "Y"), "yy", "yY")


def _rest(c: Column, suffix: str) -> Column:
    return F.substring(c, F.lit(1), F.length(c) - len(suffix))


def _measure(k: Column) -> Column:
    return F.regexp_count(k, F.lit(f"{V}+{C}+"))


def _short_end(k: Column) -> Column:
    """Ends consonant, vowel, consonant that is not w, x or y."""
    return k.rlike(f"{C}{V}[^aeiouywxY]$")


def _double(k: Column) -> Column:
    return k.rlike(rf"({C})\1$")


def _rules(w: Column, k: Column, rules, condition) -> Column:
    """The word after the one rule whose suffix is the longest that it ends
    with; ``condition(shape before the suffix, suffix)`` decides."""
    out = None
    for suffix, new in sorted(rules, key=lambda r: -len(r[0])):
        done = F.when(condition(_rest(k, suffix), suffix), F.concat(_rest(w, suffix), F.lit(new))).otherwise(w)
        out = F.when(w.endswith(suffix), done) if out is None else out.when(w.endswith(suffix), done)
    return out.otherwise(w)


def _stage(df: DataFrame, expr) -> DataFrame:
    """Replace the word by ``expr(word, shape)``; short words stay."""
    df = df.withColumn("_k", shape(F.col("_w")))
    return df.withColumn("_w", F.when(F.col("_live"), expr(F.col("_w"), F.col("_k"))).otherwise(F.col("_w")))


def porter(words: DataFrame, word: str, out: str = "stem") -> DataFrame:
    """Porter's stem of the lower-cased word; words of up to two letters stay."""
    df = words.withColumn("_w", F.lower(word)).withColumn("_live", F.length("_w") > 2)
    always = lambda k, s: F.lit(True)
    df = _stage(df, lambda w, k: _rules(w, k, PORTER_1A, always))
    df = df.withColumn("_was", F.col("_w"))
    df = _stage(df, lambda w, k: _rules(w, k, [("eed", "ee"), ("ed", ""), ("ing", "")], lambda p, s: (
        _measure(p) > 0 if s == "eed" else p.rlike(V))))
    cut = (F.col("_was") != F.col("_w")) & ~F.col("_was").endswith("eed")
    df = df.withColumn("_cut", cut)
    df = _stage(df, lambda w, k: F.when(~F.col("_cut"), w).when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e")))
                .when(_double(k) & ~w.rlike("[lsz]$"), _rest(w, "x"))
                .when((_measure(k) == 1) & _short_end(k), F.concat(w, F.lit("e"))).otherwise(w))
    df = _stage(df, lambda w, k: F.when(w.endswith("y") & _rest(k, "y").rlike(V), F.concat(_rest(w, "y"), F.lit("i"))).otherwise(w))
    for rules in (PORTER_2, PORTER_3):
        df = _stage(df, lambda w, k, rules=rules: _rules(w, k, rules, lambda p, s: _measure(p) > 0))
    df = _stage(df, lambda w, k: _rules(w, k, [(s, "") for s in PORTER_4], lambda p, s: (_measure(p) > 1) & (
        p.rlike("[st]$") if s == "ion" else F.lit(True))))
    df = _stage(df, lambda w, k: F.when(w.endswith("e") & ((_measure(_rest(k, "e")) > 1) | (
        (_measure(_rest(k, "e")) == 1) & ~_short_end(_rest(k, "e")))), _rest(w, "e")).otherwise(w))
    df = _stage(df, lambda w, k: F.when(w.endswith("ll") & (_measure(k) > 1), _rest(w, "l")).otherwise(w))
    return df.withColumn(out, F.col("_w")).drop("_w", "_k", "_live", "_was", "_cut")


def _after_group(k: Column) -> Column:
    """Letters up to and with the first consonant behind a vowel (all, where
    there is none)."""
    hit = F.regexp_extract(k, f"^{C}*{V}+{C}", 0)
    return F.when(hit == "", F.length(k)).otherwise(F.length(hit))


def snowball(words: DataFrame, word: str, out: str = "stem") -> DataFrame:
    """The Snowball English stem of the lower-cased word; words of up to two
    letters stay."""
    low = F.regexp_replace(F.regexp_replace(F.lower(word), "[\\u2019\\u2018\\u201B]", "'"), "^'", "")
    known = F.create_map(*[F.lit(x) for kv in SNOWBALL_WORDS.items() for x in kv])
    df = words.withColumn("_w", F.when(F.length(F.lower(word)) > 2, low).otherwise(F.lower(word)))
    df = df.withColumn("_fixed", known[F.col("_w")])
    df = df.withColumn("_live", (F.length("_w") > 2) & F.col("_fixed").isNull())
    # regions: positions in the word, kept while its end changes
    df = df.withColumn("_k", shape(F.col("_w")))
    special = F.regexp_extract("_k", "^(gener|commun|arsen)", 1)
    df = df.withColumn("_r1", F.when(special != "", F.length(special)).otherwise(_after_group(F.col("_k"))))
    df = df.withColumn("_tail", F.substring(F.col("_k"), F.col("_r1") + 1, F.length("_k")))
    df = df.withColumn("_r2", F.col("_r1") + _after_group(F.col("_tail")))
    r1, r2 = F.col("_r1"), F.col("_r2")
    inside = lambda p, r: F.length(p) >= r
    df = _stage(df, lambda w, k: F.regexp_replace(w, "'s'$|'s$|'$", ""))
    df = _stage(df, lambda w, k: F.when(w.endswith("sses"), _rest(w, "es")).when(
        w.rlike("ie[ds]$"), F.when(F.length(w) > 4, _rest(w, "es")).otherwise(_rest(w, "s"))).when(
        w.rlike("(us|ss)$"), w).when(w.endswith("s") & k.rlike(f"{V}.+s$"), _rest(w, "s")).otherwise(w))
    df = df.withColumn("_live", F.col("_live") & ~F.col("_w").isin(SNOWBALL_STOP)).withColumn("_was", F.col("_w"))
    df = _stage(df, lambda w, k: _rules(w, k, [("eedly", "ee"), ("eed", "ee"), ("ingly", ""), ("edly", ""), ("ing", ""), ("ed", "")],
                                        lambda p, s: inside(p, r1) if s.startswith("ee") else p.rlike(V)))
    df = df.withColumn("_cut", (F.col("_was") != F.col("_w")) & ~F.col("_was").rlike("eed(ly)?$"))
    short = lambda k: (F.length(k) <= r1) & (_short_end(k) | k.rlike(f"^{V}{C}$"))
    df = _stage(df, lambda w, k: F.when(~F.col("_cut"), w).when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e")))
                .when(w.rlike("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), _rest(w, "x"))
                .when(short(k), F.concat(w, F.lit("e"))).otherwise(w))
    df = _stage(df, lambda w, k: F.when(k.rlike(f"^.+{C}[yY]$"), F.concat(_rest(w, "y"), F.lit("i"))).otherwise(w))
    df = _stage(df, lambda w, k: _rules(w, k, SNOWBALL_2, lambda p, s: inside(p, r1) & (
        p.endswith("l") if s == "ogi" else p.rlike("[cdeghkmnrt]$") if s == "li" else F.lit(True))))
    df = _stage(df, lambda w, k: _rules(w, k, SNOWBALL_3, lambda p, s: inside(p, r2) if s == "ative" else inside(p, r1)))
    df = _stage(df, lambda w, k: _rules(w, k, [(s, "") for s in SNOWBALL_4], lambda p, s: inside(p, r2) & (
        p.rlike("[st]$") if s == "ion" else F.lit(True))))
    end = lambda k: _rest(k, "e")
    syllable = lambda k: _short_end(k) | k.rlike(f"^{V}{C}$")
    df = _stage(df, lambda w, k: F.when(w.endswith("e") & (inside(end(k), r2) | (inside(end(k), r1) & ~syllable(end(k)))), end(w))
                .when(w.endswith("ll") & inside(end(k), r2), end(w)).otherwise(w))
    return df.withColumn(out, F.coalesce("_fixed", "_w")).drop("_w", "_k", "_live", "_fixed", "_r1", "_r2", "_tail", "_was", "_cut")
