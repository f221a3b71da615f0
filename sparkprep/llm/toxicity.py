"""Toxicity by a weighted finite-state pattern grammar.

A document is cut into clauses, a clause into a string over a small alphabet
of word classes: insult, threat, target, negation, report, quote mark, other.
Two machines read that string. From right to left, the *ahead* transducer
rewrites every word to (class, is a target within reach ahead). From left to
right, one machine composed of four transducers reads the pairs:

* the target transducer knows whether a target (a pronoun or a form of
  address) stands within reach before;
* the announcement transducer knows whether "will", "going" and the like do,
  without which a threat verb needs a target;
* the negation transducer knows whether a negation does;
* the reported-speech transducer knows whether a reporting verb came before,
  or quotation marks are open.

``compose`` builds the product: its states are the reachable combinations of
the four, and a transition on an insult or a threat emits one clause type,
(core, directed, negated, reported). Clause types, not words, are scored: each
carries a weight, and the score is the logistic of the weighted counts. A stem
that also occurs in clean texts is a weak insult: it has clause types of its
own, which tell by their number. A type that is negated or reported never has a weight above 0, so
such clauses alone leave a text where one without any match is.

Insult words come from two places: a short fixed list, and stems learned from
the labels. A stem (leading letters of a word) enters when it occurs in at
least ``min_support`` toxic rows and is ``min_log_odds`` likelier in toxic
rows; a greedy cover, which charges a stem for the clean rows it occurs in, keeps
only stems that explain ``min_explained`` different toxic texts no earlier
stem explains, so that the chance words of a copied toxic text stay out. Weights
are a regularised logistic fit of the clause types. Both use at most ``max_train`` labelled rows
(in the order of a hash of their id), none of them marked by ``held_out``;
ids, languages and sources are never read. Scoring is a map over the scan.

Null and empty texts have no clause and get the score of a text without a
match. Without labelled rows the fixed list and the default weights apply.
Rows may repeat; each is scored by itself, over its whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, held_out
from .quality import label_sample

MAX_TRAIN = 20_000
THRESHOLD = 0.3
MIN_SUPPORT = 8
MIN_LOG_ODDS = 2.5
MIN_EXPLAINED = 3  # distinct toxic texts that a further stem must explain
CLEAN_COST = 5  # texts a stem must explain for each clean row it occurs in
STEM_LENGTHS = (4, 5, 6, 7)
RECURRENCES = (2, 3)  # "s@n": a stem that tells toxicity where n clauses hold it

# Word lists of the grammar (English, German, French, Spanish).
INSULTS = """idiot moron stupid loser scum trash worthless pathetic disgusting clown
idioten dumm abschaum wertlos ekelhaft imbécile stupide ordure minable dégoûtant
estúpido imbécil basura patético asqueroso""".split()
THREATS = """kill hurt destroy beat burn shoot attack töten umbringen verletzen zerstören
tuer blesser détruire frapper matar herir destruir golpear""".split()
ANNOUNCE = "will gonna going shall werde werden wird vais va vamos voy".split()
TARGETS = """you your yourself he she they him her them his their these those
du dich dir dein ihr euch sie tu toi te ton vous votre tú ti tu usted ustedes ellos ellas""".split()
NEGATIONS = """not no never nobody cannot without isn't aren't don't nicht kein keine nie niemals
pas jamais aucun sans nunca jamás sin ningún""".split()
REPORTS = """said says saying told tells reported reports claimed claims wrote writes quoted called
sagte sagt behauptet schrieb zitiert dit disait affirme écrit dijo dice afirma escribió""".split()

OTHER, INSULT, THREAT, WILL, TARGET, NEGATION, REPORT, QUOTE, WEAK = range(9)

_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"«»„“”]|[.!?;\n]")
_BREAK = frozenset(".!?;\n")
_QUOTES = frozenset("\"«»„“”")
REACH = 4  # words between a core and its target or negation


@dataclass
class Transducer:
    """A finite-state transducer with weights on its outputs: ``step`` maps
    (state, class) to (state, output); a missing entry goes to ``rest``."""
    start: int
    step: dict
    rest: dict = field(default_factory=dict)

    def __call__(self, state: int, symbol: int):
        return self.step.get((state, symbol)) or self.rest.get(state, (state, 0))


def _within(trigger: int, reach: int) -> Transducer:
    """Outputs 1 for ``reach`` words after ``trigger``: state = words left."""
    step = {(s, trigger): (reach, 1) for s in range(reach + 1)}
    rest = {s: (s - 1, 1) for s in range(1, reach + 1)} | {0: (0, 0)}
    return Transducer(0, step, rest)


NEGATED = _within(NEGATION, REACH)
ANNOUNCED = _within(WILL, REACH)
TARGETED = _within(TARGET, REACH)
AHEAD = _within(TARGET, REACH)  # read from right to left
#: state 0 plain, 1 after a reporting verb, 2 inside quotation marks
REPORTED = Transducer(0, {(0, REPORT): (1, 1), (0, QUOTE): (2, 1), (1, QUOTE): (2, 1), (2, QUOTE): (0, 0)},
                      {0: (0, 0), 1: (1, 1), 2: (2, 1)})

#: clause types: core (insult, threat, weak insult) x directed x negated x reported
CORES = {INSULT: 0, THREAT: 1, WEAK: 2}
N_TYPES = len(CORES) * 2 * 2 * 2
CLASSES = 9
NOTHING = -1


def clause_type(symbol: int, ahead: int, negated: int, announced: int, before: int, reported: int) -> int:
    """What the composed machine emits on a word, from its parts' outputs."""
    directed = before or ahead
    if symbol not in CORES or (symbol == THREAT and not (announced or directed)):
        return NOTHING
    return CORES[symbol] * 8 + (1 if directed else 0) * 4 + negated * 2 + reported


def compose(*parts: Transducer) -> tuple[list[list[int]], list[list[int]]]:
    """The product of left-to-right transducers over the alphabet (class,
    target ahead): next state and emitted clause type by state and letter
    2 * class + ahead. State 0 is the start; only reachable states exist."""
    states = {tuple(p.start for p in parts): 0}
    todo, move, emit = list(states), [], []
    for state in todo:  # grows while states are found
        to, out = [], []
        for symbol in range(CLASSES):
            steps = [p(q, symbol) for p, q in zip(parts, state)]
            after = tuple(q for q, _ in steps)
            if after not in states:
                states[after] = len(states)
                todo.append(after)
            for ahead in (0, 1):
                to.append(states[after])
                out.append(clause_type(symbol, ahead, *(o for _, o in steps)))
        move.append(to)
        emit.append(out)
    return move, emit


MOVE, EMIT = compose(NEGATED, ANNOUNCED, TARGETED, REPORTED)


def clause_types(symbols: list[int]) -> list[int]:
    """Clause types that the two machines emit for one clause."""
    letters, s = [0] * len(symbols), AHEAD.start
    for k in range(len(symbols) - 1, -1, -1):
        s, mark = AHEAD(s, symbols[k])
        letters[k] = 2 * symbols[k] + mark
    found, state = [], 0
    for letter in letters:
        kind = EMIT[state][letter]
        if kind != NOTHING:
            found.append(kind)
        state = MOVE[state][letter]
    return found


class Lexicon:
    """Word classes: fixed lists, and insult stems by their length. A stem
    given as "s@n" is a weak one."""

    def __init__(self, stems: list[str] = ()):
        fixed = [(INSULTS, INSULT), (THREATS, THREAT), (ANNOUNCE, WILL), (TARGETS, TARGET),
                 (NEGATIONS, NEGATION), (REPORTS, REPORT)]
        self.words = {w: c for ws, c in fixed for w in ws}
        self.stems = frozenset(s for s in stems if "@" not in s)
        self.weak = frozenset(s.split("@")[0] for s in stems if "@" in s) - self.stems
        self.lengths = sorted({len(s) for s in self.stems | self.weak})
        self._seen: dict[str, int] = {}

    def __getstate__(self):
        return {**self.__dict__, "_seen": {}}

    def of(self, token: str) -> int:
        c = self._seen.get(token)
        if c is None:
            c = self.words.get(token, OTHER)
            if token in _QUOTES:
                c = QUOTE
            elif c == OTHER and any(token[:n] in self.stems for n in self.lengths):
                c = INSULT
            elif c == OTHER and any(token[:n] in self.weak for n in self.lengths):
                c = WEAK
            if len(self._seen) > 200_000:
                self._seen.clear()
            self._seen[token] = c
        return c


def clause_counts(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """Matched clauses of a text by type."""
    out = np.zeros(N_TYPES)
    clause, core = [], False
    seen, of = lexicon._seen, lexicon.of
    for token in _TOKEN.findall((text or "").lower()) + [";"]:
        if token in _BREAK:
            if core:
                for k in clause_types(clause):
                    out[k] += 1
            clause, core = [], False
            continue
        c = seen.get(token)
        if c is None:
            c = of(token)
        clause.append(c)
        core = core or c in CORES
    return out


def _vector(counts: np.ndarray) -> np.ndarray:
    """Counts of the clause types: one plain insult or threat tells most,
    weak insults tell by their number."""
    return np.where(IS_WEAK, np.minimum(counts, 4) / 4, 1 - 0.5 ** counts)


N_FEATURES = N_TYPES
IS_WEAK = np.arange(N_TYPES) >= 8 * CORES[WEAK]
#: types whose clause is negated or reported
DENIED = np.array([bool(k & 3) for k in range(N_TYPES)])


@dataclass
class Grammar:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights @ _vector(clause_counts(text, self.lexicon)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def default_weights() -> tuple[np.ndarray, float]:
    """Weights before any label is seen: a plain match counts, a directed one
    more, negated and reported ones not at all."""
    directed = np.array([bool(k & 4) for k in range(N_TYPES)])
    return np.where(DENIED, 0.0, np.where(IS_WEAK, 6.0, 7.0) + 2.0 * directed), -3.0


def _newton(x: np.ndarray, y: np.ndarray, free: np.ndarray, ridge: float, rounds: int) -> np.ndarray:
    """Ridge logistic regression on the free coefficients, pulled to the
    defaults; the others are 0. The last coefficient is the bias."""
    w0, b0 = default_weights()
    prior = np.r_[w0, b0][free]
    a = np.c_[x, np.ones(len(x))][:, free]
    pull = np.where(np.arange(N_FEATURES + 1)[free] == N_FEATURES, 1e-3, ridge)
    theta = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -30, 30)))
        grad = a.T @ (p - y) + pull * (theta - prior)
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag(pull)
        move = np.linalg.solve(hess, grad)
        theta -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    out = np.zeros(N_FEATURES + 1)
    out[free] = theta
    return out


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights by clause type and the bias. Plain types weigh 0 or more,
    negated and reported ones 0 or less: what breaks that is held at 0 and
    the rest is fitted again."""
    free = np.ones(N_FEATURES + 1, bool)
    while True:
        theta = _newton(x, y, free, ridge, rounds)
        wrong = free & np.r_[np.where(DENIED, theta[:-1] > 1e-9, theta[:-1] < -1e-9), False]
        if not wrong.any():
            plain = theta[:-1].reshape(-1, 2, 4)[:, :, 0]  # by core: without a target, with one
            plain[:, 1] = plain.max(1)  # a target never speaks for a clause
            return theta[:-1], float(theta[-1])
        free &= ~wrong


def _stems(token: str):
    for n in STEM_LENGTHS:
        if len(token) > n:
            yield token[:n]
    if len(token) >= STEM_LENGTHS[0]:
        yield token


def _stem_sets(text: str | None) -> set[str]:
    """Stems of the words of a text, with "@n" where n clauses hold one."""
    n, clause = Counter(), set()
    for t in _TOKEN.findall((text or "").lower()) + [";"]:
        if t in _BREAK:
            n.update(s for w in clause for s in set(_stems(w)))
            clause = set()
        elif t not in _QUOTES:
            clause.add(t)
    return set(n) | {f"{s}@{m}" for s, k in n.items() for m in RECURRENCES if k >= m}


def _count_stems(batches):
    """Per task: (stem, toxic rows, clean rows)."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (toxic if y > 0.5 else clean).update(_stem_sets(t))
    keys = list(toxic.keys() | clean.keys())
    for lo in range(0, len(keys), 50_000):
        part = keys[lo:lo + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([toxic[k] for k in part], pa.int64()),
             pa.array([clean[k] for k in part], pa.int64())], names=["stem", "toxic", "clean"])


def learn_stems(rows: DataFrame, min_support: int = MIN_SUPPORT, min_log_odds: float = MIN_LOG_ODDS,
                min_explained: int = MIN_EXPLAINED) -> list[str]:
    """Stems that explain toxic rows of the (bounded) frame ``rows(y, t)``."""
    n = rows.agg(F.sum(F.when(F.col("y") > 0.5, 1).otherwise(0)), F.count("*")).first()
    n_toxic, n_clean = n[0] or 0, (n[1] or 0) - (n[0] or 0)
    if not n_toxic or not n_clean:
        return []
    counted = (rows.mapInArrow(_count_stems, "stem string, toxic long, clean long")
                   .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    odds = (F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1)))
    likely = counted.where((F.col("toxic") >= min_support) & (odds >= min_log_odds))
    # at most (toxic words of max_train rows) / min_support rows
    clean = {r["stem"]: r["clean"] for r in likely.collect()}
    wanted = frozenset(clean)
    if not wanted:
        return []

    def incidence(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(_stem_sets(t) & wanted) for t in batch.column(1).to_pylist()],
                          pa.list_(pa.string()))], names=["stems"])

    # copies of a text count once
    held = [frozenset(r["stems"]) for r in
            rows.where("y > 0.5").mapInArrow(incidence, "stems array<string>").distinct().collect()]
    held.sort(key=sorted)
    chosen: list[str] = []
    # the second cover finds the stems that mostly occur beside a chosen one
    for need in (min_explained, 5 * min_explained):
        bare = [c.split("@")[0] for c in chosen]
        new = {s for s in wanted if not any(s.startswith(c) or c.startswith(s.split("@")[0]) for c in bare)}
        chosen += _cover([h & new for h in held], clean, need)
    return chosen


def _cover(held: list, clean: dict, need: int) -> list[str]:
    """Greedy: the stem that explains most unexplained texts comes next."""
    left = Counter(s for h in held for s in h)
    chosen = []
    while left:
        best = max(left, key=lambda s: (left[s] - CLEAN_COST * clean[s], "@" not in s, len(s), s))
        if left[best] - CLEAN_COST * clean[best] < need:
            break
        chosen.append(best)
        rest = []
        for h in held:
            if best in h:
                left.subtract(h)
            else:
                rest.append(h)
        held = rest
        del left[best]
    return chosen


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", max_train: int = MAX_TRAIN, min_support: int = MIN_SUPPORT,
          min_log_odds: float = MIN_LOG_ODDS) -> Grammar:
    """Learn insult stems and clause weights from at most ``max_train``
    labelled documents of the training folds."""
    sample = label_sample(labels, label_col, max_train)
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
                .join(F.broadcast(sample), "doc_id").select("y", "t"))
    lexicon = Lexicon(INSULTS + learn_stems(rows, min_support, min_log_odds))

    def vectors(batches):
        for batch in batches:
            v = [_vector(clause_counts(t, lexicon)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tolist() for x in v],
                                                                        pa.list_(pa.float64()))], names=["y", "x"])

    # equal rows are counted, so at most max_train of them come back
    got = (rows.mapInArrow(vectors, "y double, x array<double>").groupBy("y", "x").count()
               .orderBy("y", "x").limit(max_train).collect())
    if not got:
        return Grammar(lexicon, *default_weights())
    times = np.array([r["count"] for r in got])
    x = np.repeat(np.array([r["x"] for r in got]), times, axis=0)
    y = np.repeat(np.array([r["y"] for r in got]), times)
    return Grammar(lexicon, *_fit(x, y))


def score_documents(docs: DataFrame, grammar: Grammar, *, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and the prediction of every row."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches):
        g = held.value
        for batch in batches:
            s = np.array([g.score(t.as_py()) for t in batch.column(2)], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()),
                 pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    source = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                         F.col(text_col).alias("t"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
