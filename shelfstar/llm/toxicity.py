"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read a clause as a string of word classes and pass a weight on: target tells whether abuse is
aimed at someone near, insult raises the weight of a word that is, threat passes only a verb with a person near,
negation and reported speech lower the weight. Targets stand before or after, so the clause is first read from its
end by insult and threat, and abuse with one ahead is a class of its own. They are composed by running them side by
side; pairs of composed state and class are determinised when first met. A document's score comes from its matched
clauses (sum, strongest, number, for insults and threats each), calibrated by a logistic regression, and not from
words alone. An insult without a target is a match of plain weight; a threat word without a person is none.

Weights of insults and threats beyond the fixed ones are learned: log odds of each word over all labelled
training documents, words being kept that enough toxic documents hold. The lexicon is a top-k list of
``LEXICON`` words and the regression is fitted on at most ``SAMPLE`` labelled rows drawn by a hash of the text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import whole

LEXICON, SAMPLE = 1024, 6000
#: A learned word is in so many toxic documents at least: a number, and a share of them all.
LEAST_SUPPORT, LEAST_SHARE, LEAST_LOG_ODDS = 3, 0.004, 2.0
LONGEST_WORD = 40

# Closed word classes of the grammar.
THREATS = ("kill kills killed killing murder murders murdered murdering hurt hurts hurting destroy destroys destroyed destroying "
           "beat beats beaten beating stab stabs stabbed stabbing shoot shoots shot shooting strangle strangles strangled strangling crush crushes crushed crushing "
           "töten töte tötest tötet tötete töteten getötet umbringen umbringe umbringst umbringt umbrachte umgebracht umzubringen verletzen verletze verletzt verletzte verletzten "
           "tuer tue tues tuons tuez tuent tué tuée tués tuées tuerai tueras tuera tuerons tuerez tueront "
           "frapper frappe frappes frappons frappez frappent frappé frappée frappés frapperai frappera frapperons frapperont "
           "détruire détruis détruit détruisons détruisez détruisent détruite détruirai détruira détruirons détruiront "
           "matar mato matas mata matamos matan mataré matará mataremos matarán maté mató mataron matado "
           "golpear golpeo golpeas golpea golpean golpearé golpeará golpearemos golpearán golpeé golpeó golpeado "
           "destruir destruyo destruyes destruye destruyen destruiré destruirá destruiremos destruirán destruí destruyó destruido")
#: Threats that hold their person.
AIMED_THREATS = "matarte mataros matarle matarles golpearte golpearos golpearle golpearles destruirte destruiros destruirle destruirles"
TARGETS = ("you your yours yourself u he him his she her they them their this that these those all everyone people "
           "du dich dir dein euch ihr sie tu toi te ton vous votre vos ils elles usted ustedes tú ti su sus ellos ellas")
#: Targets that aren't people by themselves: pointers, possessives.
NO_PERSONS = "your yours his their this that these those all dein ton votre vos su sus"
NEGATIONS = "not no never isn't aren't wasn't weren't don't doesn't didn't won't can't nicht kein keine nie niemals pas jamais ni nunca jamás tampoco"
REPORTS = "said says say wrote writes claims claimed quoted called reported sagte schrieb behauptet dit écrit prétend dijo escribió afirma"
QUOTES = '"“”„«»'

_PIECE = re.compile(rf"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n{QUOTES}]")
_ENDS = frozenset(".!?;:\n")


INSULT, THREAT = ("insult", "aimed insult"), ("threat", "aimed threat")
_ABUSE = frozenset(INSULT + THREAT)


class Targeting:
    """State: words left in which one of ``seen`` is near."""

    start = 0
    seen: tuple[str, ...] = ("person", "target")

    @classmethod
    def next(cls, state: int, kind: str) -> int:
        return 6 if kind in cls.seen else max(0, state - 1)


class Insulting(Targeting):
    """An insult near a target, on either side, weighs more."""

    @classmethod
    def step(cls, state: int, kind: str) -> tuple[int, float]:
        return cls.next(state, kind), 1.25 if kind in INSULT and (state or kind == INSULT[1]) else 1.0


class Threatening(Targeting):
    """A threat is a verb and a person near, on either side; the verb alone has no weight."""

    seen = ("person",)

    @classmethod
    def step(cls, state: int, kind: str) -> tuple[int, float]:
        return cls.next(state, kind), (1.25 if state or kind == THREAT[1] else 0.0) if kind in THREAT else 1.0


class Negation:
    """State: words left in the scope of a negation."""

    start = 0

    @staticmethod
    def step(state: int, kind: str) -> tuple[int, float]:
        if kind == "negation":
            return 3, 1.0
        return max(0, state - 1), 0.3 if kind in _ABUSE and state else 1.0


class Reporting:
    """State: 1 after a verb of saying, 2 inside its quotation marks. What others said weighs less there."""

    start = 0

    @staticmethod
    def step(state: int, kind: str) -> tuple[int, float]:
        if kind == "report":
            return max(state, 1), 1.0
        if kind == "quote":
            return (2 if state == 1 else 0), 1.0
        return state, 0.5 if kind in _ABUSE and state == 2 else 1.0


class Composition:
    """The transducers side by side, determinised as far as met."""

    def __init__(self, *parts: type):
        self._parts = parts
        self.start = tuple(p.start for p in parts)
        self._moves: dict[tuple, tuple[tuple, float]] = {}

    def step(self, state: tuple, kind: str) -> tuple[tuple, float]:
        known = self._moves.get((state, kind))
        if known is None:
            moves = [p.step(s, kind) for p, s in zip(self._parts, state)]
            known = self._moves[state, kind] = tuple(s for s, _ in moves), math.prod(w for _, w in moves)
        return known


@dataclass
class Grammar:
    """``weights``: of insult and threat words."""

    weights: dict[str, float]
    classes: dict[str, str] = field(init=False)

    def __post_init__(self) -> None:
        threats = THREATS.split() + AIMED_THREATS.split()
        self.weights = dict.fromkeys(threats, 1.5) | self.weights
        closed = {"person": TARGETS, "target": NO_PERSONS, "negation": NEGATIONS, "report": REPORTS}
        self.classes = {w: kind for kind, words in closed.items() for w in words.split()}
        self.classes |= dict.fromkeys(QUOTES, "quote") | dict.fromkeys(self.weights, "insult")
        self.classes |= dict.fromkeys(threats, "threat") | dict.fromkeys(AIMED_THREATS.split(), "aimed threat")
        self._rules = Composition(Insulting, Threatening, Negation, Reporting)
        self._back = Composition(Insulting, Threatening)

    def _aimed(self, kinds: list[str]) -> list[str]:
        """Classes of a clause, those of abuse with a target ahead being aimed: it is read from its end."""
        told, state = [], self._back.start
        for kind in reversed(kinds):
            told.append(INSULT[1] if kind == "insult" and state[0] else THREAT[1] if kind == "threat" and state[1] else kind)
            state, _ = self._back.step(state, kind)
        return told[::-1]

    def matches(self, text: str | None) -> list[tuple[float, float]]:
        """Weights of insults and of threats in each matched clause of the whole text."""
        pieces = _PIECE.findall(text.lower()) if text else []
        if self.weights.keys().isdisjoint(pieces):
            return []
        found, clause, state, step = [], [], self._rules.start, self._rules.step
        for piece in [*pieces, "\n"]:
            if piece not in _ENDS:
                clause.append(piece)
                continue
            kinds = [self.classes.get(p, "word") for p in clause]
            insults = threats = 0.0
            for word, kind in zip(clause, kinds if _ABUSE.isdisjoint(kinds) else self._aimed(kinds)):
                state, weight = step(state, kind)
                if kind in INSULT:
                    insults += weight * self.weights[word]
                elif kind in THREAT:
                    threats += weight * self.weights[word]
            if insults or threats:
                found.append((insults, threats))
            # a quotation goes on over the end of a clause, scopes don't
            clause, state = [], (*self._rules.start[:-1], state[-1] if state[-1] == 2 and piece != "\n" else 0)
        return found

    def clauses(self, text: str | None) -> list[float]:
        """Weight of each matched clause of the whole text."""
        return [insults + threats for insults, threats in self.matches(text)]

    def features(self, text: str | None) -> list[float]:
        """Sum, strongest and number of the matched clauses, for insults and then for threats."""
        found = self.matches(text)
        kinds = [[w[k] for w in found if w[k]] for k in (0, 1)]
        return [x for own in kinds for x in (math.log1p(sum(own)), math.log1p(max(own, default=0.0)), math.log1p(len(own)))]


#: Numbers that a text is scored by.
FEATURES = 6


@dataclass
class Model:
    grammar: Grammar
    bias: float
    slopes: np.ndarray

    def score(self, text: str | None) -> float:
        z = self.bias + float(np.dot(self.slopes, self.grammar.features(text)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def learned_weights(labelled: DataFrame, bad: int, every: int) -> dict[str, float]:
    """Log odds of the words of ``text`` by ``label`` (0 or 1), over all ``every`` rows; each row counts a word once.
    Words of a share of the ``bad`` rows are ordered, so their number is bounded by the length of these texts."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}'’]+"))
    each = labelled.select("label", F.explode(words).alias("word")).filter((F.col("word") != "") & (F.length("word") <= LONGEST_WORD))
    counts = each.groupBy("word").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("all"))
    if not bad or bad == every:
        return {}
    support = max(LEAST_SUPPORT, LEAST_SHARE * bad)
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("all") - F.col("bad") + 0.5) / (every - bad + 1.0))
    kept = counts.filter(F.col("bad") >= support).select("word", "bad", odds.alias("odds")).filter(F.col("odds") >= LEAST_LOG_ODDS)
    top = kept.orderBy((F.col("bad") * F.col("odds")).desc(), "word").limit(LEXICON)
    return {r["word"].strip("'’"): min(r["odds"], 6.0) / 4 for r in top.collect()}


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """Newton's method with a small ridge; slopes come out non-negative for features that only grow with abuse."""
    full = np.column_stack([np.ones(len(x)), x])
    w, used = np.zeros(full.shape[1]), np.ones(full.shape[1], bool)
    while True:
        a = full[:, used]
        v = np.zeros(used.sum())
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
            hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(v))
            move = np.linalg.solve(hessian, a.T @ (y - p) - ridge * v)
            v += move
            if np.abs(move).max() < 1e-8:
                break
        w[:] = 0
        w[used] = v
        if (w[1:] >= 0).all():
            return float(w[0]), w[1:]
        used[1:] &= w[1:] >= 0


def sample(labelled: DataFrame, features: Callable[[str], Column], every: int) -> list:
    """The ``SAMPLE`` rows of least hash: label, features ``x`` and number ``n`` of equal rows, the last ones cut.

    A bound on the hash, worked out from the number of rows, goes before features and order, so that what tasks send is
    about twice the sample however many they are; it is raised where many rows are equal and too few are below it.
    """
    placed, share, least = labelled.withColumn("place", F.xxhash64("text", "label")), 2 * SAMPLE / max(every, 1), -(1 << 63)
    while True:
        below = placed.filter(F.col("place") < int(least + share * (1 << 64))) if share < 1 else placed
        # texts are made numbers before they are grouped: no task holds a sample of texts
        each = below.select("place", "label", features("text").alias("x"))
        each = each.groupBy("place", "label").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("n"))
        seen = each.orderBy("place", "label").limit(SAMPLE).collect()
        if share >= 1 or sum(r["n"] for r in seen) >= SAMPLE:
            return seen
        share *= 4


def fit(rows: DataFrame, text: str = "text", label: str = "label") -> Model:
    """Model of the rows with a label of 0 or 1; a null text counts as empty. With one class only, its share is every score."""
    labelled = rows.select(whole(text).alias("text"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    bad, every = labelled.agg(F.sum("label"), F.count(F.lit(1))).first()
    grammar = Grammar(learned_weights(labelled, bad, every))

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([grammar.features(t) for t in texts], dtype=object)

    seen = sample(labelled, features, every)
    at = np.repeat(np.arange(len(seen)), [r["n"] for r in seen])[:SAMPLE]
    y = np.array([r["label"] for r in seen], float)[at]
    share = (y.sum() + 0.5) / (len(y) + 1)
    if len(set(y)) < 2:
        return Model(grammar, math.log(share / (1 - share)), np.zeros(FEATURES))
    return Model(grammar, *logistic(np.array([r["x"] for r in seen], float)[at], y))


def toxicity(text: Column, model: Model) -> Column:
    """Score from 0 to 1; a null or empty text has that of a text without a matched clause."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return of(text)
