"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses.  A lexicon turns the words into symbols: insult, threat, target, negation,
report, other.  Three small transducers read the symbols: one knows whether an insult or threat is aimed
at a target, one whether a negation stands shortly before it, one whether the clause reports what somebody
said.  They are composed to a single machine whose arcs emit, for every insult or threat, the kind of
match it is; the weight of the word goes to that kind.  What a kind of match counts for, and the weight of
each insult, are learned from labels, so that a negated insult can count for less than an aimed one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators import materialise

#: Labelled rows to learn from, about; half give the lexicon, half the weights of the kinds.
LABELLED = 20_000
LEXICON = 3_000
SUPPORT = 6
STEMS = (4, 5, 6, 7)  # letters of a word that may stand for all words beginning so

# Closed word classes in English, German, French and Spanish.
TARGET = set("you your yours yourself u du dich dir dein deine ihr euch euer tu te toi ton ta vous votre "
             "usted ustedes tus vosotros he she him her they them er sie ihn il elle ils elles el ella "
             "ellos ellas".split())
NEGATION = set("not never no none nobody isn't aren't don't doesn't didn't nicht nie kein keine keinen "
               "pas jamais ne aucun nunca jamas tampoco".split())
REPORT = set("said says say told tells wrote writes claimed reported quoted sagte sagt schrieb "
             "behauptete dit disait écrit raconte dijo dice dicen escribió contó".split())
THREAT = set("kill hurt beat burn destroy shoot stab punish töten umbringen schlagen verletzen tuer "
             "frapper brûler détruire matar golpear quemar destruir".split())
INSULT_, THREAT_, TARGET_, NEGATION_, REPORT_, OTHER_ = range(6)

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[.!?;:\n]+")


class Transducer:
    """States 0 upward, 0 first; ``step(state, symbol)`` gives the next state and what the arc says."""

    def __init__(self, states: int, step):
        self.arcs = {(s, a): step(s, a) for s in range(states) for a in range(6)}
        self.states = states


def _compose(machines: list[Transducer]) -> tuple[list[list[int]], list[list[int]]]:
    """The machines side by side on one input: next state and kind of match, by state and symbol.
    A kind is made of the bits the arcs say; 0 is none."""
    states = list(product(*[range(m.states) for m in machines]))
    number = {s: i for i, s in enumerate(states)}
    go, say = [], []
    for s in states:
        steps = [[m.arcs[x, a] for m, x in zip(machines, s)] for a in range(6)]
        go.append([number[tuple(t for t, _ in st)] for st in steps])
        say.append([sum(bit << k for k, (_, bit) in enumerate(st)) for st in steps])
    return go, say


#: A target was seen in the clause before the match (0 no, 1 yes).
AIMED = Transducer(2, lambda s, a: (1 if a == TARGET_ else s, int(s == 1 and a in (INSULT_, THREAT_))))
#: A negation was seen within the three words before it.
NEGATED = Transducer(4, lambda s, a: (3 if a == NEGATION_ else max(0, s - 1),
                                      int(s > 0 and a in (INSULT_, THREAT_))))
#: The clause has a verb of saying before it.
REPORTED = Transducer(2, lambda s, a: (1 if a == REPORT_ else s, int(s == 1 and a in (INSULT_, THREAT_))))
KINDS = 16  # aimed, negated, reported, and whether it is a threat


def _entry(word: str, lexicon: dict[str, float]) -> float:
    """Weight of a word as an insult: its own, else that of its stem; 0 if it is none."""
    own = lexicon.get(word, 0.0)
    for k in STEMS:
        if len(word) > k:
            own = max(own, lexicon.get(word[:k] + "*", 0.0))
    return own


def match_kinds(text: str, lexicon: dict[str, float], machine) -> np.ndarray:
    """Summed weights of the matches of each kind, their number, and matches per 100 words."""
    go, say = machine
    out = np.zeros(KINDS + 2)
    low = text.lower()
    vocabulary = set(WORD.findall(low))
    insults = {w: v for w in vocabulary if (v := _entry(w, lexicon)) > 0}
    if not insults and vocabulary.isdisjoint(THREAT):
        return out
    found = total = 0
    for clause in CLAUSE.split(low):
        words = WORD.findall(clause)
        total += len(words)
        state = 0
        for w in words:
            a = (INSULT_ if w in insults else THREAT_ if w in THREAT else TARGET_ if w in TARGET
                 else NEGATION_ if w in NEGATION else REPORT_ if w in REPORT else OTHER_)
            if a <= THREAT_:
                out[say[state][a] + 8 * (a == THREAT_)] += insults.get(w, 1.0)
                found += a == INSULT_
            state = go[state][a]
    out[KINDS] = found
    out[KINDS + 1] = 100 * found / max(1, total)
    return np.log1p(out)


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part, words = batch.slice(i, 256), []
            for t in part.column("text"):
                own = set(WORD.findall((t.as_py() or "").lower()))
                words.append(sorted(own | {w[:k] + "*" for w in own for k in STEMS if len(w) > k}))
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(words, pa.list_(pa.string()))],
                                             names=["toxic", "entries"])


def learn_lexicon(labelled: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Words, and stems marked by a star, that toxic texts have far more often than others, with their
    log ratio; the ``size`` most frequent."""
    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return {}
    entries = labelled.select("toxic", "text").mapInArrow(_vocabulary, "toxic int, entries array<string>")
    counts = entries.select("toxic", F.explode_outer("entries").alias("entry")).groupBy("entry").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    ratio = F.log((F.col("t") + 0.5) / (n[1] + 1)) - F.log((F.col("c") + 0.5) / (n[0] + 1))
    # rarer words must be cleaner: a lower bound on the log ratio
    sure = ratio - 1.5 * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = counts.where((F.col("t") >= SUPPORT) & F.col("entry").isNotNull()).select(
        "entry", "t", ratio.alias("ratio")).where((sure > 0.5) & (ratio > 1.8))
    return {r["entry"]: r["ratio"] for r in best.orderBy(F.desc("t"), "entry").limit(size).collect()}


def _features(lexicon: dict[str, float], machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [match_kinds(t.as_py() or "", lexicon, machine) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["toxic", "x"])
    return run


def fit(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + l2 * len(y) * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + (l2 * len(y) + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _scorer(lexicon: dict[str, float], machine, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [1 / (1 + math.exp(-max(-30.0, min(30.0, float(
                match_kinds(t.as_py() or "", lexicon, machine) @ weights[:-1] + weights[-1])))))
                for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s, pa.float64())],
                                             names=["doc_id", "score"])
    return run


def drawn(labelled: DataFrame, bound: int) -> DataFrame:
    """``toxic, text`` of about ``bound`` labelled rows, or of all if there are no more."""
    taught = labelled.where("toxic in (0, 1)").select(
        F.col("toxic").cast("int").alias("toxic"), F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.xxhash64(F.lit("draw"), "doc_id", "text"), F.lit(1 << 30)).alias("draw"))
    share = bound / max(bound, taught.count())
    return taught.where(F.col("draw") < int(share * (1 << 30))).drop("draw")


def toxicity(docs: DataFrame, labelled: DataFrame, bound: int = LABELLED) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, learned from ``doc_id, text`` and ``toxic`` (0 or 1) of
    ``labelled``.

    NULL and empty texts match nothing and get the score of such texts, as do all texts when one of the
    two labels is missing.  Labelled rows with another label or none teach nothing.  Above ``bound`` rows
    a hash of id and text chooses, so of many equal texts a part; equal texts go to the same half.  Reruns agree.
    """
    sample = materialise(drawn(labelled, bound))
    half = F.pmod(F.xxhash64(F.lit("half"), "text"), F.lit(2))
    lexicon = learn_lexicon(sample.where(half == 0))
    machine = _compose([AIMED, NEGATED, REPORTED])
    rows = sample.where(half == 1).select("toxic", "text").mapInArrow(
        _features(lexicon, machine), "toxic int, x array<double>").collect()  # bounded by the sample
    weights = np.zeros(KINDS + 3)
    if rows:
        weights = fit(np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    return docs.select("doc_id", "text").mapInArrow(_scorer(lexicon, machine, weights),
                                                    "doc_id long, score double")


def _fold():
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")), F.lit(5))


def op7(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of each document, in the columns of the contract; rows with a NULL id teach nothing."""
    train = docs.select("doc_id", "text").where((_fold() != 0) & F.col("doc_id").isNotNull()).join(
        labels.select("doc_id", "toxic"), "doc_id")
    return toxicity(docs, train).select(
        "doc_id", (_fold() == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
