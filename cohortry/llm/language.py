"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

Features are n-grams of one to three letters (case folded, other characters one space), hashed to ``DIMS``
places.  Document frequencies come from every training document, counted in the tasks.  The weights are
fitted on the driver by follow-the-regularised-leader with an elastic net, on a sample of about
``PER_LANG`` documents a language; most come out as zero.  A fifth of the sample is held back to set the
temperature that calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_join
from .tokens import ODD, mix

DIMS = 1 << 15
PER_LANG = 800
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.002
EPOCHS = 3
_LETTERS_TO = 0x33000


def letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(_LETTERS_TO)])


def features(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of the n-grams; none without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    alpha = letters[np.minimum(codes, _LETTERS_TO - 1)]
    if not alpha.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # runs of other characters become one space, and the text gets one at each end
    codes = np.where(alpha, codes, 32)
    codes = np.concatenate(([32], codes[alpha | np.concatenate(([False], alpha[:-1]))], [32])).astype(np.uint64)
    one = codes[codes != 32] * np.uint64(3)
    two = (codes[:-1] << np.uint64(21)) + codes[1:] * np.uint64(3) + np.uint64(1)
    three = (codes[:-2] << np.uint64(42)) + (codes[1:-1] << np.uint64(21)) + codes[2:] * np.uint64(3) \
        + np.uint64(2)
    places = mix(np.concatenate((one, two, three)) * ODD) >> np.uint64(49)
    counts = np.bincount(places.astype(np.int64), minlength=DIMS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters, seen, n = letter_table(), np.zeros(DIMS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            seen[features(text.as_py(), letters)[0]] += 1
            n += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], n))],
                                     names=["place", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = letter_table()
    for batch in batches:
        at, n = zip(*[features(t.as_py(), letters) for t in batch.column("text")]) if batch.num_rows else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("part"), pa.array([a.astype(np.int32) for a in at],
                                                                  pa.list_(pa.int32())),
             pa.array([c.astype(np.int32) for c in n], pa.list_(pa.int32()))],
            names=["lang", "part", "at", "n"])


def weigh(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(n) * idf[at]
    size = np.sqrt((x * x).sum())
    return x / size if size else x


def _softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max())
    return e / e.sum()


class Ftrl:
    """Follow-the-regularised-leader (proximal), one weight per place and class."""

    def __init__(self, classes: int):
        self.z = np.zeros((DIMS + 1, classes))
        self.n = np.zeros((DIMS + 1, classes))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = _softmax(x @ w)
        p[label] -= 1
        g = np.outer(x, p)
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def fit(rows: list, idf: np.ndarray) -> tuple[list[str], np.ndarray, float]:
    """Languages, weights (the last row is the bias) and temperature from ``(lang, part, at, n)``."""
    langs = sorted({r[0] for r in rows})
    code = {v: i for i, v in enumerate(langs)}
    data = []
    for lang, part, at, n in rows:
        at, n = np.array(at, dtype=np.int64), np.array(n, dtype=np.int64)
        if len(at):
            data.append((np.append(at, DIMS), np.append(weigh(at, n, idf), 1.0), code[lang], part))
    model = Ftrl(len(langs))
    train = [d for d in data if d[3] != 0] or data
    for _ in range(EPOCHS):
        for at, x, label, _part in train:
            model.learn(at, x, label)
    w = model.weights(np.arange(DIMS + 1))
    held = [(x @ w[at], label) for at, x, label, part in data if part == 0]

    def loss(t):
        return sum(-np.log(max(_softmax(v / t)[y], 1e-12)) for v, y in held)
    return langs, w.astype(np.float32), min(np.geomspace(0.05, 5, 40), key=loss) if held else 1.0


def _predictor(langs: list[str], w: np.ndarray, temperature: float, idf: np.ndarray):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text"):
                at, n = features(text.as_py() or "", letters)
                if not len(at) or not langs:
                    names.append("und"), scores.append(0.0)
                    continue
                p = _softmax((weigh(at, n, idf) @ w[at] + w[DIMS]) / temperature)
                best = int(p.argmax())
                names.append(langs[best]), scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])
    return predict


def identify(docs: DataFrame, train: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs``, learned from ``lang`` and ``text`` of
    ``train``.

    The score is the calibrated probability of the language; NULL texts and texts without a letter, and
    all texts where there is nothing to learn from, get ``und`` and 0.  Rows of ``train`` with a NULL
    teach nothing; those with equal texts count one by one.  The sample takes a row by a hash of its text
    and id, so reruns agree.
    """
    taught = train.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    counts = taught.select("text").mapInArrow(_frequencies, "place long, n long").groupBy("place").agg(
        F.sum("n").alias("n")).collect()  # a row for each place at most
    n = {r["place"]: r["n"] for r in counts}
    total = n.pop(-1, 0)
    idf = np.zeros(DIMS)
    for place, k in n.items():
        idf[place] = np.log((1 + total) / (1 + k)) + 1
    share = taught.groupBy("lang").agg(F.least(F.lit(1.0), per_lang / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1_000_000)) / 1e6
    sample = lookup_join(taught, share, ["lang"], 10_000).where(draw < F.col("share")).select(
        "lang", F.pmod(F.xxhash64(F.lit("part"), "doc_id", "text"), F.lit(5)).alias("part"), "text")
    rows = sample.mapInArrow(_sparse, "lang string, part long, at array<int>, n array<int>").collect()
    rows = sorted(map(tuple, rows), key=lambda r: hash((len(r[2]), r[1], tuple(r[2][:50]))))
    langs, w, t = fit(rows, idf) if rows else ([], np.zeros((DIMS + 1, 0), np.float32), 1.0)
    return docs.select("doc_id", "text").mapInArrow(
        _predictor(langs, w, t, idf), "doc_id long, lang_pred string, score double")


def _fold(n: int):
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")), F.lit(n))


def op2(docs: DataFrame) -> DataFrame:
    """Language of each document, in the columns of the contract; NULL ids are in no fold that teaches."""
    train = docs.where((_fold(3) != 1) & F.col("doc_id").isNotNull())
    return identify(docs, train).select(
        "doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score")
