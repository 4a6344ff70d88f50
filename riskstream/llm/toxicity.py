"""Toxicity of whole texts by weak supervision.

Voters are lexicon entries (words) and patterns (one, two or three words with the same
beginning) that the labelled sample ties to toxic texts. A generative model of their votes, fitted by expectation
maximisation without the labels of single texts, estimates each voter's accuracy and
the correlations between voters, by which voters that repeat each other count less. Its
posterior labels train a linear classifier on words and patterns, which scores every
text.

The fit uses a bounded sample of labelled rows, SAMPLE documents, half of them toxic if
there are so many (those with the lowest hash of id), VOTERS voters and FEATURES
features at most. Scoring reads every text whole.

Defined results: a null or empty text has no features and the score that comes with
none; a row labelled twice counts as toxic if any label says so; of texts that repeat an id the
smallest is learned from; without a
labelled row of either kind nothing is learned and every score is 0; repeated rows each
give a row. A column to keep that has the name
of a result gives way to it; other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskstream.llm.kept import ROW, carried, restored
from riskstream.llm.workers import held, small_batches

#: Bounds of the fit: labelled documents, voters, features.
SAMPLE, VOTERS, FEATURES = 12_000, 300, 2_000
#: A voter votes in this many toxic texts at least, and among as many toxic as other texts at most this share of its votes is wrong.
LEAST, WRONG = 5, 0.02
#: Lengths of the beginnings of words, and up to how many words with one are told apart (``abc*2``: two or more).
BEGINNINGS, TIMES = range(3, 8), 3
#: Voters below this correlation count as independent: texts share a topic or language, which correlates all its voters a little.
CORRELATED = 0.5
#: Texts that a feature occurs in, at least.
SEEN = 3
#: Difference in frequency between the two kinds of texts, in standard deviations, that makes a term a feature.
TELLING = 0.05
#: Words whose features a Python worker keeps.
REMEMBERED = 300_000

_WORD = re.compile(r"[^\W_]+")


def word_counts(text: str) -> Counter:
    """How often each lower-case word occurs."""
    if len(text) < 1 << 20:
        return Counter(_WORD.findall(text.lower()))
    counted, matches = Counter(), _WORD.finditer(text)
    while some := [m.group().lower() for m in islice(matches, 1 << 16)]:
        counted.update(some)
    return counted


def beginnings(word: str) -> list[str]:
    return [word[:k] for k in BEGINNINGS if k <= len(word)]


def terms(text: str) -> list[str]:
    """The words of a text and the patterns that fit it."""
    counted, started = word_counts(text), Counter()
    for word, n in counted.items():
        for start in beginnings(word):
            started[start] += n
    return [*counted, *(f"{start}*{k}" for start, n in started.items() for k in range(1, min(n, TIMES) + 1))]


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of terms, and what is added to them; None if nothing could be learned."""

    weights: dict[str, float]
    offset: float | None


def label_model(votes: np.ndarray, share: float, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fit the votes (texts x voters, cast or not) with a class that is true for about ``share`` of the texts.

    A last voter is added that speaks for the other class where no one has voted; not to
    vote says nothing else. Returns how often each voter votes on texts of the class and on
    others, the correlations of voters within a class, and each text's probability of being of the
    class. A voter's weight is the inverse of the sum of its correlations, those
    below CORRELATED left out, so that copies of one voter weigh as one.
    """
    votes = np.column_stack([votes, ~votes.any(axis=1)]).astype(np.float64)
    n, m = votes.shape
    share = min(max(share, 0.01), 0.99)
    p = np.where(votes[:, -1] > 0, 0.02, 0.95)
    correlations, true, false = np.eye(m), np.zeros(m), np.zeros(m)
    for _ in range(rounds):
        true = (p @ votes + 0.01) / (p.sum() + 1)
        false = ((1 - p) @ votes + 0.01) / ((1 - p).sum() + 1)
        rest = votes - np.outer(p, true) - np.outer(1 - p, false)
        rest /= np.sqrt((rest**2).mean(axis=0)) + 1e-9
        correlations = rest.T @ rest / n
        correlations[correlations < max(CORRELATED, 4 / np.sqrt(n))] = 0
        np.fill_diagonal(correlations, 1)
        said = votes @ (np.log(true / false) / correlations.sum(axis=1))
        p = 1 / (1 + np.exp(-np.clip(said + np.log(share / (1 - share)), -30, 30)))
    return true, false, correlations, p


def linear_classifier(rows: np.ndarray, columns: np.ndarray, n: int, m: int, target: np.ndarray, rounds: int = 300, penalty: float = 1e-4, step: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by gradients with a step for each weight (Adam).

    Features are 0 or 1, given by the places of the ones.
    """
    weight = np.zeros(m + 1)  # the last one is the offset
    mean, square = np.zeros(m + 1), np.zeros(m + 1)
    for at in range(1, rounds + 1):
        said = np.bincount(rows, weights=weight[columns], minlength=n) + weight[-1]
        wrong = 1 / (1 + np.exp(-np.clip(said, -30, 30))) - target
        slope = np.append(np.bincount(columns, weights=wrong[rows], minlength=m) / n + penalty * weight[:-1], wrong.mean())
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        weight -= step * (mean / (1 - 0.9**at)) / (np.sqrt(square / (1 - 0.99**at)) + 1e-8)
    return weight[:-1], float(weight[-1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """A model of the labelled texts."""
    small_batches(docs.sparkSession)
    by_key = labels.select(F.col(key).alias("key"), F.col(label).alias("toxic")).dropna().groupBy("key").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for side in (1, 0):
        some = by_key.where(F.col("toxic") == side).orderBy(F.xxhash64("key"), "key").limit(sample // 2)
        chosen = some if chosen is None else chosen.unionByName(some)
    # as many rows as the sample at most
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # of texts that repeat a key the smallest counts
    texts = texts.join(F.broadcast(chosen), "key").groupBy("key", "toxic").agg(F.min("text").alias("text")).cache()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = (Counter(), Counter())
            for toxic, body in zip(batch.column("toxic"), batch.column("text")):
                counted[toxic.as_py() == 1].update(terms(body.as_py()))
            clean, toxic = counted
            both = list(clean | toxic)
            yield pa.RecordBatch.from_arrays([pa.array(both, pa.string()), *(pa.array([c[t] for t in both], pa.int64()) for c in (toxic, clean))], ["term", "toxic", "clean"])

    n = {row["toxic"] == 1: row["n"] for row in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(True, 0), n.get(False, 0)
    if not n_toxic or not n_clean:
        texts.unpersist()
        return ToxicityModel({}, None)
    counted = texts.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    seen = counted.where(F.col("toxic") + F.col("clean") >= SEEN).cache()
    rate, rate_clean = F.col("toxic") / n_toxic, F.col("clean") / n_clean
    good = seen.where((F.col("toxic") >= LEAST) & (rate_clean <= WRONG * (rate + rate_clean)))
    voters = [r["term"] for r in good.orderBy(F.desc(rate - rate_clean), "term").limit(VOTERS).collect()]
    pooled = (F.col("toxic") + F.col("clean") + 1) / (n_toxic + n_clean + 2)
    strength = F.abs(rate - rate_clean) / F.sqrt(pooled * (1 - pooled))
    features = [r["term"] for r in seen.where(strength > TELLING).orderBy(F.desc(strength), "term").limit(FEATURES).collect()]
    index = {t: i for i, t in enumerate(dict.fromkeys([*voters, *features]))}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(index[t] for t in terms(body.as_py()) if t in index) for body in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key").cast(pa.string()), pa.array(rows, pa.list_(pa.int32()))], ["key", "at"])

    # a row of small numbers for each text of the sample, in a fixed order
    found = [r["at"] for r in texts.select(F.col("key").cast("string").alias("key"), "text").mapInArrow(find, "key string, at array<int>").orderBy("key").collect()]
    seen.unpersist()
    texts.unpersist()
    rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
    columns = np.fromiter((i for x in found for i in x), np.int64, len(rows))
    votes = np.zeros((len(found), len(voters)), bool)
    cast = columns < len(voters)
    votes[rows[cast], columns[cast]] = True
    *_, posterior = label_model(votes, n_toxic / (n_toxic + n_clean))
    weights, offset = linear_classifier(rows, columns, len(found), len(index), posterior)
    return ToxicityModel({t: float(weights[i]) for t, i in index.items()}, float(offset))


class Scorer:
    """Looks up a word's own weight and the patterns it counts for once, and keeps them."""

    def __init__(self, model: ToxicityModel):
        self.offset = model.offset
        self.words = {t: w for t, w in model.weights.items() if "*" not in t}
        #: beginning -> what is added with 1, 2, ... words that have it
        self.patterns: dict[str, list[float]] = {}
        for term, w in model.weights.items():
            start, _, times = term.rpartition("*")
            if start:
                self.patterns.setdefault(start, [0.0] * (TIMES + 1))[int(times)] = w
        for steps in self.patterns.values():
            steps[:] = np.cumsum(steps).tolist()
        self.known: dict[str, tuple[float, list[str]]] = {}

    def _look_up(self, word: str) -> tuple[float, list[str]]:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.known[word] = (self.words.get(word, 0.0), [s for s in beginnings(word) if s in self.patterns])
        return found

    def score(self, text: str) -> float:
        if self.offset is None:
            return 0.0
        said, started = [self.offset], {}
        for word, n in word_counts(text).items():
            weight, starts = self.known.get(word) or self._look_up(word)
            if weight:
                said.append(weight)
            for start in starts:
                started[start] = started.get(start, 0) + n
        said += [self.patterns[start][min(n, TIMES)] for start, n in started.items()]
        return float(1 / (1 + np.exp(-min(max(math.fsum(said), -30.0), 30.0))))


def score(df: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text") -> DataFrame:
    """The score of each text next to the columns to keep."""
    sent = small_batches(df.sparkSession).sparkContext.broadcast(model)
    kept, row = carried(keep, ["score"])
    # a text that is kept travels once
    rows = df.select(row) if text in kept else df.select(row, F.col(text).alias("text"))
    schema = StructType([rows.schema[ROW], StructField("score", DoubleType())])

    def score_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(sent.value, Scorer)
        for batch in batches:
            out = pa.array([scorer.score(x.as_py() or "") for x in (batch.column(ROW).field(text) if text in kept else batch.column("text"))], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(ROW), out], [ROW, "score"])

    return restored(rows.mapInArrow(score_all, schema), kept, ["score"])
