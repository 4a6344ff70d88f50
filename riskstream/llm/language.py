"""Language of whole texts, by words first and character n-grams for words not seen before.

A word that the model knows is scored by its log frequency in each language. Another
one falls back to its character n-grams (its ends marked): those of four characters,
if the model knows any of them, else of three, two or one. A text's score is the mean of
its words', and the softmax of the scores is the confidence.

The model is fitted on a bounded sample of labelled rows, SAMPLE documents in equal
parts for each language (those with the lowest hash of order and text), and holds WORDS
words and GRAMS n-grams at most. Prediction reads every text whole.

Defined results: a text that is null or has no letter is ``und`` with score 0; of equal
scores the first language by name wins; words of which no n-gram is known leave the shares
of the languages in the sample; without labelled rows everything is ``und``;
repeated rows each give a row. A column to keep that has the name
of a result gives way to it; other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskstream.llm.kept import ROW, carried, restored
from riskstream.llm.workers import held, small_batches

#: Bounds of the fit: labelled documents, words and n-grams.
SAMPLE, WORDS, GRAMS = 8_000, 60_000, 40_000
ORDERS = (4, 3, 2, 1)
#: Added to each count.
SMOOTHING = 0.1
#: Unknown words that a Python worker keeps, and words scored at a time.
REMEMBERED, AT_ONCE = 200_000, 1 << 16
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> Iterator[list[str]]:
    """Lower-case words, some at a time."""
    if len(text) < 1 << 20:
        if found := _WORD.findall(text.lower()):
            yield found
        return
    matches = _WORD.finditer(text)
    while found := [m.group().lower() for m in islice(matches, AT_ONCE)]:
        yield found


def grams(word: str, order: int) -> list[str]:
    marked = f"^{word}$" if order > 1 else word
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies: a row of ``scores`` for each item, (order, text) with order 0 for words; a column for each language."""

    languages: tuple[str, ...]
    items: tuple[tuple[int, str], ...]
    scores: np.ndarray
    prior: np.ndarray

    @classmethod
    def of_counts(cls, items: list[tuple[int, str, dict[str, int]]], totals: dict[tuple[int, str], tuple[int, int]]) -> LanguageModel:
        """From counts of items by language, and of all items of an order by language with the number of different ones."""
        languages = tuple(sorted({lang for _, lang in totals}))
        at = {lang: i for i, lang in enumerate(languages)}
        sums, kinds = np.zeros((len(ORDERS) + 1, len(at))), np.ones((len(ORDERS) + 1, 1))
        for (kind, lang), (n, different) in totals.items():
            sums[kind, at[lang]] = n
            kinds[kind] = max(kinds[kind], different)
        counts = np.zeros((len(items), len(at)))
        for row, (_, _, by_language) in enumerate(items):
            for lang, n in by_language.items():
                counts[row, at[lang]] = n
        orders = np.array([kind for kind, _, _ in items], np.int64)
        scores = np.log(counts + SMOOTHING) - np.log(sums + SMOOTHING * kinds)[orders]
        prior = np.log((sums[0] + 1) / (sums[0] + 1).sum()) if at else np.zeros(0)
        return cls(languages, tuple((kind, item) for kind, item, _ in items), scores, prior)


def fit(df: DataFrame, lang: str = "lang", text: str = "text", order: str = "doc_id", sample: int = SAMPLE) -> LanguageModel:
    """A model of the languages of the rows whose language is known."""
    small_batches(df.sparkSession)
    known = df.select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        F.xxhash64(F.col(order), F.col(text)).alias("hash"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    n = known.select("lang").distinct().count()
    if not n:
        return LanguageModel.of_counts([], {})
    lowest = Window.partitionBy("lang").orderBy("hash")
    ranked = known.select("lang", "hash").distinct().withColumn("at", F.row_number().over(lowest))
    chosen = ranked.where(F.col("at") <= max(1, sample // n)).select("lang", "hash")
    # as many rows as the sample at most; equal rows count once, so that copies can't swell it
    texts = known.join(F.broadcast(chosen), ["lang", "hash"]).dropDuplicates(["lang", "hash"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: defaultdict[str, Counter] = defaultdict(Counter)
            for language, body in zip(batch.column("lang"), batch.column("text")):
                for found in words(body.as_py()):
                    seen[language.as_py()].update(found)
            rows: Counter = Counter()
            for language, counted in seen.items():
                for word, n in counted.items():
                    rows[language, 0, word] += n
                    for k in ORDERS:
                        for gram in grams(word, k):
                            rows[language, k, gram] += n
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_pydict(
                {"lang": columns[0], "kind": columns[1], "item": columns[2], "n": list(rows.values())},
                pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("item", pa.string()), ("n", pa.int64())]),
            )

    counted = texts.select("lang", "text").mapInArrow(count, "lang string, kind int, item string, n long")
    by_language = counted.groupBy("kind", "item", "lang").agg(F.sum("n").alias("n")).cache()
    totals = {(row["kind"], row["lang"]): (row["n"], row["items"]) for row in by_language.groupBy("kind", "lang").agg(F.sum("n").alias("n"), F.count("*").alias("items")).collect()}
    each = by_language.groupBy("kind", "item").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("n"))
    items = []
    for kind, most in ((F.col("kind") == 0, WORDS), (F.col("kind") > 0, GRAMS)):
        top = each.where(kind & (F.col("total") > 1)).orderBy(F.desc("total"), "kind", "item").limit(most)
        items += [(row["kind"], row["item"], row["n"]) for row in top.collect()]
    by_language.unpersist()
    return LanguageModel.of_counts(items, totals)


class Scorer:
    """Scores texts; a word's score is kept once it has been looked up."""

    def __init__(self, model: LanguageModel):
        self.languages, self.prior = model.languages, model.prior
        self.known: dict[str, int] = {}
        self.grams: dict[tuple[int, str], np.ndarray] = {}
        rows = [np.zeros(len(self.languages))]
        for (kind, item), score in zip(model.items, model.scores):
            if kind:
                self.grams[kind, item] = score
            else:
                self.known[item] = len(rows)
                rows.append(score)
        self.fixed = len(rows)
        self.scores = np.vstack([*rows, np.zeros((REMEMBERED, len(self.languages)))])
        self.others: dict[str, int] = {}

    def back_off(self, word: str) -> np.ndarray:
        """The score of an unknown word: the mean of its longest known n-grams."""
        for k in ORDERS:
            found = [s for g in grams(word, k) if (s := self.grams.get((k, g))) is not None]
            if found:
                return np.mean(found, axis=0)
        return self.prior

    def _other(self, word: str) -> int:
        if at := self.others.get(word):
            return at
        if len(self.others) >= REMEMBERED:
            return -1
        at = self.others[word] = self.fixed + len(self.others)
        self.scores[at] = self.back_off(word)
        return at

    def score(self, text: str) -> tuple[str, float]:
        total, n, letter = np.zeros(len(self.languages)), 0, False
        known, other = self.known.get, self._other
        for found in words(text):
            letter = letter or any(any(map(str.isalpha, w)) for w in found)
            at = np.array([known(w) or other(w) for w in found])
            if at.min() < 0:  # more unknown words than are kept: forget them and score these by themselves
                self.others.clear()
                total += sum((self.scores[known(w)] if known(w) else self.back_off(w) for w in found), np.zeros(len(self.languages)))
            else:
                total += self.scores[at].sum(axis=0)
            n += len(found)
        if not letter or not self.languages:
            return UNDETERMINED, 0.0
        mean = total / n
        share = np.exp(mean - mean.max())
        best = int(mean.argmax())
        return self.languages[best], float(share[best] / share.sum())


def predict(df: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """lang_pred and score of each text next to the columns to keep."""
    sent = small_batches(df.sparkSession).sparkContext.broadcast(model)
    results = ["lang_pred", "score"]
    kept, row = carried(keep, results)
    # a text that is kept travels once
    rows = df.select(row) if text in kept else df.select(row, F.col(text).alias("text"))
    schema = StructType([rows.schema[ROW], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(sent.value, Scorer)
        for batch in batches:
            found = [scorer.score(x.as_py() or "") for x in (batch.column(ROW).field(text) if text in kept else batch.column("text"))]
            out = [pa.array([x[i] for x in found], kind) for i, kind in ((0, pa.string()), (1, pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), *out], [ROW, *results])

    return restored(rows.mapInArrow(score, schema), kept, results)
