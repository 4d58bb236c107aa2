"""Severity of toxic language by cumulative-link ordinal regression.

Grades 0 to 3 are ordered; one weight vector w is shared by all thresholds c:

    P(grade > k) = 1 / (1 + exp(c[k] - w.x))

x holds log(1 + count) of sparse text features: words and word beginnings. The features are
the FEATURES that speak most clearly for toxic documents in the labelled sample (G statistic of
their document counts). The output is the expected grade.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.scratch import Scratch

#: Labelled documents per class the model is fitted on, those of lowest hash.
SAMPLE_DOCS = 2000
FEATURES = 1000
#: A feature must be in so many toxic documents of the sample.
LEAST_DOCS = 3
BEGINNINGS = (3, 4, 5, 6)
#: and so many times as frequent in toxic documents as in clean ones.
LEAST_LIFT = 5.0
#: Lift of the features that count for the training grade.
STRONG_LIFT = 20.0
#: Telling words in a toxic document from which its training grade is 2 and 3.
GRADE_WORDS = (3, 5)
#: Expected grade from which a document is rejected.
REJECT_AT = 0.5
STEPS = 400
RIDGE = 1e-4
WORD = re.compile(r"\w+")
CACHED_WORDS = 200_000


def word_features(word: str) -> list[str]:
    return ["=" + word] + [word[:n] for n in BEGINNINGS if len(word) >= n]


def words_of(text: str | None) -> Counter:
    """Counts of the words of the whole text in lower case; none for null."""
    return Counter(WORD.findall(text.lower())) if text else Counter()


class Vocabulary:
    """Feature numbers of words, with a cache of bounded size."""

    def __init__(self, features: list[str]) -> None:
        self.number = {feature: at for at, feature in enumerate(features)}
        self.cache: dict[str, list[int]] = {}

    def of(self, word: str) -> list[int]:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            number = self.number
            found = [number[f] for f in word_features(word) if f in number]
            self.cache[word] = found
        return found

    def counts(self, text: str | None) -> Counter:
        result: Counter = Counter()
        for word, count in words_of(text).items():
            for feature in self.of(word):
                result[feature] += count
        return result


@dataclass(frozen=True)
class SeverityModel:
    features: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def expected(self, evidence: np.ndarray) -> np.ndarray:
        """Expected grade: the sum over k of P(grade > k)."""
        with np.errstate(over="ignore"):
            above = 1.0 / (1.0 + np.exp(self.thresholds[None, :] - evidence[:, None]))
        return above.sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of a cumulative-link model, by gradient steps.

    grade holds 0..K-1, each at least once.
    """
    grades = int(grade.max()) + 1
    share = 1.0 / len(grade)
    weights = np.zeros(x.shape[1])
    free = np.zeros(grades - 1)  # first threshold, then logarithms of the gaps
    values = np.concatenate([weights, free])
    first, second = np.zeros_like(values), np.zeros_like(values)
    top, bottom = grade == grades - 1, grade == 0

    def thresholds(free: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))

    for step in range(1, STEPS + 1):
        weights, free = values[: x.shape[1]], values[x.shape[1] :]
        cuts = thresholds(free)
        s = x @ weights
        a = np.where(top, np.inf, cuts[np.minimum(grade, grades - 2)] - s)
        b = np.where(bottom, -np.inf, cuts[np.maximum(grade - 1, 0)] - s)
        fa, fb = np.where(top, 1.0, _sigmoid(a)), np.where(bottom, 0.0, _sigmoid(b))
        p = np.maximum(fa - fb, 1e-12)
        by_score = share * (fa + fb - 1.0)
        by_cut = np.zeros(grades - 1)
        np.add.at(by_cut, np.minimum(grade, grades - 2), share * np.where(top, 0.0, fa * (1 - fa) / p))
        np.add.at(by_cut, np.maximum(grade - 1, 0), -share * np.where(bottom, 0.0, fb * (1 - fb) / p))
        by_free = np.cumsum(by_cut[::-1])[::-1]
        by_free[1:] *= np.exp(free[1:])
        gradient = np.concatenate([-(x.T @ by_score) + ridge * weights, -by_free])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        values = values - 0.05 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-10
        )
    return values[: x.shape[1]], thresholds(values[x.shape[1] :])


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most SAMPLE_DOCS labelled documents of each class."""
    known = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    parts = [
        known.filter(F.col("toxic") == toxic)
        .orderBy(F.xxhash64("_doc"), "_doc")
        .limit(SAMPLE_DOCS)
        for toxic in (False, True)
    ]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # 2 * SAMPLE_DOCS rows at most
    return docs.select(F.col("doc_id").alias("_id"), "text").join(
        chosen, F.col("_id") == F.col("_doc")
    ).select("_id", "toxic", "text")


def _telling(sample: DataFrame) -> list[tuple[str, bool]]:
    """The FEATURES of highest G that speak for toxic, with whether they do so strongly."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = {False: Counter(), True: Counter()}
            for toxic, text in zip(batch["toxic"], batch["text"], strict=True):
                seen[bool(toxic)].update(
                    {f for word in words_of(text) for f in word_features(word)}
                )
            names = list(seen[False] | seen[True])
            yield pd.DataFrame(
                {
                    "feature": names,
                    "clean_docs": [seen[False][n] for n in names],
                    "toxic_docs": [seen[True][n] for n in names],
                }
            )

    totals = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return []
    counts = (
        sample.select("toxic", "text")
        .mapInPandas(count, "feature string, clean_docs long, toxic_docs long")
        .groupBy("feature")
        .agg(F.sum("clean_docs").alias("clean"), F.sum("toxic_docs").alias("toxic"))
    )
    clean_rate = (F.col("clean") + 0.5) / (totals[False] + 1.0)
    toxic_rate = (F.col("toxic") + 0.5) / (totals[True] + 1.0)
    both = (F.col("clean") + F.col("toxic") + 1.0) / (totals[False] + totals[True] + 2.0)
    g = F.col("clean") * F.log(clean_rate / both) + F.col("toxic") * F.log(toxic_rate / both)
    rows = (
        counts.filter((F.col("toxic") >= LEAST_DOCS) & (toxic_rate > LEAST_LIFT * clean_rate))
        .select(
            "feature", g.alias("g"), (toxic_rate > STRONG_LIFT * clean_rate).alias("strong")
        )
        .orderBy(F.col("g").desc(), "feature")
        .limit(FEATURES)
        .collect()
    )
    return [(row["feature"], row["strong"]) for row in rows]


def fit(docs: DataFrame, labels: DataFrame) -> SeverityModel | None:
    """Model from the documents that labels (doc_id, toxic) cover; None if a class is empty.

    The labels only tell toxic from clean. The grade of a toxic training document is 1, 2 or 3
    by how many of its words have a feature of STRONG_LIFT.
    Starts jobs when called.
    """
    sample = Scratch(docs.sparkSession, "toxicity").table(_sample(docs, labels), "sample")
    telling = _telling(sample)
    if not telling:
        return None
    features = [feature for feature, _ in telling]
    strong = frozenset(at for at, (_, speaks) in enumerate(telling) if speaks)

    def represent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(features)
        for batch in batches:
            rows = []
            for toxic, text in zip(batch["toxic"], batch["text"], strict=True):
                counts: Counter = Counter()
                told = 0
                for word, count in words_of(text).items():
                    numbers = vocabulary.of(word)
                    for number in numbers:
                        counts[number] += count
                    told += count * any(number in strong for number in numbers)
                rows.append((bool(toxic), told, list(counts), list(counts.values())))
            yield pd.DataFrame(rows, columns=["toxic", "told", "number", "count"])

    rows = (
        sample.select("toxic", "text")
        .mapInPandas(represent, "toxic boolean, told long, number array<int>, count array<long>")
        .collect()
    )
    x = np.zeros((len(rows), len(features)))
    grade = np.zeros(len(rows), dtype=np.int64)
    for at, row in enumerate(rows):
        x[at, row["number"]] = np.log1p(row["count"])
        if row["toxic"]:
            grade[at] = 1 + sum(row["told"] >= least for least in GRADE_WORDS)
    _, dense = np.unique(grade, return_inverse=True)  # a small sample may lack a grade
    weights, thresholds = fit_ordinal(x, dense)
    return SeverityModel(features, weights, thresholds)


def with_severity(docs: DataFrame, model: SeverityModel | None, column: str = "severity") -> DataFrame:
    """docs with the expected grade of each whole text; 0 for all without a model."""
    if model is None:
        return docs.withColumn(column, F.lit(0.0))

    @F.pandas_udf("double")
    def severity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary(model.features)
        weights = model.weights
        for batch in batches:
            evidence = [
                sum(weights[f] * np.log1p(n) for f, n in vocabulary.counts(text).items())
                for text in batch
            ]
            yield pd.Series(model.expected(np.array(evidence, dtype=np.float64)))

    return docs.withColumn(column, severity(F.col("text")))


def grade_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, severity (expected grade, 0 to 3) and toxic (severity >= REJECT_AT) of every row.

    The labels tell toxic or not; grades 1 to 3 of training are the text's number of telling words,
    so only the step from 0 is verified by labels.
    Null and empty texts have no feature and get the severity of a text without any, which is
    near 0; repeated rows are graded each; ids in labels that docs lack, and null labels, are
    not used; an id with several labels is toxic if one says so. Without labelled documents of
    both classes every severity is 0. Other columns are not looked at.
    """
    base = docs.select("doc_id", "text")
    return with_severity(base, fit(base, labels)).select(
        "doc_id", "severity", (F.col("severity") >= REJECT_AT).alias("toxic")
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not rejected, with all their columns, whatever their names.

    A null or empty text has no feature and stays; rows that repeat stay or go together; an empty
    table stays empty. Without labelled documents of both classes nothing is rejected.
    """
    column = "severity"
    while column in docs.columns:
        column += "_"
    kept = with_severity(docs, fit(docs, labels), column).filter(F.col(column) < REJECT_AT)
    return kept.select(*[F.col(f"`{name}`") for name in docs.columns])
