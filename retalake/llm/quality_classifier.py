"""Graded quality by ordinal regression with cumulative links.

One weight vector over hashed words and word shapes serves all grades, and
ordered thresholds cut its scale: P(grade > k) = sigmoid(w . x - t[k]). The
expected grade and the tail probabilities select documents.

Fitting takes a sample of labelled rows of a documented size; scoring is one
pass over all texts without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import scratch, training_row
from retalake.llm.labelled import adam, labelled_sample

#: Labelled rows that are fitted; hashed weights, half of them for words and half for shapes.
SAMPLE = 12_000
WIDTH = 1 << 14
RIDGE = 1e-6
STEPS = 250
CACHE = 300_000
SHAPES = ((re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"\d+"), "9"))


def shape(token: str) -> str:
    """Runs of letters as a (A for capitals), of digits as 9, other characters as they are."""
    upper = token.isupper() and len(token) > 1
    for pattern, sign in SHAPES:
        token = pattern.sub(sign.upper() if upper else sign, token)
    return token[:8]


def places(token: str) -> tuple[int, int]:
    half = WIDTH // 2
    word = xxhash.xxh3_64_intdigest(token.lower()) % half
    return word, half + xxhash.xxh3_64_intdigest(shape(token), 1) % half


def hashed_text(text: str | None, cache: dict[str, tuple[int, int]]) -> tuple[list[int], list[float]]:
    """Indices (they may repeat) and values: damped word frequencies of length 1, and shares of word shapes."""
    counts = Counter((text or "").split())
    total = sum(counts.values())
    index, value, norm = [], [], 0.0
    shapes: Counter[int] = Counter()
    for token, n in counts.items():
        known = cache.get(token)
        if known is None:
            if len(cache) > CACHE:
                cache.clear()
            cache[token] = known = places(token)
        v = 1.0 if n == 1 else 1.0 + math.log(n)
        index.append(known[0])
        value.append(v)
        norm += v * v
        shapes[known[1]] += n
    norm = math.sqrt(norm) or 1.0
    return index + list(shapes), [v / norm for v in value] + [n / total for n in shapes.values()]


def fit(rows: np.ndarray, index: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int) -> np.ndarray:
    """Weights, then the first threshold and the logarithms of the steps to the others."""
    n = len(grade)
    upper, lower = grade < grades - 1, grade > 0

    def thresholds(x: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([[x[WIDTH]], np.exp(np.clip(x[WIDTH + 1 :], -20, 20))]))

    def gradient(x: np.ndarray) -> np.ndarray:
        z = np.bincount(rows, x[index] * value, n)
        t = thresholds(x)
        # P(grade) = s(z - t[grade - 1]) - s(z - t[grade]), with 1 and 0 beyond the ends
        a = np.where(lower, 1 / (1 + np.exp(-np.clip(z - t[np.maximum(grade - 1, 0)], -30, 30))), 1.0)
        b = np.where(upper, 1 / (1 + np.exp(-np.clip(z - t[np.minimum(grade, grades - 2)], -30, 30))), 0.0)
        p = np.maximum(a - b, 1e-9)
        d_a, d_b = -a * (1 - a) / (p * n), b * (1 - b) / (p * n)
        d_z = d_a + d_b
        d_t = np.zeros(grades - 1)
        np.add.at(d_t, np.maximum(grade - 1, 0)[lower], -d_a[lower])
        np.add.at(d_t, np.minimum(grade, grades - 2)[upper], -d_b[upper])
        above = np.cumsum(d_t[::-1])[::-1]  # a step moves all thresholds from its own on
        steps = above[1:] * np.exp(np.clip(x[WIDTH + 1 :], -20, 20))
        return np.concatenate([np.bincount(index, d_z[rows] * value, WIDTH) + RIDGE * x[:WIDTH], above[:1], steps])

    share = np.array([(grade > k).mean() for k in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
    t = np.sort(-np.log(share / (1 - share)))
    start = np.concatenate([np.zeros(WIDTH), t[:1], np.log(np.maximum(np.diff(t), 1e-3))])
    best = adam(start, gradient, STEPS, 0.2)
    return np.concatenate([best[:WIDTH], thresholds(best)])


def graded(
    spark: SparkSession, docs: DataFrame, ratings: DataFrame, grades: int, modulus: int = 5, held_out: int = 1
) -> DataFrame:
    """A row per document: doc_id, held_out, expected_grade, tails (P(grade > k) for each k, falling).

    ``ratings`` has one row per doc_id with ``grade`` from 0 to grades - 1. Ids
    whose crc32 (as text) leaves ``held_out`` modulo ``modulus`` are not learned
    from. A null or empty text has no words and gets the thresholds alone.
    Repeated rows are scored alike, and of the rows of one id one is learned
    from. Other columns of both tables are not looked at.
    Without ratings every tail is one half.
    """
    train = training_row(F.col("doc_id"), modulus, held_out)
    tables = scratch(spark)
    rated = ratings.where(train & F.col("grade").between(0, grades - 1)).select("doc_id", "grade")
    sample = labelled_sample(docs.where(train), rated, SAMPLE, tables)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, int]] = {}
        for batch in batches:
            made = [hashed_text(t.as_py(), cache) for t in batch.column(2)]
            index = [np.array(i, "<i4").tobytes() for i, _ in made]
            value = [np.array(v, "<f4").tobytes() for _, v in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(index, pa.binary()), pa.array(value, pa.binary())],
                ["doc_id", "grade", "at", "value"],
            )

    rows = sample.select(F.col("doc_id").cast("long"), F.col("grade").cast("int"), "text")
    data = rows.mapInArrow(features, "doc_id long, grade int, at binary, value binary").toPandas().sort_values("doc_id")
    if len(data):
        index = [np.frombuffer(x, "<i4") for x in data["at"]]
        value = np.concatenate([np.frombuffer(x, "<f4") for x in data["value"]])
        at = np.repeat(np.arange(len(index)), [len(x) for x in index])
        model = fit(at, np.concatenate(index), value, data["grade"].to_numpy(int), grades)
    else:
        model = np.zeros(WIDTH + grades - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, int]] = {}
        w, t = model[:WIDTH], model[WIDTH:]
        for batch in batches:
            z = np.zeros(batch.num_rows)
            for k, text in enumerate(batch.column(2)):
                index, value = hashed_text(text.as_py(), cache)
                z[k] = w[index] @ np.array(value) if index else 0.0
            tails = 1 / (1 + np.exp(-np.clip(z[:, None] - t[None, :], -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tails.sum(axis=1)), pa.array(tails.tolist(), pa.list_(pa.float64()))],
                ["doc_id", "held_out", "expected_grade", "tails"],
            )

    schema = "doc_id long, held_out boolean, expected_grade double, tails array<double>"
    return docs.select(F.col("doc_id").cast("long"), (~train).alias("held_out"), "text").mapInArrow(run, schema)


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from labels: 0 bad, 1 good but toxic, 2 good. The lowest grade of an id counts."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2)
    labels = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return labels.groupBy("doc_id").agg(F.min(grade).alias("grade"))
