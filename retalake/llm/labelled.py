"""Bounded samples of labelled documents, and words as features."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retalake.llm.common import counted_broadcast
from retalake.session import Scratch

LETTERS = re.compile(r"[^\W\d_]+")


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, tables: Scratch) -> DataFrame:
    """Written (doc_id, text, columns of labels) of at most ``most`` labelled ids, those of the least hashes.

    ``labels`` has one row per doc_id. Ids without a document yield nothing; a
    document that repeats counts once.
    """
    chosen = labels.where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = counted_broadcast(tables.save(chosen, "labels"), most)
    return tables.save(docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"]), "sample")


def sparse(rows: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(row of each entry, entry) of a column of integer arrays."""
    lengths = rows.map(len).to_numpy()
    flat = np.concatenate([np.asarray(x, np.int64) for x in rows]) if len(rows) and lengths.sum() else np.empty(0, np.int64)
    return np.repeat(np.arange(len(rows)), lengths), flat


def adam(value: np.ndarray, gradient: Callable[[np.ndarray], np.ndarray], steps: int, rate: float) -> np.ndarray:
    """Minimum of a smooth function by Adam with a falling rate."""
    m, s, x = np.zeros_like(value), np.zeros_like(value), value.copy()
    for k in range(1, steps + 1):
        g = gradient(x)
        m += 0.1 * (g - m)
        s += 0.01 * (g * g - s)
        x -= rate * (1 - k / (steps + 1)) * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-9)
    return x
