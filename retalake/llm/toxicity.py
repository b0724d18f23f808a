"""Toxicity by a counterfactual-regularised classifier.

A logistic regression over the words of a text (whole, and by their first
letters, which catches inflected forms) learns from labelled rows.
Sentences that name a group of people get counterfactuals in which the name is
swapped for another group's; squared differences between a text's score and its
counterfactuals' are part of the loss, so that naming a group moves no score.

Groups are the terms given, and in corpora whose words are unknown also the
most common words that are about as frequent in toxic texts as elsewhere.

The features are chosen and the few weights fitted on a sample of labelled rows
of a documented size; scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import scratch, training_row
from retalake.llm.labelled import LETTERS, adam, labelled_sample, sparse

#: Labelled rows that are fitted, features that get a weight.
SAMPLE = 12_000
FEATURES = 2000
#: Lengths of the beginnings of words that are features.
PREFIXES = (4, 5, 7)
#: Toxic texts that a feature needs.
SUPPORT = 4
COUNTERFACTUAL = 4.0
#: Pairs of a text and a term that it names whose counterfactuals a step looks at; steps go through all of them in turn.
PAIRS = 1000
RIDGE = 1e-5
STEPS = 500
THRESHOLD = 0.7
CACHE = 300_000

#: Names of groups, in the corpus's languages.
GROUPS = (
    "women", "men", "black", "white", "asian", "gay", "lesbian", "transgender", "muslim", "jewish", "christian",
    "immigrant", "disabled", "blind", "deaf", "elderly", "frauen", "männer", "muslime", "juden", "christen",
    "ausländer", "femmes", "hommes", "musulmans", "juifs", "chrétiens", "immigrés", "mujeres", "hombres",
    "musulmanes", "judíos", "cristianos", "inmigrantes",
)
#: Common neutral words that are treated like names of groups.
NEUTRAL = 40


def word_features(token: str) -> tuple[str, ...]:
    """Features of the words in a part of a text without blanks."""
    found: list[str] = []
    for w in LETTERS.findall(token.lower()):
        found += [w, *(w[:k] + "*" for k in PREFIXES if len(w) >= k)]
    return tuple(found)


def features(text: str | None, cache: dict[str, tuple]) -> set:
    out: set = set()
    for token in set((text or "").split()):
        known = cache.get(token)
        if known is None:
            if len(cache) > CACHE:
                cache.clear()
            cache[token] = known = word_features(token)
        out.update(known)
    return out


def feature_rows(sample: DataFrame) -> DataFrame:
    """(doc_id, toxic, feature): the distinct features of each sampled text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                found = [sorted(features(t.as_py(), cache)) for t in part.column(2)]
                sizes = [len(f) for f in found]
                at = pa.array(np.repeat(np.arange(len(found)), sizes))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array([x for f in found for x in f], pa.string())],
                    ["doc_id", "toxic", "feature"],
                )

    schema = "doc_id long, toxic int, feature string"
    return sample.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"), "text").mapInArrow(run, schema)


def fit(n: int, rows: np.ndarray, columns: np.ndarray, toxic: np.ndarray, groups: list[np.ndarray], width: int) -> np.ndarray:
    """Weights and, last, the bias.

    ``rows`` and ``columns`` place the ones of the feature matrix; ``groups``
    has each group term's features. A text that names group a has for each
    other group b a counterfactual with a's features replaced by b's; the mean
    squared difference over b enters the loss.
    """
    x = np.zeros((n, width), np.float32)
    x[rows, columns] = 1
    names = np.zeros((len(groups), width), np.float32)
    for k, g in enumerate(groups):
        names[k, g] = 1
    sizes = names.sum(axis=1)
    named = (x @ names.T >= sizes) & (sizes > 0) if len(groups) else np.zeros((n, 0), bool)
    all_texts, all_terms = np.nonzero(named)
    balance = np.where(toxic == 1, 0.5 * n / max(1, toxic.sum()), 0.5 * n / max(1, n - toxic.sum()))
    weight = np.sqrt(balance)
    weight /= weight.sum()
    order, step = np.random.default_rng(1).permutation(len(all_texts)), 0

    def gradient(w: np.ndarray) -> np.ndarray:
        nonlocal step
        z = x @ w[:-1].astype(np.float32) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        d = weight * (p - toxic)
        g = np.concatenate([x.T @ d.astype(np.float32), [d.sum()]]) + RIDGE * np.concatenate([w[:-1], [0]])
        if len(all_texts):
            swap = names @ w[:-1]
            some = order[(step * PAIRS + np.arange(min(PAIRS, len(order)))) % len(order)]
            step += 1
            texts, terms = all_texts[some], all_terms[some]
            change = swap[None, :] - swap[terms][:, None]  # of the score before the sigmoid, by text that names and other term
            other = 1 / (1 + np.exp(-np.clip(z[texts][:, None] + change, -30, 30)))
            p0 = p[texts][:, None]
            gap = (other - p0) / (len(texts) * len(groups))
            up, down = 2 * gap * other * (1 - other), 2 * gap * p0 * (1 - p0)
            total = (up - down).sum(axis=1)
            moved = up.sum(axis=0) - np.bincount(terms, up.sum(axis=1), len(groups))
            d_x = np.bincount(texts, total, n)
            g += COUNTERFACTUAL * np.concatenate([x.T @ d_x.astype(np.float32) + names.T @ moved, [d_x.sum()]])
        return g

    prior = weight @ toxic
    start = np.zeros(width + 1)
    start[-1] = np.log((prior + 1e-3) / (1 - prior + 1e-3))
    return adam(start, gradient, STEPS, 0.1)


def learned_weights(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, groups: tuple[str, ...] = GROUPS
) -> tuple[dict[str, float], float]:
    """Weight of each feature, and the bias. No labelled rows: no weights, and even odds."""
    tables = scratch(spark)
    graded = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = labelled_sample(docs, graded, SAMPLE, tables)
    n, n_toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n:
        return {}, 0.0
    rows = tables.save(feature_rows(sample), "features")
    counts = rows.groupBy("feature").agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good"))
    # chi-square of the feature against the label, smoothed odds in favour of toxic
    expected = (F.col("bad") + F.col("good")) * (n_toxic / n)
    telling = counts.where((F.col("bad") >= SUPPORT) & (F.col("bad") > 2 * expected))
    telling = telling.orderBy(F.desc((F.col("bad") - expected) ** 2 / expected), "feature").limit(FEATURES).collect()
    share = F.col("bad") / (F.col("bad") + F.col("good"))
    neutral = counts.where(
        (F.col("bad") + F.col("good") >= 0.01 * n)
        & (F.col("bad") + F.col("good") <= 0.3 * n)
        & share.between(0.5 * n_toxic / n, 2 * n_toxic / n)
        & (F.length("feature") >= 5)
        & ~F.endswith("feature", F.lit("*"))
    )
    neutral = neutral.orderBy(F.desc(F.col("bad") + F.col("good")), "feature").limit(NEUTRAL).collect()
    terms = [*groups, *(r["feature"] for r in neutral)]
    index: dict[str, int] = {}
    for f in [*(r["feature"] for r in telling), *(f for t in terms for f in word_features(t))]:
        index.setdefault(f, len(index))
    names = spark.createDataFrame(list(index.items()), "feature string, at int") if index else None
    if names is None:
        return {}, float(np.log((n_toxic + 0.5) / (n - n_toxic + 0.5)))
    kept = rows.join(F.broadcast(names), "feature").groupBy("doc_id").agg(F.collect_list("at").alias("at"))
    data = sample.select("doc_id", "toxic").join(kept, "doc_id", "left").toPandas().sort_values("doc_id")
    at, columns = sparse(data["at"].map(lambda v: v if v is not None else []))
    group_columns = [np.array([index[f] for f in word_features(t)]) for t in terms]
    w = fit(len(data), at, columns, data["toxic"].to_numpy(float), group_columns, len(index))
    return {f: float(w[i]) for f, i in index.items()}, float(w[-1])


def scores(docs: DataFrame, weights: dict[str, float], bias: float) -> DataFrame:
    """All columns of ``docs`` but the text, and score. Null and empty texts get the bias's score."""
    names = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple] = {}
        for batch in batches:
            z = []
            for text in batch.column("text"):
                found: set[str] = set()
                for token in set((text.as_py() or "").split()):
                    known = cache.get(token)
                    if known is None:
                        if len(cache) > CACHE:
                            cache.clear()
                        cache[token] = known = tuple(f for f in word_features(token) if f in weights)
                    if known:
                        found.update(known)
                z.append(bias + sum(sorted(weights[f] for f in found)))
            score = 1 / (1 + np.exp(-np.clip(np.array(z, float), -500, 500)))
            kept = batch.select(names)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(score)], [*names, "score"])

    kinds = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", score double")


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted (1 where score >= 0.7).

    Labels of ids whose crc32(id as text) leaves ``held_out`` modulo ``modulus``
    are not used. An id that is labelled twice counts as toxic if one label is 1.
    """
    train = training_row(F.col("doc_id"), modulus, held_out)
    weights, bias = learned_weights(spark, docs.where(train), labels.where(train))
    held = (~train).alias("held_out")
    scored = scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text"), weights, bias)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
