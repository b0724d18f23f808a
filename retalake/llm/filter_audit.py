"""How filters in a row interact: what each removes in every order, and its Shapley share.

A document's failures are a bit mask over the filters, so a part of the corpus is a histogram of masks: at most 2^n
rows per part leave the shuffle, however many documents there are. From it

1. every coalition S of filters gets the documents that it removes, v(S): those whose mask meets S;
2. a step of an order removes v(S and f) - v(S), where S are the filters before it; all step counts are such
   differences;
3. the Shapley values solve the least-squares problem that they are known to solve: weights
   (n-1) / (C(n,|S|) |S| (n-|S|)) on all coalitions but the empty and the full one, under the constraint that the
   shares sum to v(all). The normal equations with the multiplier of the constraint are solved in rationals, so the
   shares are exact; n! of them is a whole number.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import counted_broadcast, grouped_rows, scratch, split_words, BLANK_CLASS

#: Most filters: 2^n coalitions and n! orders per part are written out.
MOST_FILTERS = 7

STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Solution of a regular system by Gauss-Jordan elimination."""
    rows = [[*line, value] for line, value in zip(matrix, right, strict=True)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(len(rows)):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k], strict=True)]
    return [line[-1] for line in rows]


def shapley(values: list[int], n: int) -> list[Fraction]:
    """Shapley values of the game ``values``, indexed by coalition mask; the empty coalition's value is 0."""
    full = (1 << n) - 1
    if n == 1:
        return [Fraction(values[full])]
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [Fraction(0)] * n + [Fraction(values[full])]
    for s in range(1, full):
        size = s.bit_count()
        weight = Fraction(n - 1, comb(n, size) * size * (n - size))
        inside = [i for i in range(n) if s >> i & 1]
        for i in inside:
            right[i] += weight * values[s]
            for j in inside:
                matrix[i][j] += weight
    for i in range(n):  # the multiplier of the constraint, and the constraint
        matrix[i][n] = matrix[n][i] = Fraction(1)
    return solved(matrix, right)[:n]


def coalitions(counted: DataFrame, n: int) -> DataFrame:
    """part, and per mask 0..2^n-1 in arrays: documents of exactly that mask, and documents, good and toxic ones met by it.

    ``counted`` holds part, mask, docs, good, toxic with one row per part and mask.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1)))
    met = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    tabulated = counted.withColumn("coalition", every).groupBy("part", "coalition").agg(
        F.sum(F.when(F.col("mask") == F.col("coalition"), F.col("docs")).otherwise(0)).alias("exact"),
        *[F.sum(F.when(met, F.col(c)).otherwise(0)).alias(c) for c in ("docs", "good", "toxic")],
    )
    row = F.array_sort(F.collect_list(F.struct("coalition", "exact", "docs", "good", "toxic")))  # 2^n entries
    return tabulated.groupBy("part").agg(row.alias("games"))


def audited(games: DataFrame, letters: str) -> DataFrame:
    """The rows of :func:`audit` from :func:`coalitions`."""
    n = len(letters)

    def steps(part: str, rows: list[dict[str, int]]) -> Iterator[tuple]:
        exact, docs, good, toxic = ([r[c] for r in rows] for c in ("exact", "docs", "good", "toxic"))
        total = sum(exact)
        shares = [int(x * factorial(n)) for x in shapley(docs, n)]
        for order in permutations(range(n)):
            before = 0
            for step, f in enumerate(order, 1):
                after = before | 1 << f
                removed = docs[after] - docs[before]
                lost = good[after] - good[before], toxic[after] - toxic[before]
                name = "".join(letters[i] for i in order)
                yield part, name, step, total - docs[after], removed, docs[1 << f] - removed, exact[1 << f], *lost, shares[f]
                before = after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
        names = [f.split()[0] for f in STEPS.split(", ")]
        for batch in batches:
            for part, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                columns = zip(*steps(part, rows), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return games.mapInArrow(run, STEPS)


def audit(docs: DataFrame, failures: dict[str, Column], part: Column, good: Column, toxic: Column) -> DataFrame:
    """A row per part, order of the filters and step.

    ``failures`` maps a letter per filter to its failure condition; ``part``, ``good`` and ``toxic`` are a string and
    two conditions. Conditions that are null count as false, a null part as the empty one. Counts of documents within
    the part: kept after the step, removed in it, redundant (failing its filter, removed earlier), unique_fails
    (failing that filter only), good_lost and toxic_lost (removed here), and shapley (removed by its filter, summed
    over all orders). Every row of ``docs`` counts, repeated ones too; no rows, no parts.
    """
    letters = "".join(failures)
    if not 1 <= len(failures) <= MOST_FILTERS or len(letters) != len(failures):
        raise ValueError(f"1 to {MOST_FILTERS} filters, a letter each")
    bits = [F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(failures.values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    flat = docs.select(F.coalesce(part, F.lit("")).alias("part"), mask.alias("mask"), good.alias("good"), toxic.alias("toxic"))
    counts = [F.count("*").alias("docs"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")]
    return audited(coalitions(flat.groupBy("part", "mask").agg(*counts), len(failures)), letters)


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions that look at one text. A: under 200 words; B: under half of them distinct; C: over 3 % capitals;
    D: symbols."""
    words = split_words(text, BLANK_CLASS)
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def document_audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`audit` of four text filters and E, a text that is identical to that of a smaller doc_id; parts are languages.

    Null texts count as empty ones, a null language as ''. A document is good or toxic if any row of ``labels`` with
    its doc_id says so. A null doc_id has no label, and is neither smaller nor larger than another; of rows that
    share a doc_id none is smaller.
    """
    tables = scratch(spark)
    text = F.coalesce("text", F.lit(""))
    judged = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        *[c.alias(name) for name, c in text_failures(text).items()],
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = tables.save(judged, "judged")
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("size"))
    groups = tables.save(groups.where("first < last").select("digest", "first", "size"), "groups")
    rows = grouped_rows(rows, groups, "digest", "size", rows.count(), "left").withColumn("E", F.col("doc_id") > F.col("first"))

    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marks = counted_broadcast(tables.save(marks.where("good OR toxic"), "marks"))
    rows = rows.join(marks, "doc_id", "left")
    return audit(rows, {c: F.col(c) for c in "ABCDE"}, F.col("part"), F.col("good"), F.col("toxic"))
