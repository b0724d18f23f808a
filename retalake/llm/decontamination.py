"""Documents that contain passages of a benchmark.

The benchmark's items are cut into windows of 13 consecutive normalised words
(a shorter item is one window). The hashes of the windows' first three words
form the set that travels to every task, while it is proven small by count;
a larger set is joined by shuffling. A document is scanned once, and positions
whose words are in the set keep their whole window. Joining these with the
windows, word by word, verifies them. Only the kept positions leave the task
that scans a document; all work is in DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import ascii_lower, counted_broadcast, fresh, join_rows, scratch, split_words

WINDOW = 13
LEAD = 3
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]"
#: So many leads go into the tasks' code as a set, and so many windows may be broadcast; more are joined by shuffling.
SET_LEADS = 50_000
BROADCAST_WINDOWS = 500_000


def normalised_words(text: Column) -> Column:
    return split_words(ascii_lower(text), GAP)


def lead_hash(words: Column, start: Column, length: int) -> Column:
    """Hash of the first words of the window of ``length`` words at ``start``."""
    return F.xxhash64(F.lit(length), *[F.get(words, start + k) for k in range(min(LEAD, length))])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(hash, length, words, items): the distinct windows and the ids of the items that hold them.

    Items without words have none; an item without an id has windows that name nobody.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), normalised_words(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("length", F.least(F.lit(window), F.size("w")))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("length") + 1)
    windows = items.select("item", "length", F.explode(F.transform(starts, lambda i: F.slice("w", i, F.col("length")))).alias("w"))
    return windows.groupBy("length", F.col("w").alias("words")).agg(F.collect_set("item").alias("items"))


def leads(windows: DataFrame, lengths: list[int]) -> DataFrame:
    value = F.lit(None).cast("long")
    for n in lengths:
        value = F.when(F.col("length") == n, lead_hash(F.col("words"), F.lit(0), n)).otherwise(value)
    return windows.select(value.alias("lead")).distinct()


def proposed(docs: DataFrame, leads: DataFrame, lengths: list[int]) -> DataFrame:
    """``docs`` (doc_id, text_key, w) with ``places``: the windows (start, length, words) whose lead is in the set."""
    w = F.col("w")
    some = leads.limit(SET_LEADS + 1).collect()

    def starts(n: int) -> Column:
        last = F.size(w) - n
        return F.when(last < 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(last, F.lit(0))))

    def is_known(n: int, known: list[int]) -> Callable[[Column], Column]:
        return lambda i: lead_hash(w, i, n).isin(known)

    def with_lead(n: int) -> Callable[[Column], Column]:
        return lambda i: F.struct(F.lit(n).alias("n"), i.alias("i"), lead_hash(w, i, n).alias("lead"))

    def of_length(n: int) -> Callable[[Column], Column]:
        return lambda x: x["n"] == n

    def place(n: int) -> Callable[[Column], Column]:
        return lambda i: F.struct(
            i.alias("start"), F.lit(n).alias("length"), F.array(*[F.get(w, i + k) for k in range(n)]).alias("words")
        )

    if len(some) <= SET_LEADS:
        known = [r["lead"] for r in some]
        kept = {n: F.filter(starts(n), is_known(n, known)) for n in lengths}
    else:
        one = F.array(*[F.transform(starts(n), with_lead(n)) for n in lengths])
        hits = docs.select("doc_id", "text_key", F.inline(F.flatten(one))).join(leads, "lead")
        hits = hits.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("n", "i")).alias("at"))
        docs = join_rows(docs, hits, ["doc_id", "text_key"])
        at = F.coalesce("at", F.array().cast("array<struct<n:int,i:int>>"))
        kept = {n: F.transform(F.filter(at, of_length(n)), lambda x: x["i"]) for n in lengths}

    none = F.array().cast("array<struct<start:int,length:int,words:array<string>>>")
    places = [F.transform(x, place(n)) for n, x in kept.items()]
    return docs.withColumn("places", F.concat(none, *places))


def contamination(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20
) -> DataFrame:
    """A row per document: doc_id, text_key, n_words, n_hit, items (sorted), windows, contaminated.

    ``windows`` holds the verified windows as word positions (start, length).
    Contaminated: some word is hit and share * n_hit >= n_words. Null and
    empty texts have no words. Rows are told apart by doc_id (null is a value
    like others) and ``text_key``, the text's hash, so repeated rows get the
    same answer. An empty benchmark hits nothing.
    """
    tables = scratch(spark)
    windows = tables.save(benchmark_windows(benchmark, window), "windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most ``window`` numbers
    first = tables.save(leads(windows, lengths), "leads")

    scanned = docs.select("doc_id", text_key().alias("text_key"), normalised_words(F.col("text")).alias("w"))
    scanned = proposed(scanned, first, lengths).select(
        "doc_id", "text_key", F.size("w").cast("long").alias("n_words"), "places"
    )
    scanned = tables.save(scanned, "scanned")
    found = scanned.select("doc_id", "text_key", F.inline("places")).distinct()
    found = found.join(counted_broadcast(windows, BROADCAST_WINDOWS), ["length", "words"])

    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    placed = F.sort_array(F.collect_list(F.struct("start", "length")))
    per_doc = found.groupBy("doc_id", "text_key").agg(placed.alias("windows"), items.alias("items"))
    covered = F.aggregate(
        "windows",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["start"] + x["length"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(a["end"], x["start"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    per_doc = per_doc.withColumn("n_hit", covered)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return join_rows(scanned, per_doc, ["doc_id", "text_key"]).select(
        "doc_id",
        "text_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("windows", F.array().cast("array<struct<start:int,length:int>>")).alias("windows"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def text_key() -> Column:
    return F.xxhash64("text", F.octet_length("text"))


def without_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    key = fresh("text_key")
    bad = contamination(spark, docs, benchmark).where("contaminated").select("doc_id", F.col("text_key").alias(key))
    bad = counted_broadcast(scratch(spark).save(bad.distinct(), "contaminated"))
    return join_rows(docs.withColumn(key, text_key()), bad, ["doc_id", key], "left_anti").select(*docs.columns)
