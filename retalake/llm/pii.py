"""Personal data: fixed patterns as seeds, and contexts that they teach.

E-mail addresses, IP addresses, card and phone numbers are found by pattern.
These seeds induce lexical patterns: the two words before an entity. A graph
links the patterns with the instances that follow them, that is seeds and
other identifier-like tokens. In each round a pattern's confidence is the share
of its occurrences in the whole corpus that an accepted instance follows;
patterns of high confidence and enough different accepted instances are
accepted, and so are the identifiers that follow them, which support further
patterns in the next round. What follows an accepted pattern is reported as
``learned``.

Texts are scanned twice: for entities and identifiers, then to count how often
the contexts of these occur at all. The rounds work on the small tables of
occurrences and contexts, summed per key before each shuffle. All of it is in
DataFrame expressions. Positions are code points; spans end exclusively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import BLANK_CLASS, counted_broadcast, fresh, join_rows, scratch, split_words

KINDS = ("email", "ip", "card", "phone")
LEARNED = "learned"
LOCAL = "A-Za-z0-9._%+-"
#: Leftmost matches begin where their first run of characters begins, or right after another match; saying so, and
#: giving nothing back from runs that need not, keeps long runs linear.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Identifier-like tokens: six or more such characters with a digit among them.
IDENTIFIER = r"(?<![A-Za-z0-9._@/+-])(?=[A-Za-z._@/+-]*+[0-9])[A-Za-z0-9][A-Za-z0-9._@/+-]{4,}[A-Za-z0-9]"
#: Characters before an entity that are searched for its two words.
REACH = 64
#: Matches whose positions are summed up in one go.
CHUNK = 256
SUPPORT = 3
CONFIDENCE = 0.8
ROUNDS = 3
#: One in so many texts is counted for the lower bound.
BOUND = 16

FOUND = "array<struct<start:int,end:int,value:string,before:string>>"


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: start, end, value, and the text between the match and the one before."""
    gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    pairs = F.transform(values, lambda v, i: F.struct(v.alias("value"), F.get(gaps, i).alias("before")))
    none = F.array().cast(FOUND)

    def chunk(begin: Column, part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(begin.alias("at"), none.alias("found")),
            lambda a, x: F.struct(
                (a["at"] + F.char_length(x["before"]) + F.char_length(x["value"])).alias("at"),
                F.concat(
                    a["found"],
                    F.array(
                        F.struct(
                            (a["at"] + F.char_length(x["before"])).alias("start"),
                            (a["at"] + F.char_length(x["before"]) + F.char_length(x["value"])).alias("end"),
                            x["value"].alias("value"),
                            F.right(x["before"], F.lit(REACH)).alias("before"),
                        )
                    ),
                ).alias("found"),
            ),
        )

    def in_chunks(pairs: Column) -> Column:  # an array that grows is copied, so it grows within a chunk only
        return F.aggregate(
            F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int")),
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{FOUND}>").alias("parts")),
            lambda a, c: F.aggregate(
                F.array(chunk(a["at"], F.slice(pairs, c * CHUNK + 1, CHUNK))),
                F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{FOUND}>").alias("parts")),
                lambda _, r: F.struct(r["at"].alias("at"), F.concat(a["parts"], F.array(r["found"])).alias("parts")),
            ),
            lambda a: F.flatten(a["parts"]),
        )

    return F.when(~text.rlike(pattern), none).otherwise(
        F.aggregate(F.array(pairs), none, lambda _, p: F.when(F.size(p) == 0, none).otherwise(in_chunks(p)))
    )


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) > 3, F.lit(False)).otherwise(
                F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255
            ),
        )
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Sorted array of start, rank (of the kind), end, kind, value, before."""
    arrays = []
    for rank, kind in enumerate(KINDS):
        matches = F.filter(located(text, PATTERNS[kind]), valid_as(kind))
        arrays.append(F.transform(matches, as_span(rank, kind)))
    return F.sort_array(F.concat(*arrays))


def valid_as(kind: str):
    return lambda x: valid(kind, x["value"])


def as_span(rank: int, kind: str):
    return lambda x: F.struct(
        x["start"].alias("start"),
        F.lit(rank).alias("rank"),
        x["end"].alias("end"),
        F.lit(kind).alias("kind"),
        x["value"].alias("value"),
        x["before"].alias("before"),
    )


def plain_words(text: Column) -> Column:
    """Words for contexts: lower-cased, quotes and brackets as blanks, = and : as words."""
    flat = F.regexp_replace(F.lower(text), "[\"'(<>\\[\\]]+", " ")
    return split_words(F.regexp_replace(flat, "[=:]+", " = "), BLANK_CLASS)


def context(before: Column) -> Column:
    """The two words before an entity; null if they do not lie whole within REACH."""

    def last_two(w: Column) -> Column:
        whole = (F.size(w) > 2) | ((F.size(w) == 2) & (F.char_length(before) < REACH))
        return F.when(whole, F.concat_ws(" ", F.element_at(w, -2), F.element_at(w, -1)))

    return F.aggregate(F.array(plain_words(before)), F.lit(None).cast("string"), lambda _, w: last_two(w))


def accepted_contexts(
    occurrences: DataFrame, totals: DataFrame, tables, support: int, confidence: float, rounds: int
) -> DataFrame:
    """(context): patterns accepted after ``rounds`` rounds over the graph of contexts and values."""
    graph = occurrences.groupBy("context", "value").agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
    graph = tables.save(graph.join(totals, "context"), "graph")
    seeds = occurrences.where("seed").select("value").distinct()
    accepted = tables.save(seeds, "accepted-0")
    for k in range(1, rounds + 1):
        known = graph.join(accepted, "value", "left_semi")
        scored = known.groupBy("context").agg(
            F.count("*").alias("values"), F.sum("n").alias("hits"), F.first("total").alias("total")
        )
        patterns = scored.where((F.col("values") >= support) & (F.col("hits") >= confidence * F.col("total")))
        patterns = tables.save(patterns.select("context"), f"patterns-{k}")
        found = graph.join(patterns, "context", "left_semi").select("value")
        accepted = tables.save(accepted.union(found).distinct(), f"accepted-{k}")
    return patterns


def personal_data(
    spark: SparkSession,
    docs: DataFrame,
    support: int = SUPPORT,
    confidence: float = CONFIDENCE,
    rounds: int = ROUNDS,
) -> DataFrame:
    """A row per document: doc_id, text_key, base, spans.

    ``base`` has the spans of the fixed patterns, ``spans`` these and the
    learned ones, both sorted by start, kind and end. Null and empty texts have
    none. Rows are told apart by doc_id (null is a value like others) and the
    text's hash, so repeated rows get the same spans; they count as often as
    they occur.
    """
    tables = scratch(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    scanned = docs.select("doc_id", text_key().alias("text_key"), base_spans(text).alias("base"), located(text, IDENTIFIER).alias("ids"))
    scanned = tables.save(scanned, "scanned")

    def free(x: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))

    seeds = scanned.select("doc_id", "text_key", F.inline("base")).withColumn("seed", F.lit(True))
    others = scanned.select("doc_id", "text_key", F.inline(F.filter("ids", free))).withColumn("seed", F.lit(False))
    shared = ["doc_id", "text_key", "start", "end", "seed"]
    occurrences = seeds.unionByName(others, allowMissingColumns=True).select(
        *shared, F.lower("value").alias("value"), context(F.col("before")).alias("context")
    )
    occurrences = tables.save(occurrences.where("context IS NOT NULL"), "occurrences")

    # Contexts that can ever be accepted: enough different values follow them, and often enough. A count over part of
    # the texts is a lower bound of the whole count, so the everyday contexts it rules out need no whole count.
    able = occurrences.groupBy("context", "value").agg(F.count("*").alias("n"))
    able = able.groupBy("context").agg(F.count("*").alias("values"), F.sum("n").alias("most"))
    able = tables.save(able.where(F.col("values") >= support).select("context", "most"), "able")
    words = docs.select(plain_words(F.col("text")).alias("w"), F.pmod(text_key(), F.lit(BOUND)).alias("part"))

    def counted(words: DataFrame, contexts: DataFrame) -> DataFrame:
        pairs = F.transform(
            F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", F.get("w", i), x)
        )
        found = words.select(F.explode(pairs).alias("context")).join(counted_broadcast(contexts), "context", "left_semi")
        return found.groupBy("context").agg(F.count("*").alias("total"))

    bound = counted(words.where("part = 0"), able.select("context"))
    able = able.join(bound, "context", "left").where(F.col("most") >= confidence * F.coalesce("total", F.lit(0)))
    able = tables.save(able.select("context"), "able-bound")
    totals = tables.save(counted(words, able), "totals")

    patterns = accepted_contexts(occurrences, totals, tables, support, confidence, rounds)
    learned = occurrences.where("NOT seed").join(counted_broadcast(patterns), "context", "left_semi")
    learned = learned.select("doc_id", "text_key", "start", "end").distinct().groupBy("doc_id", "text_key").agg(
        F.collect_list(
            F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.lit(LEARNED).alias("kind"))
        ).alias("learned")
    )
    learned = tables.save(learned, "learned")
    base = F.transform("base", lambda x: F.struct(x["start"], x["rank"], x["end"], x["kind"]))
    spans = F.sort_array(F.concat(base, F.coalesce("learned", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))))
    joined = join_rows(scanned, learned, ["doc_id", "text_key"])
    return joined.select("doc_id", "text_key", base.alias("base"), spans.alias("spans"))


def text_key() -> Column:
    return F.xxhash64("text", F.octet_length("text"))


def redacted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, and ``[KIND]`` in ``text`` for every span; overlapping spans are one."""
    key, spans = fresh("text_key"), fresh("spans")
    found = personal_data(spark, docs).where(F.size("spans") > 0)
    found = found.dropDuplicates(["doc_id", "text_key"]).select(
        "doc_id", F.col("text_key").alias(key), F.col("spans").alias(spans)
    )
    found = counted_broadcast(scratch(spark).save(found, "found"))
    joined = join_rows(docs.withColumn(key, text_key()), found, ["doc_id", key])
    span = "struct<start:int,end:int,kind:string>"
    blocks = F.aggregate(
        spans,
        F.array().cast(f"array<{span}>"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (s["start"] < F.element_at(a, -1)["end"]),
            F.concat(
                F.slice(a, 1, F.size(a) - 1),
                F.array(
                    F.struct(
                        F.element_at(a, -1)["start"].alias("start"),
                        F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"),
                        F.element_at(a, -1)["kind"].alias("kind"),
                    )
                ),
            ),
        ).otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))),
    )
    joined = joined.withColumn(spans, blocks)

    def before(b: Column, i: Column) -> Column:
        end = F.when(i == 0, F.lit(0)).otherwise(F.get(spans, F.greatest(i - 1, F.lit(0)))["end"])
        return F.concat(F.substring("text", end + 1, b["start"] - end), F.lit("["), F.upper(b["kind"]), F.lit("]"))

    rest = F.substring("text", F.element_at(spans, -1)["end"] + 1, F.lit(2147483647))
    clean = F.concat(F.array_join(F.transform(spans, before), ""), rest)
    return joined.withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(F.col("text"))).select(*docs.columns)
