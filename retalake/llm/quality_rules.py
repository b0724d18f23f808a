"""Quality rules whose cutoffs carry a guarantee on how many good documents they reject.

Each rule compares one statistic of a text with a cutoff. A labelled holdout
tells, per stratum (language), how many good documents a cutoff would reject.
A cutoff is certified when the exact binomial test rejects "its false rejection
rate is above the limit" at a level that is divided by the number of tests made
(Bonferroni over strata, rules and cutoffs). The limit of all rules together is
divided evenly among them, so with probability 1 - ``error`` no stratum loses
more than ``limit`` of its good documents. Among the certified cutoffs the one
that rejects most bad documents is taken, the laxest of equals; a rule that
would reject no more bad documents than good ones stays off.

Everything is DataFrame expressions; a text is scanned once, and only its
statistics are written. Documents meet the cutoffs of their stratum, a table of
at most rules x strata rows that is counted before it is broadcast.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import BLANK_CLASS, BLANKS, counted_broadcast, fresh, join_rows, scratch, split_words

SHARES = (0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.5, 0.8)


@dataclass(frozen=True)
class Rule:
    """Rejects where ``value`` (of a column of statistics) lies above, or below, a cutoff."""

    name: str
    cutoffs: tuple[float, ...]
    above: bool = True


#: Statistic, and its cutoffs from the laxest to the strictest.
RULES = (
    Rule("symbol_share", SHARES[::-1]),
    Rule("dup_line_share", SHARES[::-1]),
    Rule("repeat_share", SHARES[::-1]),
    Rule("word_length_high", (20.0, 15.0, 12.0, 10.0, 9.0, 8.0, 7.0)),
    Rule("word_length_low", (2.0, 2.5, 3.0, 3.5, 4.0), above=False),
)
#: Limit on the false rejections of all rules together, and the probability that the limit is broken anywhere.
LIMIT = 0.05
ERROR = 0.05
#: A caller may refuse tails of more terms than this; as given, every tail is summed, however many trials there are.
TAIL_TERMS: int | None = None


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents' columns without the text, and a struct ``stats`` (null texts count as empty).

    Three-word windows are compared by 64-bit hashes. To find those that occur
    twice, the low bits of each hash make room for its position, so that one
    sort of plain numbers brings equal windows together; the bits that remain
    (49 for 20,000 words) only propose, whole hashes decide. Documents whose
    windows are all different skip this. Each array is a column of its own, so
    that it is computed once.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    names = ("words", "lines", "hashes", "grams", "mask", "ranked", "places")
    words, lines, hashes, grams, mask, ranked, places = (fresh(x) for x in names)
    w, h, g, m, r, p = (F.col(x) for x in (words, hashes, grams, mask, ranked, places))
    none = F.array().cast("array<bigint>")
    frame = docs.withColumns(
        {
            words: split_words(whole, BLANK_CLASS),
            lines: F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""),
        }
    )
    frame = frame.withColumn(hashes, F.transform(w, lambda x: F.xxhash64(x)))
    frame = frame.withColumn(
        grams,
        F.when(F.size(w) < 4, none).otherwise(
            F.transform(
                F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))),
                lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)),
            )
        ),
    )
    bits = F.ceil(F.log2(F.size(w) + 1.0)).cast("int")
    frame = frame.withColumn(mask, F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    frame = frame.withColumn(
        ranked,
        F.when(F.size(F.array_distinct(g)) == F.size(g), none).otherwise(
            F.sort_array(F.transform(g, lambda x, i: x.bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("long"))))
        ),
    )

    def same(x: Column, k: Column) -> Column:
        other = F.get(r, k)
        near = x.bitwiseXOR(other).bitwiseAND(F.bitwise_not(m)) == 0
        return near & (F.get(g, x.bitwiseAND(m).cast("int")) == F.get(g, other.bitwiseAND(m).cast("int")))

    frame = frame.withColumn(
        places,
        F.sort_array(
            F.transform(
                F.filter(r, lambda x, k: F.coalesce(same(x, k + 1), F.lit(False)) | F.coalesce(same(x, k - 1), F.lit(False))),
                lambda x: x.bitwiseAND(m),
            )
        ),
    )
    covered = F.transform(
        p, lambda x, k: F.when(k + 1 < F.size(p), F.least(F.lit(3).cast("long"), F.get(p, k + 1) - x)).otherwise(3)
    )
    frame = frame.withColumn(
        "stats",
        F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.char_length(whole) - F.char_length(F.regexp_replace(whole, "[#*$%&|<>]+", "")))
            .cast("long")
            .alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
        ),
    )
    return frame.drop(words, lines, hashes, grams, mask, ranked, places, text)


def rule_values(stats: Column) -> dict[str, Column]:
    """Value of each rule; 0 words, characters or lines give 0."""

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(stats[part], stats[whole]), F.lit(0.0))

    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "word_length_high": share("word_chars", "n_words"),
        "word_length_low": share("word_chars", "n_words"),
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 8."""
    z = x + 8.0
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    product = x
    for k in range(1, 8):
        product = product * (x + float(k))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed from its largest term down. 1 where k is above the mean: no test passes there.

    Up to the mean each term is at most (1 - j / np) of the one before, where j terms lie between it and the largest.
    So j terms below the largest one is at most exp(-j (j - 1) / 2np) of it, which is exp(-50) at j = 10 sqrt(np) + 1:
    what lies beyond is lost in the rounding of the sum, whether it is added or not, and the sum takes some sqrt(n) terms.
    """
    k, n = k.cast("double"), n.cast("double")
    top = (
        log_gamma(n + 1.0)
        - log_gamma(k + 1.0)
        - log_gamma(n - k + 1.0)
        + k * math.log(p)
        + (n - k) * math.log1p(-p)
    )
    last = F.least(k, F.ceil(10 * F.sqrt(n * p)) + 10).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), last),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct(
            (a["term"] * (k - j) / (n - k + j + 1.0) * ((1 - p) / p)).alias("term"), (a["sum"] + a["term"]).alias("sum")
        ),
        lambda a: a["sum"],
    )
    beyond = k > n * p if TAIL_TERMS is None else (k > n * p) | (k > TAIL_TERMS)
    return F.when(beyond, F.lit(1.0)).otherwise(F.exp(top) * total)


def certified_cutoffs(
    holdout: DataFrame, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT, error: float = ERROR
) -> DataFrame:
    """(stratum, rule, cutoff): the chosen cutoffs.

    ``holdout`` has stratum, good (boolean) and stats, a row per labelled
    document that passes the base rules. Counting is one aggregation whose
    partial sums leave each task as one row per stratum.
    """
    values = rule_values(F.col("stats"))
    n_tests = sum(len(r.cutoffs) for r in rules)
    # a row per document and rule: its value, turned so that larger is worse, and the cutoffs likewise
    sign = {r.name: 1.0 if r.above else -1.0 for r in rules}
    measured = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                (values[r.name] * sign[r.name]).alias("value"),
                F.array(*[F.lit(c * sign[r.name]) for c in r.cutoffs]).alias("cutoffs"),
            )
            for r in rules
        ]
    )
    per_rule = holdout.select("stratum", "good", F.inline(measured))
    n_broken = F.size(F.filter("cutoffs", lambda c: F.col("value") > c))
    per_rule = per_rule.groupBy("stratum", "rule", "cutoffs", n_broken.alias("broken")).agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    # cutoffs get stricter by step, so those that a document breaks are the last ones
    all_steps = F.sequence(F.lit(0), F.size("cutoffs") - 1)
    tests = per_rule.select("*", F.explode(all_steps).alias("step")).groupBy("stratum", "rule", "step").agg(
        F.sum("good").alias("n"),
        F.abs(F.first(F.get("cutoffs", F.col("step")))).alias("cutoff"),
        *[
            F.sum(F.when(F.col("step") >= F.size("cutoffs") - F.col("broken"), F.col(c)).otherwise(0)).alias(name)
            for c, name in (("good", "false"), ("bad", "true"))
        ],
    )
    strata = holdout.agg(F.count_distinct("stratum").alias("strata"))
    passed = (
        tests.crossJoin(F.broadcast(strata))  # one row: the number of strata
        .where(binomial_tail(F.col("false"), F.col("n"), limit / len(rules)) <= error / (n_tests * F.col("strata")))
        .where(F.col("true") > F.col("false"))
    )
    best = F.max_by(F.col("cutoff"), F.struct(F.col("true") - F.col("false"), -F.col("step")))
    return passed.groupBy("stratum", "rule").agg(best.alias("cutoff"))


def quality_filter(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    limit: float = LIMIT,
    error: float = ERROR,
) -> DataFrame:
    """A row per document: doc_id, lang, text_key (the text's hash), stats, base_failed, rejected_by, kept.

    Needs doc_id, text, lang. ``labels`` has doc_id and quality; an id with
    several labels counts as good if none of them is 0, a null label says
    nothing. A null language is a stratum of its own, apart from ''. Equal
    texts of a stratum are one trial, good if no label of theirs is 0. The
    bound is on good documents that pass the base rules and are then rejected;
    those that the base rules reject are not counted. Null, empty and blank
    texts fail the base rule. Repeated rows are judged alike; without labels
    the base rules alone decide.
    """
    tables = scratch(spark)
    needed = docs.select("doc_id", "lang", text_key().alias("text_key"), "text")
    measured = tables.save(statistics(needed), "statistics").withColumn("base_failed", base_failed(F.col("stats")))
    graded = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.min("quality") > 0).alias("good"))
    )
    stratum = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("null"))
    holdout = measured.where("NOT base_failed").select("doc_id", stratum.alias("stratum"), "text_key", "stats")
    # copies of a text are no independent trials: a stratum counts it once, as good if no label says otherwise
    holdout = holdout.join(graded, "doc_id").groupBy("stratum", "text_key")
    holdout = tables.save(holdout.agg(F.min("good").alias("good"), F.first("stats").alias("stats")), "holdout")
    cutoffs = tables.save(certified_cutoffs(holdout, rules, limit, error), "cutoffs")
    per_stratum = cutoffs.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")
    )
    per_stratum = counted_broadcast(tables.save(per_stratum, "per_stratum"))
    values = rule_values(F.col("stats"))
    broken = [
        F.when(
            (values[r.name] > F.col("cutoffs")[r.name]) if r.above else (values[r.name] < F.col("cutoffs")[r.name]),
            F.lit(r.name),
        )
        for r in rules
    ]
    return (
        measured.withColumn("stratum", stratum)
        .join(per_stratum, "stratum", "left")
        .withColumn("rejected_by", F.array_compact(F.array(*broken)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
        .drop("stratum", "cutoffs")
    )


def accepted(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns. Rows are told apart by doc_id, lang and text."""
    key = fresh("text_key")
    keyed = docs.withColumn(key, text_key())
    out = quality_filter(spark, docs, labels).where("NOT kept").select("doc_id", "lang", F.col("text_key").alias(key))
    out = counted_broadcast(scratch(spark).save(out.distinct(), "rejected"))
    return join_rows(keyed, out, ["doc_id", "lang", key], "left_anti").select(*docs.columns)


def text_key() -> Column:
    return F.xxhash64("text", F.octet_length("text"))
