"""Filter interaction audit, exact duplicates by an index, conversation repair: against brute force on small tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from functools import cache

import pytest
from pyspark.sql import functions as F

from retalake.llm import conversation_repair, exact_dedup, filter_audit
from retalake.llm.common import grouped_rows, scratch
from retalake.session import session_conf

BLANKS = "[ \t-\r]+"


# --- rows and their groups


@pytest.mark.parametrize("how", ["inner", "left"])
def test_grouped_rows(spark, how):
    rows = spark.createDataFrame([("hot", i) for i in range(50)] + [("b", 1), ("b", 2), ("c", 3)], "k string, i int")
    groups = spark.createDataFrame([("hot", 50), ("b", 2)], "k string, n long")
    found = grouped_rows(rows, groups, "k", "n", 5000, how)  # hot: more than 5 rows
    assert Counter(r.n for r in found.collect()) == Counter({50: 50, 2: 2} | ({None: 1} if how == "left" else {}))


# --- filter audit


def brute_shapley(values, n):
    shares = [Fraction(0)] * n
    orders = list(itertools.permutations(range(n)))
    for order in orders:
        seen = 0
        for f in order:
            shares[f] += Fraction(values[seen | 1 << f] - values[seen], len(orders))
            seen |= 1 << f
    return shares


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6])
def test_least_squares_give_shapley_values(n):
    rng = random.Random(n)
    for _ in range(5):
        values = [0] + [rng.randrange(10**12) for _ in range((1 << n) - 1)]
        assert filter_audit.shapley(values, n) == brute_shapley(values, n)


def brute_audit(docs, labels):
    """Every document walks through every order."""
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in re.split(BLANKS, text) if w]
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        fails += "E" * any(j is not None and i is not None and j < i and (t or "") == text for j, t, _ in docs)
        rows.append((lang or "", fails, i in good, i in toxic))
    result = []
    for part in {r[0] for r in rows}:
        inside, found, shares = [r for r in rows if r[0] == part], [], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left, gone = inside, []
            for step, f in enumerate(order, 1):
                removed, stay = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                redundant = sum(f in r[1] for r in gone)
                alone = sum(r[1] == f for r in inside)
                lost = sum(r[2] for r in removed), sum(r[3] for r in removed)
                shares[f] += len(removed)
                found.append((part, order, step, len(stay), len(removed), redundant, alone, *lost, f))
                left, gone = stay, gone + removed
        result += [(*r[:-1], shares[r[-1]]) for r in found]
    return Counter(result)


def test_audit_against_a_walk_through_all_orders(spark):
    rng = random.Random(3)
    words = ["a", "B", "c#", "dd", "EE", "f", "g", "h\n", "\xa0i"]
    docs = []
    for i in range(120):
        size = rng.choice([0, 3, 150, 200, 260])
        pool = words if rng.random() < 0.5 else [f"w{k}" for k in range(400)]
        docs.append((i, " ".join(rng.choice(pool) for _ in range(size)), rng.choice(["en", "de", None, ""])))
    docs += [(i, docs[5][1], "en") for i in range(200, 230)]  # a hot text
    docs += [(None, None, None), (None, "x", "fr"), (7, "x", "fr"), (7, "x", "fr"), (900, "x" * 300_000 + " Y", "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 230, 2)] + [(2, 1, 0), (None, 1, 1)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, lang string, part string, mask int")
    marks = spark.createDataFrame([(*m, 1) for m in labels], "doc_id long, quality int, toxic int, good int")
    found = filter_audit.document_audit(spark, df, marks)
    assert found.columns == [f.split()[0] for f in filter_audit.STEPS.split(", ")]
    assert Counter(tuple(r) for r in found.collect()) == brute_audit(docs, labels)


def test_audit_of_nothing_and_of_other_filters(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert filter_audit.document_audit(spark, empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    rows = spark.createDataFrame([("p", 1, 5), ("p", None, 5), (None, 3, 0)], "part string, x int, y int")
    found = filter_audit.audit(rows, {"X": F.col("x") > 0, "Y": F.col("y") > 0}, F.col("part"), F.lit(None), F.lit(True))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found.collect()}
    assert got["p", "XY", 2] == (0, 1, 1, 1, 0, 1, 3)
    assert got["", "YX", 1] == (1, 0, 0, 0, 0, 0, 0)
    with pytest.raises(ValueError, match="a letter each"):
        filter_audit.audit(rows, {}, F.col("part"), F.lit(True), F.lit(True))


# --- exact duplicates


def brute_copies(docs, known=None):
    """(doc_id, keep_id, size, kept, digest) counted; rows that share text and doc_id: one stays."""
    groups = defaultdict(list)
    for i, text in docs:
        groups[re.sub(BLANKS, " ", text or "")].append(i)
    found = Counter()
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep, free = (min(named) if named else None), True
        if known and text in known:
            keep, free = known[text], False
        for i in ids:
            stays = free and i == keep
            free = free and not stays
            found[i, keep, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()] += 1
    return found


DOCS = [(9, "a b"), (3, "a \t\n b"), (4, "a  b "), (5, " a b"), (6, "A b"), (None, "a b"), (7, None), (8, ""), (1, " "), (1, "\r")]
DOCS += [(11, "x"), (11, "x"), (None, "only"), (None, "only"), (12, "long " * 60_000), (13, "long " * 60_000), (14, "\xa0"), (15, "é")]
DOCS += [(i, "hot") for i in range(500, 560)]


def test_copies_against_brute_force(spark):
    df = spark.createDataFrame([(*d, 1, "p", b"x") for d in DOCS], "doc_id long, text string, group_size int, place string, digest binary")
    before = {t.name for t in spark.catalog.listTables()}
    found = exact_dedup.deduplicated_once(spark, df.repartition(5))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == brute_copies(DOCS)
    assert {t.name for t in spark.catalog.listTables()} == before
    kept = exact_dedup.kept_documents(df, found, scratch(spark))
    assert kept.columns == df.columns
    assert Counter((r.doc_id, hashlib.sha256(re.sub(BLANKS, " ", r.text or "").encode()).hexdigest()) for r in kept.collect()) == Counter(
        (r.doc_id, r.text_sha256) for r in found.where("kept").collect()
    )
    assert exact_dedup.deduplicated_once(spark, df.limit(0)).count() == 0


def test_new_batches_meet_the_index(spark):
    schema = "doc_id long, text string"
    tables = scratch(spark)
    index = exact_dedup.DigestIndex(spark, "digests_of_a_test", tables.path("index"), 100)
    first, second = [(5, "a"), (6, "a"), (7, "b")], [(1, "a"), (2, "c"), (3, "c"), (7, "b"), (None, "d")]
    try:
        frame = spark.createDataFrame
        one = exact_dedup.deduplicated(frame(first, schema), index, "day-1", scratch(spark))
        assert Counter(tuple(r) for r in one.collect()) == brute_copies(first)
        expected = brute_copies(second, {"a": 5, "b": 7})
        for _ in range(2):  # a batch that runs again gets the same verdicts
            two = exact_dedup.deduplicated(frame(second, schema), index, "day-2", scratch(spark))
            assert Counter(tuple(r) for r in two.collect()) == expected
            assert sorted(r.batch for r in index.rows().collect()) == ["day-1"] * 2 + ["day-2"] * 2
        again = exact_dedup.DigestIndex(spark, "digests_of_a_test", tables.path("index"), 10**9)
        assert again.buckets == index.buckets == 8
        groups = scratch(spark).save(frame([(b"1",)], "digest binary"), "groups")
        with_plan = again.unknown(groups, "day-3")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in with_plan and "LeftAnti" in with_plan and "Bucketed: true" in with_plan
        assert with_plan.count("Exchange") == 1  # of the new digests
        with pytest.raises(ValueError, match="batch"):
            index.forget("../x")
    finally:
        index.drop()


# --- conversations


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def in_order(rows):
    """By turn, null first; one turn's rows by role, then by the digest that the operator documents."""

    def key(r):
        conv = "\0" if r[0] is None else str(r[0])
        whole = "\n".join([str(len(conv)), str(len(r[2])), conv, r[2], r[3]])
        return (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(whole.encode()).digest())

    return sorted(rows, key=key)


def faults_of(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        solid = re.sub("[ \t-\r]+$", "", text)
        if not solid:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def brute_scripts(rows, faults, most_inserts):
    """Least (cost, letters, result) of all edit scripts, by going through all of them."""

    @cache
    def best(i, initials_end, count, inserts):
        """Rest of the script from row i; the result so far ends in that initial and has ``count`` rows."""

        def fits(initial):
            if initial == "s":
                return count == 0
            return initial == "u" and initials_end in ("", "s", "a") or initial == "a" and initials_end == "u"

        ways = []
        if i == len(rows) and initials_end in ("", "a"):
            ways.append((0, "", ()))
        if inserts < most_inserts:
            for role in ("user", "assistant"):
                if fits(role[0]):
                    for c, t, r in best(i, role[0], count + 1, inserts + 1):
                        ways.append((c + 2, "I" + t, ((role, ""), *r)))
        if i < len(rows):
            role, text = rows[i][2:]
            ways += [(c + 3, "D" + t, r) for c, t, r in best(i + 1, initials_end, count, inserts)]
            late = faults[i] == "truncated"
            if faults[i] not in ("blank", "duplicate"):
                for to, letter, cost in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    if fits(to[:1]):
                        more = best(i + 1, to[:1], count + 1, inserts)
                        ways += [(c + cost + late, letter + t, ((to, text), *r)) for c, t, r in more]
        return sorted(ways)[:1]

    return best(0, "", 0, 0)[0]


def brute_report(rows, originals, most_inserts=3):
    result = {}
    for conv in originals:
        mine = in_order([r for r in rows if r[0] == conv])
        faults = faults_of(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, repaired = brute_scripts(mine, faults, most_inserts)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        result[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return result


def talks(seed, count, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "ua", None]
    texts = ["Yes.", "No", "  ", "", None, "Why?", "Well!\n", "a\nb.", "é", "Yes."]
    rows = []
    for conv in range(count):
        for turn in range(rng.randrange(most + 1)):
            turn = rng.choice([turn, turn, turn, turn + 1, None])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def reported(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("piece", [1, 3, 512])
def test_repair_against_all_scripts(spark, monkeypatch, piece):
    """Also where conversations are cut into pieces, and spread over partitions."""
    rows = talks(piece, 60, 7) + [(None, 0, "user", "Hm."), (None, None, "assistant", "So."), (77, 1, "system", "x." * 100_000)]
    monkeypatch.setattr(conversation_repair, "PIECE", piece)
    df = spark.createDataFrame([(*r, "c", 9) for r in rows], SCHEMA + ", fault string, copies int").repartition(4)
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    expected = brute_report(clean, {r[0] for r in rows})
    assert reported(conversation_repair.repair_report(spark, df)) == expected
    turns = conversation_repair.repaired_turns(spark, df).collect()
    told = defaultdict(list)
    for r in sorted(turns, key=lambda r: r.position):
        told[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, facts in expected.items():
        assert hashlib.sha256("\n".join(told[conv]).encode()).hexdigest() == facts[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(t[0] for t in told[conv]))


def test_damage_and_conversations_without_rows(spark):
    dropped = [(c, 0) for c in range(200, 300) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = talks(5, 80, 5) + [(c, t, "user", "x") for c, t in dropped]
    found = conversation_repair.damaged_and_repaired(spark, spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    after = brute_damage(rows)
    assert reported(found) == brute_report(after, {r[0] for r in rows})
    assert {r[0] for r in rows} - {r[0] for r in after}  # such conversations are among them
    assert conversation_repair.damaged_and_repaired(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_conversation_is_spread(spark):
    """Its pieces come from several tasks, and a message that repeats a lot is deleted but for its first time."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "Same." if t % 7 == 0 else f"Turn {t}.") for t in range(6000)]
    rows += [(1, 6000, "user", "Again.")] * 3000
    df = spark.createDataFrame(rows, SCHEMA)
    tables = scratch(spark)
    with session_conf(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):  # as if partitions were large
        known = conversation_repair.decided(conversation_repair.prepared(df), tables).collect()
    pieces = spark.read.parquet(tables.path("pieces"))
    assert pieces.agg(F.max("n")).first()[0] <= conversation_repair.PIECE
    assert pieces.select("part").distinct().count() > 1
    (row,) = known
    seen, expected = set(), 0
    for r in rows:
        expected += (r[2], r[3]) in seen
        seen.add((r[2], r[3]))
    assert row.duplicate == expected and len(row.audit.replace("I", "")) == len(rows)
    assert row.cost == sum({"D": 3, "I": 2, "K": 0, "R": 2}[x] for x in row.audit)


def test_integers_order_scripts_like_pairs():
    rng = random.Random(1)
    scripts = [(rng.randrange(4), "".join(rng.choice("DIKR") for _ in range(rng.randrange(5)))) for _ in range(300)]
    by_weight = sorted(scripts, key=lambda s: conversation_repair.weight(s, 5))
    assert by_weight == sorted(scripts)
