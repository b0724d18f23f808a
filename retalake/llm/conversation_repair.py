"""Repair of the turn structure of conversations by the cheapest edits.

A repaired conversation's role initials follow ``(s?(ua)+)?``. Rows are kept, given another role or deleted, and empty
rows inserted; blank and duplicate rows have to go. Of the cheapest edit scripts the one whose letters (D, I, K, R) are
the least string is taken.

Both criteria are one integer: cost in the high digits, below it the letters of the script as octal digits of a fixed
width, from the left, zeros behind them. A path through the graph of (row, state of the pattern) is extended by adding
an edge's cost and its letter's digit at the next place, and the smallest integer at each node is the answer. Keeping
one path per node is enough: scripts of equal cost over the same rows, from the same state to the same state, are no
prefixes of each other (a longer one would have an insertion more and cost more), so whatever follows leaves their
order as it is. For the same reason pieces of a conversation can be solved apart:

1. Rows that are equal in all columns become one with a count. First occurrences of a message are found by its digest.
2. Rows are sorted by range partitions over (conversation, turn), so a conversation of any size is spread over tasks.
   Each piece of at most ``PIECE`` rows yields its best script for every pair of entry and exit state, and its counts.
3. Pieces are joined in order, a conversation at a time, without texts. What all states agree on is settled and no
   longer compared.
4. Rows stream in order past the script of their conversation, which leads them as a row of its own; the result is
   hashed, or handed out, as it passes. A task holds one batch of texts, and one script per conversation.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from retalake.llm.common import BLANK_CLASS, grouped_rows, join_rows, scratch
from retalake.session import Scratch

#: Rows of a conversation that are solved at once; only speed depends on it.
PIECE = 512

# The pattern's states (at the start, after s, after u, after a), its steps, and where it may end.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEPS = {(START, "s"): 1, (START, "u"): 2, (AFTER_S, "u"): 2, (AFTER_U, "a"): 3, (AFTER_A, "u"): 2}
ENDS = (START, AFTER_A)
# Neighbours that are right, the edits' costs and the extra cost of a truncated row that stays.
LEGAL_PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: Edits in ascending order of their letters; their octal digits are 1 to 4, and 0 is the padding.
LETTERS = "DIKR"
DIGIT = {letter: k for k, letter in enumerate(LETTERS, 1)}
TO_DIGITS, TO_LETTERS = str.maketrans(LETTERS, "1234"), str.maketrans("1234", LETTERS)

#: What a task knows of a row: role initial, whether it has to go, whether it is truncated.
Mark = tuple[str, bool, bool]
#: Cost and letters of a script.
Script = tuple[int, str]


def weight(script: Script, width: int) -> int:
    """Cost, then the letters in ``width`` octal digits with zeros at the end."""
    cost, letters = script
    return cost << 3 * width | int(letters.translate(TO_DIGITS).ljust(width, "0") or "0", 8)


def wanted(state: int) -> str:
    """Initial of the only role that may be inserted or assigned in a state."""
    return "a" if state == AFTER_U else "u"


def piece_scripts(marks: list[Mark], entry: int) -> dict[int, Script]:
    """The best script over the rows from the state ``entry`` to every state that can be reached."""
    width = 2 * len(marks) + 1  # a row has at most an insertion before it and an edit
    layer = {entry: (0, 0)}  # per state: weight, letters used

    def extended(path: tuple[int, int], letter: str, cost: int) -> tuple[int, int]:
        value, used = path
        return value + (cost << 3 * width) + (DIGIT[letter] << 3 * (width - 1 - used)), used + 1

    def offer(to: dict[int, tuple[int, int]], state: int, path: tuple[int, int]) -> None:
        if state not in to or path[0] < to[state][0]:
            to[state] = path

    for initial, must_go, truncated in marks:
        before = dict(layer)
        for state, path in layer.items():
            offer(before, STEPS[state, wanted(state)], extended(path, "I", INSERT))
        layer = {}
        for state, path in before.items():
            offer(layer, state, extended(path, "D", DELETE))
            if not must_go:
                extra = TRUNCATED if truncated else 0
                offer(layer, STEPS[state, wanted(state)], extended(path, "R", REROLE + extra))
                if (state, initial) in STEPS:
                    offer(layer, STEPS[state, initial], extended(path, "K", extra))
    digits = {s: format(v & (1 << 3 * width) - 1, "o").zfill(width)[:n] for s, (v, n) in layer.items()}
    return {s: (v >> 3 * width, digits[s].translate(TO_LETTERS)) for s, (v, _) in layer.items()}


def least(candidates: Iterable[tuple[int, Script]]) -> dict[int, Script]:
    """The script of least weight per state."""
    found = list(candidates)
    width = max((len(letters) for _, (_, letters) in found), default=0)
    best: dict[int, tuple[int, Script]] = {}
    for state, script in found:
        value = weight(script, width)
        if state not in best or value < best[state][0]:
            best[state] = value, script
    return {state: script for state, (_, script) in best.items()}


class Joined:
    """Best scripts of the pieces of one conversation seen so far."""

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.open: dict[int, Script] = {START: (0, "")}

    def add(self, piece: dict[tuple[int, int], Script]) -> None:
        ways = [
            (leave, (self.open[enter][0] + cost, self.open[enter][1] + letters))
            for (enter, leave), (cost, letters) in piece.items()
            if enter in self.open
        ]
        self.open = least(ways)
        common = os.path.commonprefix([letters for _, letters in self.open.values()])
        self.settled.append(common)
        self.open = {state: (cost, letters[len(common) :]) for state, (cost, letters) in self.open.items()}

    def script(self) -> Script:
        """The whole script, perhaps with an insertion at the end."""
        ends = [(0, s) for state, s in self.open.items() if state in ENDS]
        ends += [(0, (c + INSERT, t + "I")) for state, (c, t) in self.open.items() if STEPS[state, wanted(state)] in ENDS]
        cost, letters = least(ends)[0]
        return cost, "".join(self.settled) + letters


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held = []
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


def pieces(marked: DataFrame) -> DataFrame:
    """A row per piece of a conversation, from rows sorted by range: where it stands, its counts and its best scripts."""
    counts = "n long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long"
    schema = StructType.fromDDL(
        f"part int, seq int, {counts}, head string, tail string, "
        "scripts array<struct<enter:int, leave:int, cost:long, letters:string>>"
    )
    schema = StructType([StructField("conv_id", marked.schema["conv_id"].dataType), *schema.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def solved() -> Iterator[tuple]:
            started, conv, seq, states, rows = False, None, 0, range(4), []

            def piece() -> tuple:
                turns = [r[1] for r in rows if r[1] is not None]
                marks = [(r[0], r[2] in ("blank", "duplicate"), r[2] == "truncated") for r in rows]
                faults = [sum(r[2] == f for r in rows) for f in ("blank", "duplicate", "truncated")]
                illegal = sum(a[0] + b[0] not in LEGAL_PAIRS for a, b in zip(rows, rows[1:]))
                scripts = [
                    {"enter": i, "leave": o, "cost": c, "letters": t} for i in states for o, (c, t) in piece_scripts(marks, i).items()
                ]
                low, high = (turns[0], turns[-1]) if turns else (None, None)
                return conv, part, seq, len(rows), *faults, illegal, len(set(turns)), low, high, rows[0][0], rows[-1][0], scripts

            for batch in batches:
                for c, turn, role, fault, copies in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                    for k in range(copies):
                        if started and (c != conv or len(rows) == PIECE):
                            yield piece()
                            same = c == conv
                            # a conversation that starts in this partition starts in the first state
                            seq, states, rows = (seq + 1, range(4), []) if same else (0, (START,), [])
                        started, conv = True, c
                        rows.append((role[:1], turn, "duplicate" if k and fault != "blank" else fault))
            if rows:
                yield piece()

        yield from batched(solved(), arrow)

    columns = marked.select("conv_id", "turn", "role", "fault", "copies")
    return columns.mapInArrow(run, schema)


def scripts(found: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit from the pieces of :func:`pieces`."""
    schema = StructType.fromDDL("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    schema = StructType([found.schema["conv_id"], *schema.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole() -> Iterator[tuple]:
            joined: Joined | None = None
            conv, tail, low, high = None, "", None, None
            totals = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)

            def result() -> tuple:
                gaps = 0 if low is None else high - low + 1 - totals["turns"]
                return conv, gaps, *(totals[k] for k in ("blank", "duplicate", "truncated", "illegal")), *joined.script()

            for batch in batches:
                for row in batch.to_pylist():
                    if joined is None or row["conv_id"] != conv:
                        if joined is not None:
                            yield result()
                        joined, conv, low, high = Joined(), row["conv_id"], None, None
                        totals = dict.fromkeys(totals, 0)
                    else:
                        totals["illegal"] += tail + row["head"] not in LEGAL_PAIRS
                        totals["turns"] -= high is not None and row["low"] == high
                    joined.add({(s["enter"], s["leave"]): (s["cost"], s["letters"]) for s in row["scripts"]})
                    for k in totals:
                        totals[k] += row[k]
                    tail = row["tail"]
                    if row["low"] is not None:
                        low, high = row["low"] if low is None else low, row["high"]
            if joined is not None:
                yield result()

        yield from batched(whole(), arrow)

    return found.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(run, schema)


class Replay:
    """Follows a script along the rows of its conversation and names the rows of the result."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _filled(self, letter: str, text: str) -> tuple[str, str, str]:
        role = "assistant" if self.state == AFTER_U else "user"
        self.state = STEPS[self.state, wanted(self.state)]
        return letter, role, text

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._filled("I", "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = STEPS[self.state, role[:1]]
            yield letter, role, text
        elif letter == "R":
            yield self._filled(letter, text)


def judged(rows: DataFrame, tables: Scratch) -> DataFrame:
    """The written rows without texts, equal ones once: conv_id, turn, role, message, copies, fault.

    ``fault`` is the first of blank, duplicate (role and text seen earlier), truncated, or ''.
    """
    ended = F.col("text").rlike(f"[.!?]{BLANK_CLASS}*\\z")
    blank = ~F.col("text").rlike("[^ \\t-\\r]")
    equal = rows.withColumns({"blank": blank, "ended": ended}).groupBy("conv_id", "turn", "role", "message")
    kinds = tables.save(equal.agg(F.count("*").alias("copies"), F.first("blank").alias("blank"), F.first("ended").alias("ended")), "kinds")
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))["turn"]
    firsts = kinds.groupBy("message").agg(earliest.alias("first_turn"), F.count("*").alias("places")).where("places > 1")
    placed = grouped_rows(kinds, tables.save(firsts, "firsts"), "message", "places", kinds.count(), "left")
    seen = F.col("places").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    fault = F.when(F.col("blank"), "blank").when(seen, "duplicate").when(~F.col("ended"), "truncated").otherwise("")
    return tables.save(placed.select("conv_id", "turn", "role", "message", "copies", fault.alias("fault")), "marked")


def prepared(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in the last two, and a digest of conversation, role and text."""
    space = F.lit(" ")
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    )
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("\0"))
    whole = F.concat_ws("\n", F.char_length(conv), F.char_length("role"), conv, "role", "text")
    return rows.withColumn("message", F.unhex(F.sha2(whole, 256)))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by crc32(``conv_id:turn``) % 20; a null counts as one space there and below.

    0 drops the row, 1 empties its text, 2 removes ``.``, ``!`` and ``?`` from it, 3 repeats the row, 4 makes it the user's.
    """
    space = F.lit(" ")
    place = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    fate = F.crc32(place) % 20
    text = F.coalesce("text", space)
    text = F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(fate == 4, "user").otherwise(F.coalesce("role", space))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))
    return rows.drop("copy")


def decided(rows: DataFrame, tables: Scratch) -> DataFrame:
    """The written counts and scripts per conversation of :func:`prepared` rows."""
    order = ("conv_id", "turn", "role", "message")
    ranged = judged(rows, tables).repartitionByRange(*order).sortWithinPartitions(*order)
    return tables.save(scripts(tables.save(pieces(ranged), "pieces")), "scripts")


def led_rows(rows: DataFrame, leaders: DataFrame) -> DataFrame:
    """Rows of each conversation in order, after the one row of ``leaders`` (conv_id, audit, ...) that it has."""
    both = leaders.withColumn("leads", F.lit(0)).unionByName(rows.withColumn("leads", F.lit(1)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "leads", "turn", "role", "message")


def replayed(ordered: DataFrame, schema: StructType, start: Callable[[dict], Callable[[tuple | None], Iterator[tuple]]]) -> DataFrame:
    """Result rows of ``start(leader)(edit)`` for the edits (letter, role, text) of every conversation, and for None at its end."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            replay, take = None, None

            def finished() -> Iterator[tuple]:
                if replay:
                    for edit in replay.inserted():
                        yield from take(edit)
                    yield from take(None)

            for batch in batches:
                for part in range(0, batch.num_rows, 256):
                    for row in batch.slice(part, 256).to_pylist():
                        if row["leads"] == 0:
                            yield from finished()
                            replay, take = Replay(row["audit"]), start(row)
                        else:
                            for edit in replay.row(row["role"], row["text"]):
                                yield from take(edit)
            yield from finished()

        yield from batched(results(), arrow)

    return ordered.mapInArrow(run, schema)


def repaired_turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (0, 1, ...), edit (K, R or I), role, text. Deleted rows are absent."""
    tables = scratch(spark)
    rows = prepared(conversations)
    schema = StructType.fromDDL("position long, edit string, role string, text string")
    schema = StructType([rows.schema["conv_id"], *schema.fields])

    def start(leader: dict) -> Callable[[tuple | None], Iterator[tuple]]:
        position = -1

        def take(edit: tuple | None) -> Iterator[tuple]:
            nonlocal position
            if edit:
                position += 1
                yield leader["conv_id"], position, *edit

        return take

    leaders = decided(rows, tables).select("conv_id", "audit")
    return replayed(led_rows(rows, leaders), schema, start)


def repair_report(spark: SparkSession, conversations: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``names`` (conv_id, one column, distinct) lists conversations that get a row even without rows of their own:
    zeros, an empty audit and the digest of the empty string. Rows are taken by turn, null turns first; rows of one
    turn by role and then by the digest of their message, so equal rows are neighbours. All rows with a null conv_id
    are one conversation. A null role or text is one space, which makes the row blank or its role illegal. An empty
    table gives no rows; other columns are not looked at.
    """
    tables = scratch(spark)
    rows = prepared(conversations)
    known = decided(rows, tables)
    if names is not None:
        known = join_rows(names, known, ["conv_id"])
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    leaders = known.fillna({**zeros, "audit": ""}, subset=[*zeros, "audit"])
    columns = ["conv_id", *zeros, "audit"]
    schema = leaders.select(columns).schema.add("repaired_sha256", StringType())

    def start(leader: dict) -> Callable[[tuple | None], Iterator[tuple]]:
        digest, first = hashlib.sha256(), True

        def take(edit: tuple | None) -> Iterator[tuple]:
            nonlocal first
            if edit is None:
                yield *(leader[c] for c in columns), digest.hexdigest()
            else:
                digest.update(f"{'' if first else chr(10)}{edit[1]}:{edit[2]}".encode())
                first = False

        return take

    return replayed(led_rows(rows, leaders.select(columns)), schema, start)


def damaged_and_repaired(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """:func:`repair_report` of the :func:`damaged` conversations, with a row for every original conv_id."""
    return repair_report(spark, damaged(conversations), conversations.select("conv_id").distinct())
