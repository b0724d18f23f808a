"""A log-bilinear language model trained by noise-contrastive estimation, and add-one unigrams beside it.

Words are counted over all training documents. Every word belongs to one of K
classes: the most frequent words are classes of their own, the other COMMON ones
share a class with those that stand among the same frequent words, the words
beyond them are the class RARE, and END closes each document. With the classes
of the two words before a token, u and v,

    score(w | u, v) = (q[u] C1 + q[v] C2) . r[w] + b[w]

is the score of class w, and a word's probability is that of its class times its
share of the class: of all tokens there, and in RARE, which also holds one
unknown word, its add-one share. So the model is normalised over all known words
and one unknown word, and every word but the rare ones is a context that tells
something and is foretold by its context.

Classes come from the neighbours of each word in all training documents: the
frequent words within REACH tokens, as a random projection in whole numbers, so
that the sum is the same in any order. Spherical k-means over these at most
COMMON short vectors groups the words.

Training reads every training document PASSES times. Each task turns its tokens
into distinct triples with counts and runs NCE steps over them in numpy, with
noise drawn from the class frequencies; the tasks' parameters are averaged by
tokens and start the next round. What a task hands on is one block of
parameters, whatever it has read.

Scoring uses three K x K tables made by matrix products from the parameters:
two with the scores of all pairs, one with the normaliser of every context.

Counts of the words beyond the COMMON most frequent ones, which are unbounded,
meet the documents in a shuffled join. No word there is frequent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import scratch, training_row

RARE, END = 0, 1
END_WORD = b"\n"  # no word contains a blank
#: Classes, RARE and END among them; the part of them that is one word each; words that have or share a class.
CLASSES = 1024
HEADS = 0.6
COMMON = 100_000
#: Numbers that describe a word's neighbours, tokens to each side that are looked at, rounds of k-means.
TRAITS = 24
REACH = 3
MEANS = 8
#: Words whose neighbours' numbers travel as one row; tokens that are looked at together.
BLOCK = 4096
TOKENS = 200_000
DIMENSIONS = 24
NOISE = 32
#: Triples of a step: a 64th of what a task has, within these bounds.
LEAST_BATCH = 64
BATCH = 4096
RATE = 0.1
ROUNDS = 2
PASSES = 2
#: Distinct words that a task counts before it hands counts on; distinct triples that a task trains on at a time.
FLUSH = 500_000
#: Bytes of text that are cut into words together.
CHARS = 4_000_000
TRIPLES = 4_000_000
#: Tasks that add up parameters before the driver does.
ADDERS = 8


class Model(NamedTuple):
    q: np.ndarray
    c1: np.ndarray
    c2: np.ndarray
    r: np.ndarray
    b: np.ndarray

    def packed(self) -> bytes:
        return np.concatenate([x.ravel() for x in self]).astype("<f4").tobytes()

    def unpacked(self, data: np.ndarray) -> Model:
        cuts = np.cumsum([x.size for x in self])[:-1]
        return Model(*[part.reshape(x.shape) for part, x in zip(np.split(data, cuts), self, strict=True)])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about CHARS bytes of text, a longer document alone; null texts are empty."""
    place = batch.schema.get_field_index("text")
    batch = batch.set_column(place, "text", pc.fill_null(batch.column(place), ""))
    before = np.cumsum(pc.binary_length(batch.column(place)).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        passed = before[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(before, passed + CHARS, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, one after the other, as ``words_of`` gives them, and how many each text has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = parts.flatten()
    real = pc.greater(pc.binary_length(words), 0)  # blanks at an end leave an empty part there
    passed = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False), dtype=np.int64)
    return words.filter(real).cast(pa.binary()), np.diff(passed[ends], prepend=0)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): tokens per word over the documents; END_WORD once per document."""

    def summed_up(counted: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(counted).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return sums.select(["word", "n_sum"]).rename_columns(["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: list[pa.Table] = []
        held = 0
        for batch in batches:
            for part in parts_of(batch):
                words = split_texts(part.column("text"))[0].dictionary_encode()
                n = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
                counted.append(pa.table({"word": words.dictionary, "n": pa.array(n, pa.int64())}))
                counted.append(pa.table({"word": pa.array([END_WORD], pa.binary()), "n": pa.array([part.num_rows], pa.int64())}))
                held += len(n)
                if held > FLUSH:
                    counted = [summed_up(counted)]
                    held = counted[0].num_rows
                    if 2 * held > FLUSH:
                        yield from counted[0].to_batches()
                        counted, held = [], 0
        if counted:
            yield from summed_up(counted).to_batches()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """At most ``most`` words, the most frequent first; of words about as frequent (within 0.5 %) all or none.

    A histogram of the logarithms of the counts gives the cut, so that no task sends more than it has to.
    """
    step = F.floor(F.log("n") * 200)
    left, least = most, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):  # a few thousand steps
        left -= row["count"]
        if left < 0:
            break
        least = row["step"]
    if least is None:
        return {}
    found = counts.where(step >= least).collect()  # at most ``most`` rows
    return {bytes(r["word"]): r["n"] for r in sorted(found, key=lambda r: (-r["n"], bytes(r["word"])))}


def encoded(docs: DataFrame, common: dict[bytes, int]) -> DataFrame:
    """A row per document: row (unique), doc_id, held_out, n_tokens, known, logs (sum of log10(count + 1) over the common
    words), ids (places of the tokens in ``common``, 32 bits each, its length for other words), others (words that are
    not common, with their number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = pa.array(list(common), pa.binary())
        seen = np.array([*common.values(), 0], np.int64)
        logs = np.log10(seen + 1.0)
        other, end = len(common), list(common).index(END_WORD)
        row = TaskContext.get().partitionId() << 33

        def rare(words: pa.Array, document: np.ndarray, n_documents: int) -> pa.Array:
            """Per document a list of its distinct ``words`` with their number."""
            named = words.dictionary_encode()
            size = max(1, len(named.dictionary))
            keys, n = np.unique(document * size + named.indices.to_numpy(), return_counts=True)
            pairs = pa.StructArray.from_arrays([named.dictionary.take(pa.array(keys % size)), pa.array(n, pa.int64())], ["word", "n"])
            return pa.ListArray.from_arrays(np.searchsorted(keys, np.arange(n_documents + 1) * size).astype(np.int32), pairs)

        for batch in batches:
            for part in parts_of(batch):
                words, n_words = split_texts(part.column("text"))
                place = pc.index_in(words, value_set=shared)
                document = np.repeat(np.arange(part.num_rows), n_words)
                at = np.full(len(words) + part.num_rows, end, np.int64)  # a document's words, then its end
                at[np.arange(len(words)) + document] = pc.fill_null(place, other).to_numpy()
                ends = np.cumsum(n_words + 1)
                known = np.add.reduceat((seen[at] > 0).astype(np.int64), ends - n_words - 1)
                log = logs[at]
                total = [float(log[e - n - 1 : e].sum()) for e, n in zip(ends.tolist(), n_words.tolist(), strict=True)]
                missing = place.is_null()
                others = rare(words.filter(missing), document[missing.to_numpy(zero_copy_only=False)], part.num_rows)
                offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
                ids = [None, pa.py_buffer(offsets), pa.py_buffer(at.astype("<u4"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(part.num_rows)),
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(n_words + 1),
                        pa.array(known),
                        pa.array(total),
                        pa.Array.from_buffers(pa.binary(), part.num_rows, ids),
                        others,
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "logs", "ids", "others"],
                )
                row += part.num_rows

    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, ids binary, "
        "others array<struct<word:binary,n:long>>"
    )
    return docs.mapInArrow(run, schema)


def neighbours(ids: np.ndarray, lengths: np.ndarray, traits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each token ``at``, the sum of the ``traits`` of those within REACH in its document; their last row is zero."""
    none = len(traits) - 1
    document = np.pad(np.repeat(np.arange(len(lengths)), lengths), REACH, constant_values=-1)
    near = np.pad(np.minimum(ids, none), REACH, constant_values=none)
    out = np.zeros((len(at), traits.shape[1]), traits.dtype)
    own = document[at + REACH]
    for k in range(2 * REACH + 1):
        if k != REACH:
            out += traits.take(np.where(document[at + k] == own, near[at + k], none), axis=0)
    return out


def word_traits(rows: DataFrame, heads: int, common: int) -> np.ndarray:
    """A row per common word that is no head: sums of the traits of the heads beside it, and last their number.

    ``rows`` has ids, in which 0 is END and the heads come next.
    """
    rng = np.random.default_rng(11)
    # a frequent head says less; END and words that are no heads say nothing
    scale = np.minimum(1, np.sqrt((1 + np.arange(heads)) / max(1, heads)))[:, None]
    told = np.rint(40 * scale * rng.normal(0, 1, (heads, TRAITS)))
    empty = np.zeros((1, TRAITS + 1))
    traits = np.concatenate([empty, np.concatenate([told, np.ones((heads, 1))], axis=1), empty]).astype(np.int32)
    first, size = heads + 1, common - heads - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, TRAITS + 1), np.int32)

        def add(held: list[np.ndarray], counted: list[np.ndarray]) -> None:
            ids = np.concatenate(held)
            at = np.flatnonzero((ids >= first) & (ids < common) & np.concatenate(counted))
            at = at[np.argsort(ids[at], kind="stable")]
            if len(at):
                found = neighbours(ids, np.array([len(x) for x in held]), traits, at)
                words = ids[at].astype(np.int64) - first
                starts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
                total[words[starts]] += np.add.reduceat(found, starts)

        held: list[np.ndarray] = []
        counted: list[np.ndarray] = []
        tokens = 0
        for batch in batches:
            for ids in batch.column(0):
                whole = np.frombuffer(ids.as_py(), "<u4")
                for begin in range(0, len(whole), TOKENS):  # a long document in parts, each with its surroundings
                    place = np.arange(max(0, begin - REACH), min(len(whole), begin + TOKENS + REACH))
                    held.append(whole[place])
                    counted.append((place >= begin) & (place < begin + TOKENS))
                    tokens += len(place)
                    if tokens >= TOKENS:
                        add(held, counted)
                        held, counted, tokens = [], [], 0
        if held:
            add(held, counted)
        for begin in range(0, size, BLOCK):
            part = total[begin : begin + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([begin]), pa.array([part.tobytes()], pa.binary())], ["begin", "part"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for batch in batches:
            for begin, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole[begin] = whole.get(begin, 0) + np.frombuffer(part.as_py(), np.int32).astype(np.int64)
        for begin, part in whole.items():
            yield pa.RecordBatch.from_arrays([pa.array([begin]), pa.array([part.tobytes()], pa.binary())], ["begin", "part"])

    out = np.zeros((max(0, size), TRAITS + 1))
    if size > 0:
        schema = "begin long, part binary"
        blocks = rows.select("ids").mapInArrow(run, schema).repartition(ADDERS, "begin").mapInArrow(sums, schema)
        for r in blocks.collect():  # one row per block of words
            part = np.frombuffer(bytes(r["part"]), np.int64).reshape(-1, TRAITS + 1)
            out[r["begin"] : r["begin"] + len(part)] = part
    return out


def word_groups(traits: np.ndarray, counts: np.ndarray, groups: int) -> np.ndarray:
    """Group of each word by spherical k-means, which starts at the first ``groups`` words; no words, no groups."""
    met = traits[:, -1:]
    usual = traits[:, :-1].sum(axis=0) / max(1.0, met.sum())
    x = traits[:, :-1] - met * usual
    x = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    weight = np.sqrt(counts).astype(np.float32)[:, None]
    centres, group = x[:groups], np.zeros(len(x), np.int64)
    for _ in range(MEANS if len(x) else 0):
        for begin in range(0, len(x), 10_000):
            group[begin : begin + 10_000] = (x[begin : begin + 10_000] @ centres.T).argmax(axis=1)
        moved = summed(weight * x, group, len(centres))
        length = np.linalg.norm(moved, axis=1, keepdims=True)
        centres = np.where(length > 0, moved / np.maximum(length, 1e-9), centres)
    return group


def class_ids(documents: list[bytes], classed: np.ndarray) -> list[bytes]:
    """The documents' tokens as classes, 16 bits each."""
    return [classed[np.frombuffer(d, "<u4")].tobytes() for d in documents]


def contexts(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(v, u, w, lengths): all tokens with the two classes before them; END stands before a document."""
    lengths = np.array([len(d) // 2 for d in documents], np.int64)
    w = np.frombuffer(b"".join(documents), "<u2")
    starts = np.cumsum(lengths) - lengths
    u = np.concatenate([[END], w[:-1]]).astype(np.uint16) if len(w) else w
    v = np.concatenate([[END, END], w[:-2]]).astype(np.uint16)[: len(w)] if len(w) else w
    u[starts], v[starts] = END, END
    v[(starts + 1)[lengths > 1]] = END
    return v, u, w, lengths


def summed(rows: np.ndarray, index: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of each index."""
    order = np.argsort(index, kind="stable")
    ordered = index.take(order)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out = np.zeros((size, rows.shape[1]), np.float32)
    out[ordered.take(first)] = np.add.reduceat(rows.take(order, axis=0), first)
    return out


def nce_steps(model: Model, squares: Model, triples: np.ndarray, counts: np.ndarray, noise: np.ndarray, rng) -> None:
    """Adagrad over the triples (columns v, u, w) in random order; ``model`` and ``squares`` change in place."""
    k = len(model.b)
    log_noise = np.log(NOISE * noise).astype(np.float32)
    order = rng.permutation(len(triples))
    size = min(BATCH, max(LEAST_BATCH, len(order) // 64))
    for begin in range(0, len(order), size):
        part = order[begin : begin + size]
        v, u, w = np.ascontiguousarray(triples.take(part, axis=0).T)
        weight = (counts[part] / counts[part].sum()).astype(np.float32)
        s = rng.choice(k, NOISE, p=noise)
        qu, qv, rw, rs = model.q.take(u, axis=0), model.q.take(v, axis=0), model.r.take(w, axis=0), model.r[s]
        context = qu @ model.c1 + qv @ model.c2
        good = (context * rw).sum(axis=1) + model.b[w] - log_noise[w]
        up = (1 / (1 + np.exp(np.clip(good, -30, 30)))) * weight  # pulls the true word up
        down = context @ rs.T
        down += model.b[s]
        down -= log_noise[s]
        np.negative(down, out=down)
        np.clip(down, -30, 30, out=down)
        np.exp(down, out=down)
        down += 1
        np.divide(1, down, out=down)
        down *= weight[:, None]  # pushes noise words down
        d_context = up[:, None] * rw - down @ rs
        d_r = summed(up[:, None] * context, w, k)
        np.subtract.at(d_r, s, down.T @ context)
        d_b = np.bincount(w, up, k).astype(np.float32)
        np.subtract.at(d_b, s, down.sum(axis=0))
        d_q = summed(d_context @ model.c1.T, u, k) + summed(d_context @ model.c2.T, v, k)
        for x, g, total in zip(model, (d_q, qu.T @ d_context, qv.T @ d_context, d_r, d_b), squares, strict=True):
            total += g * g
            x += RATE * g / (np.sqrt(total) + 1e-6)


def start_model(class_counts: np.ndarray) -> Model:
    rng = np.random.default_rng(7)
    k, d = len(class_counts), DIMENSIONS
    share = (class_counts + 1) / (class_counts + 1).sum()
    q, r = (rng.normal(0, 0.1, (k, d)).astype(np.float32) for _ in range(2))
    return Model(q, np.eye(d, dtype=np.float32), 0.5 * np.eye(d, dtype=np.float32), r, np.log(share).astype(np.float32))


def trained(
    rows: DataFrame, model: Model, class_counts: np.ndarray, classed: np.ndarray, rounds: int = ROUNDS, passes: int = PASSES
) -> Model:
    """The model after ``passes`` passes over the rows (row, ids), each dealt over ``rounds`` rounds."""
    noise = (class_counts + 1.0) / (class_counts + 1.0).sum()

    for step in range(rounds * passes):
        begin = model.packed()

        def run(batches: Iterator[pa.RecordBatch], begin: bytes = begin, step: int = step) -> Iterator[pa.RecordBatch]:
            own = model.unpacked(np.frombuffer(begin, "<f4").copy())
            squares = Model(*[np.full_like(x, 1e-4) for x in own])
            rng = np.random.default_rng([step, TaskContext.get().partitionId()])
            held: list[bytes] = []
            tokens = size = 0

            def learn() -> None:
                v, u, w, _ = contexts(class_ids(held, classed))
                keys, counts = np.unique((v.astype(np.int64) << 32) | (u.astype(np.int64) << 16) | w, return_counts=True)
                triples = np.stack([keys >> 32, (keys >> 16) & 0xFFFF, keys & 0xFFFF], axis=1).astype(np.uint16)
                nce_steps(own, squares, triples, counts, noise, rng)

            for batch in batches:
                for ids in batch.column(0):
                    held.append(ids.as_py())
                    size += len(held[-1]) // 4
                    if size >= TRIPLES:
                        learn()
                        tokens, size, held = tokens + size, 0, []
            if size:
                learn()
                tokens += size
            if tokens:
                block = (np.concatenate([x.ravel() for x in own]).astype(np.float64) * tokens).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary()), pa.array([tokens])], ["block", "tokens"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, tokens = None, 0
            for batch in batches:
                for block, n in zip(batch.column(0), batch.column(1), strict=True):
                    x = np.frombuffer(block.as_py(), np.float64)
                    total, tokens = x if total is None else total + x, tokens + n.as_py()
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([tokens])], ["block", "tokens"])

        schema = "block binary, tokens long"
        turn = rows.where(F.pmod(F.col("row"), F.lit(rounds)) == step % rounds).select("ids")
        sums = turn.mapInArrow(run, schema).repartition(ADDERS).mapInArrow(add, schema).collect()  # at most ADDERS rows
        if sums:
            total = sum(np.frombuffer(bytes(x["block"]), np.float64) for x in sums)
            model = model.unpacked((total / sum(x["tokens"] for x in sums)).astype(np.float32))
    return model


def score_tables(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 scores of (u, w) with the bias, of (v, w), and log10 normalisers of (v, u)."""
    near = (model.q @ model.c1) @ model.r.T + model.b
    far = (model.q @ model.c2) @ model.r.T
    k = len(model.b)
    norm = np.empty((k, k), np.float32)
    shift, shift_far = near.max(axis=1), far.max(axis=1)
    e_near, e_far = np.exp(near - shift[:, None]), np.exp(far - shift_far[:, None])
    for v in range(0, k, 256):  # sums of products of exponentials are a matrix product
        norm[v : v + 256] = np.log(e_far[v : v + 256] @ e_near.T) + shift_far[v : v + 256, None] + shift[None, :]
    scale = np.float32(1 / math.log(10))
    return near * scale, far * scale, norm * scale


def score_documents(
    spark: SparkSession, docs: DataFrame, classes: int = CLASSES, common: int = COMMON
) -> DataFrame:
    """A row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``docs`` has doc_id and text; those with crc32(doc_id as text) mod 7 = 2
    are held out from all counts and from training. A null text counts as
    empty, one END token; a null id as ''. Both scores are log10 probabilities
    of the whole text. Without training documents every token has base score 0
    and the neural model is its start.
    """
    tables = scratch(spark)
    held = ~training_row(F.col("doc_id"), 7, 2)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    counts = tables.save(word_counts(docs.where("NOT held_out")), "counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    vocabulary = most_frequent(counts, common)
    ends = vocabulary.pop(END_WORD, None)
    if ends is None:
        ends = counts.where(F.col("word") == END_WORD).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = {END_WORD: ends} | vocabulary
    seen = np.array(list(shared.values()), np.int64)
    heads = min(len(vocabulary), int(HEADS * (classes - 2)))

    rows = tables.save(encoded(docs, shared), "encoded")
    train = rows.where("NOT held_out")
    group = word_groups(word_traits(train, heads, len(shared)), seen[1 + heads :], classes - 2 - heads)
    classed = np.concatenate([[END], 2 + np.arange(heads), 2 + heads + group, [RARE]]).astype("<u2")
    class_counts = np.bincount(classed[:-1], seen, 2 + heads + int(group.max(initial=-1)) + 1).astype(np.int64)
    rare_words = v - len(vocabulary) - (ends > 0)
    class_counts[RARE] = n - class_counts.sum()
    rare_total = float(class_counts[RARE] + rare_words + 1)
    # log10 of a word's share of its class; a word of RARE gets log10(count + 1) from the join below
    share = np.append(np.log10(np.maximum(seen, 1) / np.maximum(class_counts[classed[:-1]], 1)), -math.log10(rare_total))
    model = trained(train, start_model(class_counts), class_counts, classed)
    shared_tables = spark.sparkContext.broadcast(score_tables(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, far, norm = shared_tables.value
        for batch in batches:
            if not batch.num_rows:
                continue
            documents = batch.column("ids").to_pylist()
            v, u, w, lengths = contexts(class_ids(documents, classed))
            logs = (near[u, w] + far[v, w] - norm[v, u]).astype(np.float64) + share[np.frombuffer(b"".join(documents), "<u4")]
            value = np.add.reduceat(logs, np.cumsum(lengths) - lengths)
            kept = batch.drop_columns(["ids"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(value)], [*kept.schema.names, "neural"])

    known = rows.select("row", F.inline("others")).join(counts.withColumnRenamed("n", "c"), "word")
    known = known.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("o_logs"), F.sum("n").alias("o_known"))
    plain = ["row", "doc_id", "held_out", "n_tokens", "known", "logs"]
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in plain) + ", neural double"
    scored = rows.select(*plain, "ids").mapInArrow(run, schema).join(known, "row", "left")
    o_logs = F.coalesce("o_logs", F.lit(0.0))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("o_known", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("logs") + o_logs - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
        (F.col("neural") + o_logs).alias("score"),
    )
