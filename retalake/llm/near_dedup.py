"""Near-duplicate documents: MinHash, banding, exact verification, connected components.

1. Each text becomes its set of distinct word shingles (64-bit hashes) and a
   sketch: 128 minima under universal hash functions, 16 bits of each.
2. Texts of equal sets are one class, so copies cost one row from here on.
3. Bands of four minima put classes into buckets: 32 bands miss a pair of
   similarity 0.85 with probability (1 - 0.85^4)^32 < 1e-10.
4. In each bucket every class is compared with one pivot. Pivots differ between
   the bands, so dense groups mostly merge here, and the number of comparisons
   is linear.
5. Buckets whose classes are then still in different components are compared
   completely, except inside a component, over a finer sketch of 5120 minima,
   and each pair only in the first band that it shares. Large buckets are cut
   into blocks that different tasks compare. A fine sketch travels once for
   each bucket and block, so it keeps two mixed bits of a minimum: these tell
   about as much as four times the bytes do with a byte of 4096 minima.
6. A fine sketch rules a pair out when it lies six standard deviations under
   the threshold; every other pair is decided on full sets.
7. Components by large-star and small-star; the smallest id names each.

Sets and fine sketches are made for the documents that a semi join with the written
ids in question leaves. Spark chooses that join by the size of the ids: texts stay
where they are while it is small, and are shuffled beyond.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import counted_broadcast, fresh, giving_back, join_rows, scratch
from retalake.llm.components import connected_components
from retalake.session import Scratch, release_shuffles

ROWS = 4
BANDS = 32  # at most 64: their number takes the low bits of a bucket
#: Minima of a fine sketch, of which two bits each are kept.
FINE = 5120
#: Classes of one bucket that one task compares with each other.
BLOCK = 1024
#: Known word hashes that a worker keeps, texts that it turns into sets before it hands on what it made of them, and
#: products that it holds at a time; only speed and memory depend on them.
CACHE = 65_536
ROWS_AT_A_TIME = 500
PRODUCTS = 1 << 18
#: Standard deviations under the threshold at which a sketch may rule a pair out.
DEVIATIONS = 6.0


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_words = WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; of the whole sequence if it has fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and blanks only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter((_words[w] for w in words), np.uint64, len(words))
    n = min(size, len(words))
    mixed = np.full(len(h) - n + 1, len(words) if len(words) < size else size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            mixed = (mixed ^ h[k : k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of universal hashes on 32 bits; the same in every task."""
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1)
    return a[:, None], rng.integers(0, 2**32, count, dtype=np.uint32)[:, None]


def least_hashes(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    step = max(1, PRODUCTS // len(a))  # bounded memory for long texts
    for k in range(0, len(x), step):
        np.minimum(low, (x[None, k : k + step] * a + b).min(axis=1), out=low)
    return low


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (least_hashes(shingles, a, b) & np.uint32(0xFFFF)).astype("<u2")


def fine_sketch(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """Two bits of each minimum, first one of all, then the other.

    The low bits of a product tell only the low bits of its factors, so the minima are mixed before.
    """
    low = least_hashes(shingles, a, b)
    with np.errstate(over="ignore"):
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            low = (low ^ (low >> np.uint32(shift))) * np.uint32(factor)
    return np.packbits(np.stack([low >> np.uint32(31), (low >> np.uint32(30)) & np.uint32(1)]).astype(np.uint8)).tobytes()


def agreeing(sketches: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Minima in which each of the fine ``sketches`` (rows of 64-bit words) agrees with the ``other`` one in both bits."""
    half = sketches.shape[1] // 2
    differ = sketches ^ other
    return half * 64 - np.bitwise_count(differ[:, :half] | differ[:, half:]).sum(axis=1, dtype=np.int64)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS_AT_A_TIME):
            yield batch.slice(k, ROWS_AT_A_TIME)
    _words.clear()


def sketches(docs: DataFrame, size: int, hashes: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = hash_functions(hashes)
        for batch in sliced(batches):
            n, keys, rows = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), size)
                n.append(len(s))
                keys.append(hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest())
                rows.append(minima(s, a, b).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(rows, pa.binary())],
                ["doc_id", "n_shingles", "set_key", "sketch"],
            )

    schema = "doc_id long, n_shingles long, set_key binary, sketch binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(run), schema)


def least_agreeing(count: int, percent: int, width: int) -> int:
    """Agreeing minima under which a sketch of ``count`` minima of ``width`` bits rules a pair out."""
    p = percent / 100
    p += (1 - p) / (1 << width)  # minima that differ still agree in their bits now and then
    return int(count * p - DEVIATIONS * (count * p * (1 - p)) ** 0.5)


def chosen_texts(docs: DataFrame, nodes: DataFrame, make: Callable[[str | None], bytes], tables: Scratch, name: str) -> DataFrame:
    """The written (node, made): ``make(text)`` of the documents whose id is among ``nodes`` (doc_id).

    The ids are written first, so Spark knows their size: texts stay where they are while the ids are small.
    """
    ids = tables.save(nodes.select("doc_id").distinct(), f"{name}-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [make(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["node", "made"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    return tables.save(texts.mapInArrow(giving_back(run), "node long, made binary"), name)


def confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (a, b, sa, sb) with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keep = []
            for sa, sb in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), "<u8") for s in (sa, sb))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(giving_back(run), "a long, b long")


def verified(docs: DataFrame, pairs: DataFrame, size: int, percent: int, tables: Scratch, name: str) -> DataFrame:
    """The written (a, b) of ``pairs`` that are near on their full sets."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    sets = chosen_texts(docs, nodes, lambda t: shingle_set(t, size).astype("<u8").tobytes(), tables, f"{name}-sets")
    left = sets.withColumnsRenamed({"node": "a", "made": "sa"})
    right = sets.withColumnsRenamed({"node": "b", "made": "sb"})
    return tables.save(confirmed(pairs.join(left, "a").join(right, "b"), percent).distinct(), f"{name}-links")


def bucket_pairs(members: DataFrame, least: int, percent: int) -> DataFrame:
    """(a, b) to verify from members (bucket, lo, hi, own, node, component, n, sketch, fine), grouped by bucket, lo, hi."""

    def compare(rows: dict[str, np.ndarray], out: list[np.ndarray]) -> None:
        node, part, n, own, sketch, fine = (rows[k] for k in ("node", "component", "n", "own", "sketch", "fine"))
        words = sketch.view("<u8")  # a band is eight bytes
        band = rows["bucket"][0] & 63
        crossing = rows["lo"][0] != rows["hi"][0]
        for i in range(len(node) - 1):
            ok = (part[i + 1 :] != part[i]) & (node[i + 1 :] != node[i])
            ok &= 100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i])
            if crossing:
                ok &= own[i + 1 :] != own[i]
            j = np.flatnonzero(ok) + i + 1
            if len(j):
                j = j[(words[j] == words[i]).argmax(axis=1) == band]
            if len(j):
                j = j[agreeing(fine[j], fine[i]) >= least]
            if len(j):
                out.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("bucket", "lo", "hi", "own", "node", "component", "n")
        held: dict[str, np.ndarray] = {}

        def groups(rows: dict[str, np.ndarray], last: bool) -> tuple[list[np.ndarray], dict[str, np.ndarray]]:
            keys = np.stack([rows["bucket"], rows["lo"], rows["hi"]])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            edges = [0, *cuts.tolist(), keys.shape[1]]
            out: list[np.ndarray] = []
            done = len(edges) - 1 if last else len(edges) - 2
            for s, e in zip(edges[:done], edges[1 : done + 1], strict=True):
                if e - s > 1:
                    compare({k: v[s:e] for k, v in rows.items()}, out)
            return out, {k: v[edges[done] :] for k, v in rows.items()} if not last else {}

        def batch_of(out: list[np.ndarray]) -> pa.RecordBatch:
            pairs = np.concatenate(out, axis=1) if out else np.empty((2, 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            for k, kind in (("sketch", "<u2"), ("fine", "<u8")):
                rows[k] = np.frombuffer(b"".join(batch.column(k).to_pylist()), kind).reshape(batch.num_rows, -1)
            if held:
                rows = {k: np.concatenate([held[k], v]) for k, v in rows.items()}
            out, held = groups(rows, last=False)
            yield batch_of(out)
        if held:
            yield batch_of(groups(held, last=True)[0])

    return members.mapInArrow(giving_back(run), "a long, b long")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, percent: int = 85, size: int = 3, bands: int = BANDS
) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their
    sets of ``size``-word shingles (words between ASCII blanks, A-Z
    lower-cased). Texts without words, null ones too, are linked with nothing.
    Rows that share a doc_id count as linked. A row without doc_id is linked
    with nothing, has no component, and is kept.
    """
    tables = scratch(spark)
    rows = tables.save(sketches(docs, size, bands * ROWS), "sketches")
    linkable = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("set_key").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = tables.save(classes, "classes")

    width = 2 * ROWS
    keys = [
        F.xxhash64(F.substring("sketch", width * b + 1, width)).bitwiseAND(F.lit(-64)).bitwiseOR(F.lit(b)) for b in range(bands)
    ]
    banded = classes.select("node", F.explode(F.array(*keys)).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = tables.save(banded.join(tables.save(shared, "buckets"), "bucket"), "members")

    order = F.struct(F.xxhash64("node", "bucket"), F.col("node").alias("node"))
    pivots = members.groupBy("bucket").agg(F.min(order)["node"].alias("pivot"))
    stars = members.join(pivots, "bucket").where("node <> pivot")
    stars = stars.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    near = verified(docs, tables.save(stars, "stars"), size, percent, tables, "star")
    repeated = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
    repeated = linkable.join(repeated, "doc_id", "left_semi").select("doc_id", "set_key").distinct()
    repeated = repeated.join(classes.select("set_key", "node"), "set_key").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    first = tables.save(connected_components(near.union(repeated), tables, "first"), "first")

    placed = members.where("size > 2").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = placed.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2")
    placed = tables.save(placed.join(split.select("bucket"), "bucket", "left_semi"), "placed")
    release_shuffles(spark)  # of the steps above, before the largest one
    a, b = hash_functions(FINE)
    fine = chosen_texts(
        docs,
        placed.select(F.col("node").alias("doc_id")),
        lambda t: fine_sketch(shingle_set(t, size), a, b),
        tables,
        "fine",
    ).withColumnRenamed("made", "fine")
    known = classes.select("node", "n", "sketch").join(fine, "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).join(known, "node")
    lo, hi = F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    placed = placed.select("bucket", lo, hi, "own", "node", "component", "n", "sketch", "fine")
    grouped = placed.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    rest = tables.save(bucket_pairs(grouped, least_agreeing(FINE, percent, 2), percent).distinct(), "rest")
    late = verified(docs, rest, size, percent, tables, "rest")

    # the rest links whole components of the first round
    names = first.withColumnsRenamed({"node": "a", "component": "ca"})
    late = late.join(names, "a", "left").withColumn("a", F.coalesce("ca", "a")).select("a", "b")
    names = first.withColumnsRenamed({"node": "b", "component": "cb"})
    late = late.join(names, "b", "left").withColumn("b", F.coalesce("cb", "b")).select("a", "b")
    second = connected_components(late, tables, "second").withColumnsRenamed({"node": "first", "component": "second"})
    final = first.withColumnsRenamed({"component": "first"}).join(second, "first", "full")
    final = final.select(F.coalesce("node", "first").alias("node"), F.coalesce("second", "first").alias("component"))
    # a component of the first round is itself one of its nodes; classes alone are their own component
    named = classes.join(final.distinct(), "node", "left").select("set_key", F.coalesce("component", "node").alias("component_id"))
    named = tables.save(named, "named")
    own = rows.withColumn("set_key", F.when(F.col("n_shingles") > 0, F.col("set_key")))
    found = join_rows(own, named, ["set_key"])
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(spark: SparkSession, docs: DataFrame, percent: int = 85, size: int = 3) -> DataFrame:
    """One document of each component, with all its columns.

    Of the rows that share a doc_id, which count as linked, the one with the least hash of its text stays. Rows without
    doc_id are compared like others, under ids above all given ones (or below them, if they leave no room), and keep
    their null. Only where ids fill the whole range, both below -2^62 and above 2^62, are they linked with nothing.
    """
    tables = scratch(spark)
    uses = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    odd = tables.save(uses.select("doc_id"), "odd")
    unnamed = fresh("unnamed")
    rows = docs.withColumn(unnamed, F.lit(False))
    compared = rows
    if not odd.isEmpty():
        plain = join_rows(rows, counted_broadcast(odd), ["doc_id"], "left_anti")
        again = rows.join(odd.where("doc_id IS NOT NULL"), "doc_id", "left_semi").select(*rows.columns)
        least = F.min_by(F.struct(*rows.columns), F.xxhash64("text")).alias("row")
        named = again.groupBy(F.col("doc_id").alias(fresh("id"))).agg(least).select("row.*")
        low, high = (x or 0 for x in docs.agg(F.min(F.col("doc_id").cast("long")), F.max(F.col("doc_id").cast("long"))).first())
        place = F.monotonically_increasing_id()
        free = F.lit(high + 1) + place if high < 1 << 62 else F.lit(low - 1) - place if low > -(1 << 62) else F.lit(None)
        null_id = free.cast("long").alias("doc_id")
        others = [F.lit(True).alias(c) if c == unnamed else F.col(c) for c in rows.columns if c != "doc_id"]
        nulls = tables.save(rows.where("doc_id IS NULL").select(null_id, *others), "unnamed")
        others = plain.unionByName(nulls.select(*rows.columns))
        compared, rows = others.unionByName(again), others.unionByName(named)
    dropped = near_duplicates(spark, compared, percent, size).where("NOT kept").select("doc_id").distinct()
    dropped = counted_broadcast(tables.save(dropped, "dropped"))
    kept = rows.join(dropped, "doc_id", "left_anti")
    kind = docs.schema["doc_id"].dataType
    return kept.withColumn("doc_id", F.when(~F.col(unnamed), F.col("doc_id")).cast(kind)).select(*docs.columns)
