"""Column expressions and small helpers that several operators share."""

from __future__ import annotations

import ctypes
import string
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.session import Scratch

#: White space that separates words, as characters and as a class of a regular expression.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = "[ \\t-\\r]"

#: A table of at most so many rows, counted first, may be broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file, which is installed wherever the library runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


def scratch(spark: SparkSession) -> Scratch:
    """Written intermediate tables of one call; their readers outlive the call, so nothing removes them here."""
    return Scratch(spark)


def counted_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a written table that has at most ``most`` rows; a larger one is left to a shuffled join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def giving_back(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; when it ends, the memory that it has freed goes back to the system.

    A Python worker outlives its task. Without this it keeps what the largest task took while later stages, and later
    operators, run beside it.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)

    return task


def fresh(name: str) -> str:
    """Column name that no column of the caller can clash with."""
    return f"__{name}_{uuid.uuid4().hex[:12]}"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else left. Pure ASCII takes the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def split_words(text: Column, gap: str) -> Column:
    """Parts of the text between runs of the class ``gap``; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{gap}+"), "")


def training_row(doc_id: Column, modulus: int, held_out: int) -> Column:
    """False for rows whose crc32 of the id as text leaves the held-out remainder. A null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus != held_out


def join_rows(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys``, null equal to null; the right side's keys are dropped."""
    names = {k: fresh(k) for k in keys}
    same = F.lit(True)
    for k, own in names.items():
        same = same & F.col(k).eqNullSafe(F.col(own))
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())


#: A key that holds more than one in so many rows is hot, so there are at most so many hot keys.
HOT_SHARE = 1000


def grouped_rows(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """Rows joined with the written ``groups``, which has one row per ``key`` and the rows of that key in ``size``.

    Keys with more than a thousandth of all ``total`` rows are fewer than ``HOT_SHARE`` by arithmetic and are
    broadcast, so a group of a third of all rows stays where its rows are. The rest is left to a shuffled join.
    ``how`` is inner or left.
    """
    is_hot = F.col(size) * HOT_SHARE > total
    hot = F.broadcast(groups.where(is_hot))
    rest = rows.join(F.broadcast(groups.where(is_hot).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(groups.where(~is_hot), key, how))
