"""Exact duplicates by a persistent index of digests.

The index is a table with one row per distinct text: its digest and the row that stays. It is bucketed and sorted by
the digest, so that new data is compared with it by a sort-merge anti-join which moves only the digests of the new
data: the index is read bucket by bucket, where it lies. What the join leaves is appended as one partition, named by
the batch. A batch that runs again, after a failure say, replaces its own partition and gets the same verdicts.

Rows of one batch are first reduced to one per digest inside each task, so a text with very many copies is a row per
task in the shuffle; verdicts return to the rows by :func:`retalake.llm.common.grouped_rows`.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm.common import BLANK_CLASS, counted_broadcast, fresh, grouped_rows, join_rows, scratch
from retalake.session import Scratch, remove_folder

#: Distinct texts that one bucket is meant to hold: some 50 MB of digests and ids.
BUCKET_ROWS = 1_000_000


def normalised(text: Column) -> Column:
    """Each run of ASCII blanks as one space; null as the empty text. Nothing is trimmed or lower-cased."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{BLANK_CLASS}+", " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """Index of all texts seen so far, kept in the catalog table ``name`` with its files under ``path``.

    ``expected_rows`` distinct texts fix the number of buckets when the table is made; an existing table keeps its own.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, expected_rows: int) -> None:
        self.spark, self.name, self.path = spark, name, path
        if not spark.catalog.tableExists(name):
            buckets = max(8, -(-expected_rows // BUCKET_ROWS))
            spark.sql(
                f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT, place BIGINT, batch STRING) USING parquet "
                f"PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        self.buckets = int(described["Num Buckets"])

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unknown(self, groups: DataFrame, batch: str) -> DataFrame:
        """The groups whose digest no other batch has brought in: sort-merge anti-join, the index is not shuffled."""
        known = self.rows().where(F.col("batch") != batch).select("digest")
        return groups.repartition(self.buckets, "digest").join(known.hint("merge"), "digest", "left_anti")

    def append(self, new: DataFrame, batch: str) -> None:
        """Add a batch. A task holds a bucket and writes it sorted."""
        self.forget(batch)
        self.spark.sql(
            f"INSERT INTO TABLE {self.name} PARTITION (batch = '{batch}') SELECT digest, keep_id, place FROM {{new}}", new=new
        )

    def forget(self, batch: str) -> None:
        """Remove a batch, also what a run that broke off has left of it."""
        if not re.fullmatch("[A-Za-z0-9_-]+", batch):
            raise ValueError("a batch is named by letters, digits, _ and -")
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (batch = '{batch}')")
        remove_folder(self.spark, f"{self.path}/batch={batch}")

    def drop(self) -> None:
        """Take the table out of the catalog. Its files stay."""
        self.spark.sql(f"DROP TABLE {self.name}")


def deduplicated(docs: DataFrame, index: DigestIndex, batch: str, tables: Scratch) -> DataFrame:
    """A written row per document of a new batch, which the index holds afterwards.

    doc_id, keep_id (id of the row that stays), group_size (rows of this batch with that text), kept, text_sha256.
    Texts are equal when their normalised forms are; null counts as empty. A text that an earlier batch brought in
    stays with the row named then, whatever the new ids are. Within the batch the row with the smallest doc_id
    stays; of rows that share text and doc_id exactly one; a null doc_id only if the text has no other. An empty
    batch gives no rows. Other columns are not looked at.
    """
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))
    rows = tables.save(hashed.withColumn("place", F.monotonically_increasing_id()), "rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "place"))
    groups = rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size"))
    groups = groups.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.place").alias("place"), "group_size")
    groups = tables.save(groups, "groups")

    index.append(index.unknown(groups, batch), batch)
    named = index.rows().select("digest", "keep_id", F.when(F.col("batch") == batch, F.col("place")).alias("stays"))
    sizes = groups.select("digest", "group_size").repartition(index.buckets, "digest")
    verdicts = tables.save(sizes.join(named.hint("merge"), "digest"), "verdicts")
    found = grouped_rows(rows, verdicts, "digest", "group_size", rows.count())
    return tables.save(
        found.select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("place") == F.col("stays"), F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        ),
        "result",
    )


def kept_documents(docs: DataFrame, verdicts: DataFrame, tables: Scratch) -> DataFrame:
    """The documents that stay by the written ``verdicts`` of :func:`deduplicated`, with all their columns.

    Texts are not moved, but for rows that share text and doc_id, of which one stays.
    """
    key = fresh("digest")
    stays = verdicts.where("kept").select("doc_id", F.unhex("text_sha256").alias(key))
    several = verdicts.groupBy("doc_id", F.unhex("text_sha256").alias(key)).agg(F.count("*").alias("n")).where("n > 1")
    several = counted_broadcast(tables.save(several.select("doc_id", key), "several"))
    kept = join_rows(docs.withColumn(key, digest(F.col("text"))), stays, ["doc_id", key], "left_semi")
    one = join_rows(kept, several, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key])
    return join_rows(kept, several, ["doc_id", key], "left_anti").unionByName(one).select(*docs.columns)


def deduplicated_once(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """:func:`deduplicated` against an index of its own that starts empty and leaves the catalog at the end."""
    tables = scratch(spark)
    index = DigestIndex(spark, f"digests_{uuid.uuid4().hex}", tables.path("index"), docs.count())
    try:
        return deduplicated(docs, index, "all", tables)
    finally:
        index.drop()
