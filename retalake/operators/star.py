"""Star schema: seven dimensions and the sales fact."""

from __future__ import annotations

from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from retalake.operators.keys import dense_id, hash_id, hashed_keys
from retalake.schemas import (
    DIMENSIONS,
    FACT,
    FACT_TABLE,
    GOLD,
    KEYS,
    LOAD,
    STAGING_TABLE,
    STAR_TABLE,
    VERSION_COLUMN,
    VERSIONS,
    Dimension,
)
from retalake.session import Scratch, adaptive, release_shuffles, together
from retalake.sources.warehouse import create_table, last_load

# Natural key columns that the literal lookups leave out.
_LEGACY_UNMATCHED = {
    "dim_cliente": ("email", "dominio_email", "telefone"),
    "dim_desconto": ("desconto_oferecido",),
}

#: Hashed keys of a dimension that Spark may broadcast; more are merged.
BROADCAST_KEYS = 1_000_000


def build_dim(sales: DataFrame, dim: Dimension, scratch: Scratch) -> DataFrame:
    """Distinct natural keys of the sales, numbered from 0 in key order."""
    return dense_id(sales.select(*dim.key).distinct(), dim.id, scratch, order=dim.key)


def written_dims(sales: DataFrame, scratch: Scratch) -> dict[str, DataFrame]:
    """All dimensions, written to the scratch folder."""

    def write(dim: Dimension) -> DataFrame:
        return scratch.save(build_dim(sales, dim, scratch), dim.table)

    rows = together(sales.sparkSession, [partial(write, dim) for dim in DIMENSIONS])
    return {dim.table: df for dim, df in zip(DIMENSIONS, rows)}


def _lookup(sales: DataFrame, rows: DataFrame, dim: Dimension, legacy_keys: bool) -> DataFrame:
    """Swap the natural key of one dimension for its id.

    The join type is left to Spark: it broadcasts a dimension only while its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold``, else it
    sorts and merges, and splits partitions that a hot key has made too big.
    """
    theirs = {c: f"_{c}" for c in dim.key}
    rows = rows.select(dim.id, *(F.col(c).alias(theirs[c]) for c in dim.key))
    matched = dim.key
    if legacy_keys:
        matched = tuple(c for c in dim.key if c not in _LEGACY_UNMATCHED.get(dim.table, ()))

    def same(c: str) -> Column:
        mine, other = F.col(c), F.col(theirs[c])
        return mine == other if legacy_keys else mine.eqNullSafe(other)

    condition = same(matched[0])
    for c in matched[1:]:
        condition = condition & same(c)
    return sales.join(rows, condition).drop(*theirs.values())


def _hashed_lookup(sales: DataFrame, rows: DataFrame, dim: Dimension) -> DataFrame | None:
    """Swap a natural key for its id by the key's hash; None where two keys of the dimension share one.

    The key's texts stay where the sales are, so what is shuffled is numbers. Right only if every key of the sales is
    in the dimension. One job over the written dimension tells whether hashes are unique and how many rows it has:
    hashes make them so small that Spark would take millions of them for a broadcast.
    """
    rows = rows.select(dim.id, hash_id(dim.key).alias("_hash"))
    found = rows.agg(F.count("*").alias("keys"), F.count_distinct("_hash").alias("hashes")).first()
    if found["keys"] != found["hashes"]:
        return None
    rows = rows.hint("merge" if found["keys"] > BROADCAST_KEYS else "broadcast")
    return sales.withColumn("_hash", hash_id(dim.key)).drop(*dim.key).join(rows, "_hash").drop("_hash")


def build_fact(
    sales: DataFrame,
    dims: dict[str, DataFrame],
    legacy_keys: bool = False,
    dense: Scratch | None = None,
    complete: bool = False,
) -> DataFrame:
    """Sales with dimension ids, one row per sale.

    Whole natural keys are compared and NULL equals NULL, so no sale is lost
    or multiplied. ``legacy_keys`` gives the literal lookups instead: customer
    by name alone (sales without e-mail drop out), discount by code alone, and
    NULL keys match nothing.

    ``venda_id`` is unique, with gaps, and is fixed once the fact is written.
    Pass a scratch folder as ``dense`` to number the sales without gaps; this
    writes the fact one more time.

    ``complete`` says that ``dims`` are written and hold every key of these sales, as those do that were built from
    them. A key of several texts is then looked up by its hash, unless two of the dimension's keys share one.
    """
    dims_in_order = DIMENSIONS
    if legacy_keys:
        sales = sales.where(F.col("email").isNotNull())
        # lookups that multiply sales come last, the largest dimension first: what it shuffles is not multiplied yet
        multiplying = [d for d in DIMENSIONS if d.table in _LEGACY_UNMATCHED]
        dims_in_order = [d for d in DIMENSIONS if d not in multiplying] + multiplying[::-1]
    for dim in dims_in_order:
        texts = all(isinstance(GOLD[c].dataType, StringType) for c in dim.key)
        by_hash = complete and not legacy_keys and texts and len(dim.key) > 1
        found = _hashed_lookup(sales, dims[dim.table], dim) if by_hash else None
        sales = _lookup(sales, dims[dim.table], dim, legacy_keys) if found is None else found
    fact = sales.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT if f.name != "venda_id")
    )
    if dense:
        return dense_id(fact, "venda_id", dense)
    return fact.select(F.monotonically_increasing_id().alias("venda_id"), "*")


def create_star(spark: SparkSession, database: str) -> None:
    """Create the views of the star, and the tables with all its versions behind them, where they are not there.

    A view shows the rows of the last version that is complete, which one row of the table of versions decides for
    all of them at once. The table of a dimension's keys holds every natural key that ever had an id.
    """
    layout = f"PARTITIONED BY ({VERSION_COLUMN})"
    versions = f"{database}.{STAR_TABLE}"
    create_table(spark, versions, _versioned(StructType().add(LOAD, LongType())), layout)
    tables = {d.table: d.schema for d in DIMENSIONS} | {FACT_TABLE: FACT}
    for d in DIMENSIONS:
        create_table(spark, f"{database}.{d.table}{KEYS}", _versioned(d.schema), layout)
    for name, schema in tables.items():
        create_table(spark, f"{database}.{name}{VERSIONS}", _versioned(schema), layout)
        spark.sql(
            f"""CREATE VIEW IF NOT EXISTS {database}.{name} AS
            SELECT {", ".join(schema.names)} FROM {database}.{name}{VERSIONS}
            WHERE {VERSION_COLUMN} = (SELECT max({VERSION_COLUMN}) FROM {versions})"""
        )


def _versioned(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add(VERSION_COLUMN, LongType())


def drop_star(spark: SparkSession, database: str) -> None:
    """Drop the fact, then the dimensions it refers to, with all versions and ids."""
    for name in [FACT_TABLE, *(d.table for d in DIMENSIONS)]:
        spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
        for ending in (VERSIONS, KEYS):
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}{ending}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{STAR_TABLE}")


def last_version(spark: SparkSession, database: str) -> tuple[int, int]:
    """Number of the last complete version of the star and of the load that it was built from; zeros before the first."""
    if not spark.catalog.tableExists(f"{database}.{STAR_TABLE}"):
        return 0, 0
    last = F.max(F.struct(VERSION_COLUMN, LOAD)).alias("last")
    return tuple(spark.table(f"{database}.{STAR_TABLE}").agg(last).first()["last"] or (0, 0))


def numbered_keys(keys: DataFrame, known: DataFrame, dim: Dimension, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(new keys with their ids, all ``keys`` with theirs); a key that ``known`` has keeps its id.

    New keys are numbered in key order from the largest id on.
    """
    theirs = {c: f"_{c}" for c in dim.key}
    known = known.select(dim.id, *(F.col(c).alias(theirs[c]) for c in dim.key))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(t)) for c, t in theirs.items()))
    first = known.agg(F.max(dim.id)).first()[0]
    fresh = dense_id(keys.join(known, same, "left_anti"), dim.id, scratch, order=dim.key)
    fresh = scratch.save(fresh.withColumn(dim.id, F.col(dim.id) + (0 if first is None else first + 1)), f"{dim.table}-new")
    kept = keys.join(known, same).select(dim.id, *dim.key)
    return fresh, kept.union(fresh.select(dim.id, *dim.key))


def hashed_star(sales: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(fact, written dimensions) by hash ids of the natural keys, for dimensions too large to look up.

    A sale's ids come from its own columns, so the fact is a projection: no join, no shuffle, however many rows a
    key has. That an id stands for one key is checked on each dimension before. Ids are not dense, and need no table
    to stay the same from one rebuild to the next.
    """
    dims = {d.table: hashed_keys(sales.select(*d.key).distinct(), d.id, scratch) for d in DIMENSIONS}
    fact = sales.withColumns({d.id: hash_id(d.key) for d in DIMENSIONS})
    columns = (F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT if f.name != "venda_id")
    return fact.select(F.monotonically_increasing_id().alias("venda_id"), *columns), dims


def rebuild_star(spark: SparkSession, database: str, legacy_keys: bool = False) -> int:
    """Build a new version of all dimensions and the fact from the staging table, and return its number.

    Readers see the version before until the last statement, and go on seeing it when a rebuild fails; the next
    attempt overwrites what that one has left. A natural key keeps its id from version to version, also when it is
    absent for a while. The fact is planned over the written dimensions: their keys are final and their sizes known.
    The version before stays for readers that have begun; older ones are removed. One rebuild at a time.
    """
    sales = spark.table(f"{database}.{STAGING_TABLE}")
    create_star(spark, database)
    load = last_load(spark, database)
    before, _ = last_version(spark, database)
    version = before + 1

    def insert(rows: DataFrame, table: str) -> None:
        names = [c for c in spark.table(f"{database}.{table}").columns if c != VERSION_COLUMN]
        spark.sql(
            f"INSERT OVERWRITE TABLE {database}.{table} PARTITION ({VERSION_COLUMN} = {version}) SELECT {', '.join(names)} FROM {{rows}}",
            rows=rows,
        )

    def written(table: str) -> DataFrame:
        return spark.table(f"{database}.{table}{VERSIONS}").where(F.col(VERSION_COLUMN) == version).drop(VERSION_COLUMN)

    with Scratch(spark) as scratch, adaptive(spark):

        def fill(dim: Dimension) -> None:
            known = spark.table(f"{database}.{dim.table}{KEYS}").where(F.col(VERSION_COLUMN) < version)
            keys = scratch.save(sales.select(*dim.key).distinct(), f"{dim.table}-keys")
            fresh, every = numbered_keys(keys, known, dim, scratch)
            insert(fresh, f"{dim.table}{KEYS}")
            insert(every, f"{dim.table}{VERSIONS}")

        together(spark, [partial(fill, dim) for dim in DIMENSIONS])
        dims = {d.table: written(d.table) for d in DIMENSIONS}
        release_shuffles(spark)
        insert(build_fact(sales, dims, legacy_keys, None, True), f"{FACT_TABLE}{VERSIONS}")
    insert(spark.range(1).select(F.lit(load).cast("long").alias(LOAD)), STAR_TABLE)
    for name in [FACT_TABLE, *(d.table for d in DIMENSIONS)]:
        spark.sql(f"ALTER TABLE {database}.{name}{VERSIONS} DROP IF EXISTS PARTITION ({VERSION_COLUMN} = {version - 2})")
    release_shuffles(spark)
    return version


def year_as_text(fact: DataFrame) -> DataFrame:
    """Fact with the year as text of four characters, for warehouses that declare it so."""
    return fact.withColumn("ano", F.col("ano").cast("string"))
