"""Checks and profiles. Each one is a small DataFrame, computed in one pass where possible."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.operators.silver import typed
from retalake.schemas import DIMENSIONS, FACT_TABLE, SILVER_EXACT, SILVER_SOURCE, SOURCE, STAGING_TABLE


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("registros"))


def group_count(df: DataFrame, column: str = SOURCE) -> DataFrame:
    """Rows per value; a NULL value counts 0 because its values are counted, not its rows."""
    return df.groupBy(column).agg(F.count(column).alias("registros"))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias("distintos"))


def key_check(df: DataFrame, key: str) -> DataFrame:
    """Row count next to the distinct count of the primary key, and whether they agree."""
    counts = df.agg(F.count("*").alias("registros"), F.countDistinct(key).alias("distintos"))
    return counts.withColumn("unica", F.col("registros") == F.col("distintos"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of the child whose key the parent lacks, as one count.

    The child is counted per key before the join, so a key with very many
    rows is one row there. A NULL key refers to nothing and is no orphan.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    per_key = keys.agg(F.count("*").alias("_rows"))
    known = parent.select(F.col(parent_key).alias("_known"))
    missing = per_key.join(known, F.col("_key") == F.col("_known"), "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("orfaos"))


def reference_check(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Orphans of the fact per dimension key, in one scan of the fact.

    The keys of a sale become rows, which every task counts per dimension and id before anything is shuffled; the
    counts then meet the ids of all dimensions in one join.
    """
    names = [d.id for d in DIMENSIONS]
    keys = fact.select([F.col(n).cast("long").alias(n) for n in names]).unpivot([], names, "coluna", "_key")
    counted = keys.where("_key IS NOT NULL").groupBy("coluna", "_key").agg(F.count("*").alias("_rows"))
    known = reduce(
        DataFrame.unionByName,
        (dims[d.table].select(F.lit(d.id).alias("_column"), F.col(d.id).cast("long").alias("_known")) for d in DIMENSIONS),
    )
    same = (F.col("coluna") == F.col("_column")) & (F.col("_key") == F.col("_known"))
    missing = counted.join(known, same, "left_anti").groupBy("coluna").agg(F.sum("_rows").alias("_missing"))
    every = fact.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("coluna"))
    orphaned = F.coalesce("_missing", F.lit(0)).cast("long").alias("orfaos")
    return every.join(missing, "coluna", "left").select("coluna", orphaned)


def _one_row_per_column(df: DataFrame, measure: str, columns: list[str]) -> DataFrame:
    """Turn a one-row frame with a count per column into one row per column."""
    return df.unpivot([], [F.col(f"`{c}`") for c in columns], "coluna", measure)


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, counted in one scan."""
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    return _one_row_per_column(df.agg(*counts), "nulos", df.columns)


def cast_losses(bronze: DataFrame) -> DataFrame:
    """Texts per source and column that the silver types cannot hold, in one scan.

    ``Valor Exato`` counts texts that are no exact money, some of which the float column still takes.
    """
    texts = {SILVER_EXACT: "Valor da Compra", **{c: c for c in ("Timestamp do Registro", "Valor da Compra", "Desconto Oferecido")}}
    before = {c: F.col(f"`{t}`").isNotNull().alias(f"_{k}") for k, (c, t) in enumerate(texts.items())}
    both = typed(bronze.select("*", *before.values()))
    lost = [F.count_if(F.col(f"_{k}") & F.col(f"`{c}`").isNull()).alias(c) for k, c in enumerate(texts)]
    counted = both.groupBy(F.col(f"`{SILVER_SOURCE}`").alias(SOURCE)).agg(*lost)
    return counted.unpivot([SOURCE], [F.col(f"`{c}`") for c in texts], "coluna", "perdidos")


def schema_profile(df: DataFrame) -> DataFrame:
    """Type and number of filled values per column."""
    counts = [F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    filled = _one_row_per_column(df.agg(*counts), "preenchidos", df.columns)
    kind = F
    for field in df.schema:
        kind = kind.when(F.col("coluna") == field.name, field.dataType.simpleString())
    return filled.select("coluna", kind.alias("tipo"), "preenchidos")


def _counted(df: DataFrame) -> DataFrame:
    """Distinct rows with how often they occur. Copies are added up before the shuffle."""
    return df.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count("*").alias("vezes"))


def copies(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with how often."""
    return _counted(df).where(F.col("vezes") > 1)


def duplicates_report(df: DataFrame, source: str = SILVER_SOURCE) -> DataFrame:
    """Total, surplus and unique rows per source."""
    return (
        _counted(df)
        .groupBy(F.col(f"`{source}`").alias(SOURCE))
        .agg(
            F.sum("vezes").alias("total"),
            F.sum(F.col("vezes") - 1).alias("duplicados"),
            F.count("*").alias("unicos"),
        )
    )


def reconcile_layers(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per source in every layer, and whether nothing but duplicates got lost.

    ``layers`` maps the names ``bronze``, ``silver``, ``gold`` and optionally
    ``fato`` to frames, in this order; a source missing from a layer counts 0 there.
    """
    parts = []
    for name, df in layers.items():
        source = SILVER_SOURCE if SILVER_SOURCE in df.columns else SOURCE
        parts.append(df.select(F.col(f"`{source}`").alias(SOURCE), F.lit(name).alias("_layer")))
    rows = reduce(DataFrame.unionByName, parts)
    counts = [F.count_if(F.col("_layer") == name).alias(name) for name in layers]
    return _reconciled(rows.groupBy(SOURCE).agg(*counts), list(layers))


def reconcile_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """:func:`reconcile_layers` from frames of (source, rows) that are counted already."""
    parts = [df.toDF(SOURCE, "_rows").withColumn("_layer", F.lit(name)) for name, df in layers.items()]
    rows = reduce(DataFrame.unionByName, parts)
    counts = [F.sum(F.when(F.col("_layer") == name, F.col("_rows")).otherwise(0)).alias(name) for name in layers]
    return _reconciled(rows.groupBy(SOURCE).agg(*counts), list(layers))


def _reconciled(result: DataFrame, layers: list[str]) -> DataFrame:
    after_bronze = [F.col(name) for name in layers[1:]]
    agree = reduce(
        lambda a, b: a & b, (c == after_bronze[0] for c in after_bronze[1:]), F.lit(True)
    )
    return result.withColumn("duplicados", F.col("bronze") - after_bronze[0]).withColumn(
        "confere", agree & (after_bronze[0] <= F.col("bronze"))
    )


def sample(df: DataFrame, rows: int = 5) -> DataFrame:
    """Any few rows, for a look at the table."""
    return df.limit(rows)


def star_report(spark: SparkSession, database: str) -> DataFrame:
    """verificacao, valor, esperado, confere: unique keys, references, and the fact's rows against the staging table."""
    fact, staging = spark.table(f"{database}.{FACT_TABLE}"), spark.table(f"{database}.{STAGING_TABLE}")
    dims = {d.table: spark.table(f"{database}.{d.table}") for d in DIMENSIONS}

    def named(df: DataFrame, name: str, value: str, expected: str) -> DataFrame:
        return df.select(F.lit(name).alias("verificacao"), F.col(value).alias("valor"), F.col(expected).alias("esperado"))

    rows = row_count(fact).crossJoin(row_count(staging).withColumnRenamed("registros", "staging"))  # one row each
    parts = [named(rows, "vendas", "registros", "staging")]
    parts.append(named(key_check(fact, "venda_id"), f"chave {FACT_TABLE}", "distintos", "registros"))
    for d in DIMENSIONS:
        parts.append(named(key_check(dims[d.table], d.id), f"chave {d.table}", "distintos", "registros"))
    references = reference_check(fact, dims).withColumn("coluna", F.concat(F.lit("referencia "), "coluna"))
    parts.append(references.select(F.col("coluna").alias("verificacao"), F.col("orfaos").alias("valor"), F.lit(0).cast("long").alias("esperado")))
    return reduce(DataFrame.unionByName, parts).withColumn("confere", F.col("valor") == F.col("esperado"))
