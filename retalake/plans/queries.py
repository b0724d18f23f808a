"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from retalake.functions.columns import day_part, ingest_stamp, source_name, without_extension
from retalake.operators import checks
from retalake.operators.gold import to_gold
from retalake.operators.keys import dense_id
from retalake.operators.silver import across_files, deduplicated, defaults_filled, to_silver, typed, with_year
from retalake.operators.star import (
    build_dim,
    build_fact,
    drop_star,
    hashed_star,
    rebuild_star,
    written_dims,
    year_as_text,
)
from retalake.plans.jobs import Lake, reconcile_lake, run_batch
from retalake.plans.sales import raw_sales, table
from retalake.schemas import (
    BRONZE_COLUMNS,
    DIMENSIONS,
    FACT_TABLE,
    GOLD,
    SILVER_SOURCE,
    SOURCE,
    STAGING_TABLE,
    YEAR,
    Dimension,
)
from retalake.session import Scratch, session_conf, shuffles_dropped
from retalake.sources.landing import MALFORMED, malformed, read_bronze, read_lines
from retalake.sources.layers import read_gold, read_silver, write_gold, write_silver
from retalake.sources.warehouse import load_warehouse, truncate_staging
from retalake.streaming.ingest import run_stream

Query = Callable[[SparkSession, str], DataFrame]


def _shown(df: DataFrame) -> DataFrame:
    """Decimals as text, so that every digit is compared."""
    exact = [f.name for f in df.schema if isinstance(f.dataType, DecimalType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in exact})


#: Size of a task's share of written sales: their texts take ten times the room once they are read.
SHARE = "16m"


def gold_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold(to_silver(raw_sales(spark, sf_dir)))


def saved_gold(spark: SparkSession, sf_dir: str, scratch: Scratch) -> DataFrame:
    """:func:`gold_sales`, written. The shuffles of the joins are gone when the deduplication makes its own."""
    with Scratch(spark) as tables, session_conf(spark, "spark.sql.files.maxPartitionBytes", SHARE):
        return scratch.save(to_gold(to_silver(raw_sales(spark, sf_dir, tables))), "gold")


def stage_gold(spark: SparkSession, sf_dir: str, database: str) -> None:
    """The gold rows as one load of the staging table, kept nowhere else."""
    with Scratch(spark) as tables:
        load_warehouse(saved_gold(spark, sf_dir, tables), database)


# --- silver ---------------------------------------------------------------


def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(typed(raw_sales(spark, sf_dir)))


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(deduplicated(typed(raw_sales(spark, sf_dir))))


def silver_fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(defaults_filled(typed(raw_sales(spark, sf_dir))))


def silver_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = with_year(typed(raw_sales(spark, sf_dir)))
    return years.groupBy(F.col("Ano").alias("ano")).agg(F.count("*").alias("registros"))


def silver_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(to_silver(raw_sales(spark, sf_dir)))


# --- gold -----------------------------------------------------------------


def gold_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(gold_sales(spark, sf_dir))


def gold_full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_sales(spark, sf_dir).select("nome", "sobrenome", "nome_completo")


def gold_email_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_sales(spark, sf_dir).select("email", "dominio_email")


def gold_net_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        gold_sales(spark, sf_dir).select(
            "valor_da_compra", "desconto_oferecido", "valor_com_desconto", "valor_exato", "valor_liquido_exato"
        )
    )


def gold_daypart_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy(day_part(F.col("ts")).alias("turno"), F.hour("ts").alias("hora")).agg(
        F.count("*").alias("registros")
    )


def _by_daypart_and_year(gold: DataFrame) -> DataFrame:
    return gold.groupBy(YEAR, "turno_compra").agg(
        F.count("*").alias("vendas"),
        F.round(F.sum("valor_liquido_exato"), 2).cast("double").alias("valor_liquido"),
    )


def daypart_year_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: sales and net value per year and part of the day."""
    return _by_daypart_and_year(gold_sales(spark, sf_dir))


# --- files, layers, warehouse ----------------------------------------------


def source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage names as if every sale had come in its own file at its own time."""
    raw = raw_sales(spark, sf_dir)
    moment = F.from_utc_timestamp("Timestamp do Registro", F.current_timezone())
    file = F.concat_ws(".", F.lit("registros"), F.translate("Canal", " ", "_"), F.lit("csv"))
    return raw.select(
        file.alias("arquivo"),
        without_extension(file).alias("sem_extensao"),
        ingest_stamp(moment).alias("carimbo"),
        source_name(file, moment).alias("origem"),
    )


def _landed_csv(spark: SparkSession, raw: DataFrame, scratch: Scratch, names: dict[str, str] | None = None) -> str:
    """Raw sales as headed CSV files, the way they land; ``names`` changes the header."""
    folder = scratch.path("landing")
    kept = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    with session_conf(spark, "spark.sql.files.maxPartitionBytes", SHARE), shuffles_dropped(spark):
        raw.select(*BRONZE_COLUMNS).withColumnsRenamed(names or {}).write.options(**kept).csv(folder)
    return folder


def _landed_sales(spark: SparkSession, sf_dir: str, scratch: Scratch) -> str:
    """All raw sales in a landing folder; the shuffles of the joins are gone when the files are written."""
    with Scratch(spark) as tables:
        return _landed_csv(spark, raw_sales(spark, sf_dir, tables), scratch)


def bronze_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales written as CSV and read back by the landing reader."""
    folder = _landed_sales(spark, sf_dir, Scratch(spark))
    return read_bronze(spark, folder, files="part-*.csv").select(*BRONZE_COLUMNS)


def _landed_as(
    spark: SparkSession, raw: DataFrame, landing: str, prefix: str, suffix: str, names: dict[str, str] | None = None
) -> None:
    """All raw sales once more in the landing folder, in files of these names."""
    folder = _landed_csv(spark, raw, Scratch(spark), names)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path_of(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path_of(landing))
    for k, status in enumerate(system.globStatus(path_of(f"{folder}/part-*"))):
        system.rename(status.getPath(), path_of(f"{landing}/{prefix}{k}{suffix}"))


def bronze_admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales, landed under an admitted name and under two others, read by the landing reader's own filter."""
    landing = Scratch(spark).path("landing")
    with Scratch(spark) as tables:  # the joins behind the sales are made once, not once for every name
        raw = raw_sales(spark, sf_dir, tables)
        for prefix, suffix in (("registros_", ".csv"), ("outros_registros_", ".csv"), ("registros_", ".txt")):
            _landed_as(spark, raw, landing, prefix, suffix)
    return read_bronze(spark, landing).select(*BRONZE_COLUMNS)


def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines among lines made of all order lines: a price with an unquoted comma, or a field missing."""
    fields = [F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), *[F.lit("x")] * 9]
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    price = F.when(F.col("l_orderkey") % 5 == 0, F.replace(price, F.lit("."), F.lit(","))).otherwise(price)
    last = F.when(F.col("l_orderkey") % 5 == 1, price).otherwise(F.concat_ws(",", price, F.lit("y")))
    line = F.concat_ws(",", *fields, last).alias(",".join(BRONZE_COLUMNS))
    folder = Scratch(spark).path("landing")
    # one column and no quotes: lines are written as they are, below the header
    plain = {"header": True, "sep": "\x01", "quote": "\x00", "escape": "\x02"}
    table(spark, sf_dir, "lineitem").select(line).write.options(**plain).csv(folder)
    return malformed(read_lines(spark, folder, files="part-*.csv")).select(F.col(MALFORMED).alias("linha"))


def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and gold written as layers; one year of gold read back through its partitions."""
    scratch = Scratch(spark)
    with Scratch(spark) as tables, session_conf(spark, "spark.sql.files.maxPartitionBytes", SHARE):
        write_silver(to_silver(raw_sales(spark, sf_dir, tables)), scratch.path("silver"))
    write_gold(to_gold(read_silver(spark, scratch.path("silver"))), scratch.path("gold"))
    return _shown(read_gold(spark, scratch.path("gold")).where(F.col(YEAR) == 1996))


def _new_database(spark: SparkSession, scratch: Scratch) -> str:
    name = f"registros_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch.path('warehouse')}'")
    return name


def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging table after the same gold rows were loaded twice."""
    scratch = Scratch(spark)
    gold = saved_gold(spark, sf_dir, scratch)
    database = _new_database(spark, scratch)
    load_warehouse(gold, database)
    load_warehouse(gold, database)
    return checks.group_count(spark.table(f"{database}.{STAGING_TABLE}"))


def warehouse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging table after the same gold rows were appended twice, which doubles them."""
    scratch = Scratch(spark)
    gold = saved_gold(spark, sf_dir, scratch)
    database = _new_database(spark, scratch)
    load_warehouse(gold, database, append=True)
    load_warehouse(gold, database, append=True)
    return checks.group_count(spark.table(f"{database}.{STAGING_TABLE}"))


def _table_counts(spark: SparkSession, database: str, tables: list[str]) -> DataFrame:
    parts = [
        checks.row_count(spark.table(f"{database}.{t}")).select(F.lit(t).alias("tabela"), "registros")
        for t in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def star_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of all tables after the star was rebuilt twice."""
    scratch = Scratch(spark)
    database = _new_database(spark, scratch)
    stage_gold(spark, sf_dir, database)
    rebuild_star(spark, database)
    rebuild_star(spark, database)
    tables = [STAGING_TABLE, FACT_TABLE, *(d.table for d in DIMENSIONS)]
    return _table_counts(spark, database, tables)


def star_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all tables before, and what is left after the star is dropped and the staging table truncated."""
    scratch = Scratch(spark)
    database = _new_database(spark, scratch)
    stage_gold(spark, sf_dir, database)
    rebuild_star(spark, database)

    def counts(when: str) -> DataFrame:
        there = {t.name for t in spark.catalog.listTables(database)}
        names = [t for t in (STAGING_TABLE, FACT_TABLE, *(d.table for d in DIMENSIONS)) if t in there]
        return scratch.save(_table_counts(spark, database, names).withColumn("momento", F.lit(when)), when)

    before = counts("antes")
    drop_star(spark, database)
    truncate_staging(spark, database)
    return before.unionByName(counts("depois"))


def star_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse's fact, joined back to the natural keys of all its dimensions."""
    scratch = Scratch(spark)
    database = _new_database(spark, scratch)
    stage_gold(spark, sf_dir, database)
    rebuild_star(spark, database)
    sales = spark.table(f"{database}.{FACT_TABLE}").select(SOURCE, YEAR, *(d.id for d in DIMENSIONS))
    for d in reversed(DIMENSIONS):  # the largest first: what it shuffles is ids, not yet the texts of the others
        sales = sales.join(spark.table(f"{database}.{d.table}"), d.id).drop(d.id)
    return sales


def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing CSV to star in one run; rows and value of the fact per year."""
    scratch = Scratch(spark)
    folder = _landed_sales(spark, sf_dir, scratch)
    lake = Lake(scratch.path("lake"), _new_database(spark, scratch))
    run_batch(spark, folder, lake, files="part-*.csv")
    return _by_daypart_and_year(spark.table(f"{lake.database}.{FACT_TABLE}"))


def batch_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of the checks at the end of a batch run."""
    scratch = Scratch(spark)
    folder = _landed_sales(spark, sf_dir, scratch)
    lake = Lake(scratch.path("lake"), _new_database(spark, scratch))
    run_batch(spark, folder, lake, files="part-*.csv")
    return checks.star_report(spark, lake.database)


def stream_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing CSV to staging table as a stream, started twice."""
    scratch = Scratch(spark)
    folder = _landed_sales(spark, sf_dir, scratch)
    lake = Lake(scratch.path("lake"), _new_database(spark, scratch))
    for _ in range(2):
        run_stream(
            spark, folder, lake, scratch.path("checkpoint"), files="part-*.csv"
        ).awaitTermination()
    return _by_daypart_and_year(spark.table(f"{lake.database}.{STAGING_TABLE}"))


def _lake(spark: SparkSession, scratch: Scratch) -> Lake:
    return Lake(scratch.path("lake"), _new_database(spark, scratch))


def batch_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over one landing folder: all sales; all again in other files, once with another header; no new file.

    Per run, the lines it loaded, the files it left out, and the staging table's rows afterwards.
    """
    scratch = Scratch(spark)
    lake, landing = _lake(spark, scratch), scratch.path("landing")
    parts = []
    tables = Scratch(spark)
    raw = raw_sales(spark, sf_dir, tables)  # the joins behind the sales are made once, not once for every landing
    for run, prefixes in enumerate((["registros_a"], ["registros_b", "registros_x"], [])):
        for prefix in prefixes:
            other = {BRONZE_COLUMNS[0]: "Momento"} if prefix == "registros_x" else {}
            _landed_as(spark, raw, landing, prefix, ".csv", other)
        if run == 1:
            tables.remove()  # all has landed
        taken = run_batch(spark, landing, lake)
        left_out = F.count_if(F.col("situacao") == "cabecalho") > 0
        loaded = F.sum(F.when(F.col("situacao") == "carregado", F.col("linhas")))
        row = taken.agg(F.coalesce(loaded, F.lit(0)).alias("linhas"), left_out.alias("recusados"))
        staged = checks.row_count(spark.table(f"{lake.database}.{STAGING_TABLE}"))
        parts.append(scratch.save(row.crossJoin(staged).withColumn("corrida", F.lit(run)), f"run-{run}"))  # one row each
    return reduce(DataFrame.unionByName, parts)


def batch_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all layers after a batch run, by the ledger and the partitions."""
    scratch = Scratch(spark)
    lake, landing = _lake(spark, scratch), scratch.path("landing")
    with Scratch(spark) as tables:
        _landed_as(spark, raw_sales(spark, sf_dir, tables), landing, "registros_a", ".csv")
    run_batch(spark, landing, lake)
    columns = ("bronze", "silver", "gold", "fato", "duplicados")
    report = reconcile_lake(spark, lake)
    return report.agg(*(F.sum(c).alias(c) for c in columns), F.every("confere").alias("confere"))


def star_keys_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' ids after a rebuild over the even ones, and another over all: the first ones keep theirs."""
    scratch = Scratch(spark)
    database = _new_database(spark, scratch)
    with Scratch(spark) as tables:
        gold = saved_gold(spark, sf_dir, tables)
        load_warehouse(gold.where(F.col("telefone").cast("long") % 2 == 0), database)
        rebuild_star(spark, database)
        load_warehouse(gold, database)
    rebuild_star(spark, database)
    return spark.table(f"{database}.dim_cliente")


def fact_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by hash ids, joined back to the natural keys of all its dimensions."""
    scratch = Scratch(spark)
    fact, dims = hashed_star(saved_gold(spark, sf_dir, scratch), scratch)
    sales = fact.select(SOURCE, YEAR, *(d.id for d in DIMENSIONS))
    for d in reversed(DIMENSIONS):
        sales = sales.join(dims[d.table], d.id).drop(d.id)
    return sales


def silver_across_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales landed in two new files each, where an earlier load had every third customer's."""
    scratch = Scratch(spark)
    with Scratch(spark) as tables, session_conf(spark, "spark.sql.files.maxPartitionBytes", SHARE):
        raw = raw_sales(spark, sf_dir, tables)
        history = tables.save(to_silver(raw.where(F.col("Telefone").cast("long") % 3 == 0)), "history")
        source = F.col(f"`{SILVER_SOURCE}`")  # copies are found per file, so each kind of file is made silver by itself
        landed = [raw.withColumn(SILVER_SOURCE, F.concat(F.lit(file), source)) for file in ("novo_b_", "novo_a_")]
        new = [tables.save(to_silver(rows), f"new-{k}") for k, rows in enumerate(landed)]
        return _shown(across_files(new[0].union(new[1]), history, scratch))


def cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.cast_losses(raw_sales(spark, sf_dir))


# --- star -----------------------------------------------------------------


def dimension(dim: Dimension, spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(gold_sales(spark, sf_dir), dim, Scratch(spark))


def _star(
    spark: SparkSession, sf_dir: str, legacy_keys: bool = False, dense: bool = False
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fact over written gold and written dimensions."""
    scratch = Scratch(spark)
    gold = saved_gold(spark, sf_dir, scratch)
    dims = written_dims(gold, scratch)
    return build_fact(gold, dims, legacy_keys, scratch if dense else None, complete=True), dims


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fact columns but the sale id, whose order is free; see ``fact_key`` for that."""
    return _shown(_star(spark, sf_dir)[0].drop("venda_id"))


def fact_sales_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact by the literal lookups, which multiply some sales and lose others."""
    return _shown(_star(spark, sf_dir, legacy_keys=True)[0].drop("venda_id"))


def fact_year_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = year_as_text(_star(spark, sf_dir)[0])
    return checks.group_count(fact, YEAR)


def fact_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense sale ids: as many as rows, unique, from 0 on."""
    fact = _star(spark, sf_dir, dense=True)[0]
    return fact.agg(
        F.count("*").alias("registros"),
        F.countDistinct("venda_id").alias("distintos"),
        F.min("venda_id").alias("primeiro"),
        F.max("venda_id").alias("ultimo"),
    )


def order_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense id over a given table in the order of its dates and keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return dense_id(orders, "pedido_id", Scratch(spark), order=("o_orderdate", "o_orderkey"))


# --- checks ---------------------------------------------------------------


def check_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_count(gold_sales(spark, sf_dir))


def check_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count per e-mail domain; the group of NULL domains counts 0."""
    return checks.group_count(gold_sales(spark, sf_dir), "dominio_email")


def check_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.group_count(gold_sales(spark, sf_dir), SOURCE)


def check_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.distinct_count(gold_sales(spark, sf_dir), "email")


def check_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key of orders is unique; the line key of order lines is not."""
    orders = checks.key_check(table(spark, sf_dir, "orders"), "o_orderkey")
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "line", F.struct("l_orderkey", "l_linenumber")
    )
    return orders.withColumn("tabela", F.lit("orders")).unionByName(
        checks.key_check(lines, "line").withColumn("tabela", F.lit("lineitem"))
    )


def check_pk_cliente(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = next(d for d in DIMENSIONS if d.table == "dim_cliente")
    return checks.key_check(dimension(dim, spark, sf_dir), dim.id)


def check_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dims = _star(spark, sf_dir)
    return checks.reference_check(Scratch(spark).save(fact, "fact"), dims)


def check_fk_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines without order, and events without customer."""
    pairs = [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("events", "user_id", "customer", "c_custkey"),
    ]
    parts = [
        checks.orphans(table(spark, sf_dir, child), key, table(spark, sf_dir, parent), parent_key)
        .withColumn("coluna", F.lit(key))
        for child, key, parent, parent_key in pairs
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.null_counts(raw_sales(spark, sf_dir))


def profile_schema_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.schema_profile(to_silver(raw_sales(spark, sf_dir)))


def duplicates_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicates_report(raw_sales(spark, sf_dir))


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.copies(raw_sales(spark, sf_dir))


def reconcile_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_sales(spark, sf_dir)
    scratch = Scratch(spark)
    silver = scratch.save(to_silver(raw), "silver")
    gold = scratch.save(to_gold(silver), "gold")
    dims = written_dims(gold, scratch)
    fact = build_fact(gold, dims, complete=True)
    return checks.reconcile_layers({"bronze": raw, "silver": silver, "gold": gold, "fato": fact})


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five sales, the first ones by all columns."""
    return _shown(checks.sample(gold_sales(spark, sf_dir).orderBy(*GOLD.names)))


def sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_count(checks.sample(gold_sales(spark, sf_dir)))


def all_queries() -> dict[str, Query]:
    plain = [
        silver_typed,
        silver_dedup,
        silver_fill_nulls,
        silver_year,
        silver_full,
        gold_full,
        gold_full_name,
        gold_email_domain,
        gold_net_value,
        gold_daypart_events,
        daypart_year_revenue,
        source_lineage,
        bronze_csv,
        bronze_admitted,
        bronze_rejects,
        partition_roundtrip,
        warehouse_load,
        warehouse_append,
        star_rebuild,
        star_dropped,
        star_contents,
        batch_run,
        batch_checks,
        stream_run,
        batch_increments,
        batch_reconciled,
        star_keys_kept,
        fact_hashed,
        silver_across_files,
        cast_losses,
        fact_sales,
        fact_sales_legacy,
        fact_year_text,
        fact_key,
        order_key,
        check_rows,
        check_group_count,
        check_sources,
        check_distinct,
        check_pk,
        check_pk_cliente,
        check_fk,
        check_fk_orders,
        profile_nulls,
        profile_schema_counts,
        duplicates_report,
        duplicate_rows,
        reconcile_layers,
        sample_rows,
        sample_size,
    ]
    named: dict[str, Query] = {q.__name__: q for q in plain}
    return named | {d.table: partial(dimension, d) for d in DIMENSIONS}
