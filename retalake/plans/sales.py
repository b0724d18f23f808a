"""Raw sales, shaped like landing files, from the order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.functions.columns import source_name
from retalake.schemas import BRONZE_COLUMNS, SILVER_SOURCE
from retalake.session import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _price_text(price: Column) -> Column:
    """Decimal comma; a point between thousands from 100,000 on, which cannot be parsed later."""
    text = F.replace(price.cast("string"), F.lit("."), F.lit(","))
    grouped = F.concat(F.substring(text, 1, 3), F.lit("."), F.substring(text, 4, 6))
    return F.when(price >= 100000, grouped).otherwise(text)


def raw_sales(spark: SparkSession, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """One row per order line as 13 text columns and the source file; large quantities are copied.

    With ``scratch`` the joined lines are written there and copied when they are read, so that the shuffles of the
    joins are gone before what follows makes its own. A row's copies are made by one task either way.

    Texts of customers and orders are made on the table they come from, before a join repeats them, and orders meet
    their customers before the much larger order lines join. Order lines stay narrow as long as they are shuffled:
    they meet parts and sellers by their numbers alone, orders and customers last, and become texts at the end. Of
    their own values only what the texts need is carried: cents, whole percents, the number of copies.
    """
    region = F.lower("r_name")
    source = F.concat(F.lit("registros_"), F.translate(region, " ", "_"), F.lit(".csv"))
    regions = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"),
        F.concat(F.lit("@"), F.translate(region, " ", "-"), F.lit(".com")).alias("domain"),
        source_name(source).alias(SILVER_SOURCE),
    )
    places = table(spark, sf_dir, "nation").join(regions, "n_regionkey")

    key, user = F.col("c_custkey"), F.lower(F.translate("c_name", "#", "."))
    customers = (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("o_custkey"),
            F.lit(" CLIENTE").alias("Nome"),
            F.concat(F.lit("da-silva "), (key - key % 2).cast("string")).alias("Sobrenome"),
            F.when(key % 50 == 0, user).otherwise(F.concat(user, "domain")).alias("Email"),
            key.cast("string").alias("Telefone"),
            F.col("c_mktsegment").alias("Canal"),
            SILVER_SOURCE,
        )
    )

    hours = F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    moment = (F.col("o_orderdate") + hours).cast("string")
    orders = (
        table(spark, sf_dir, "orders")
        .withColumn("Timestamp do Registro", moment)
        .join(customers, "o_custkey")
        .withColumnsRenamed(
            {"o_orderkey": "l_orderkey", "o_orderpriority": "Plataforma de Interação"}
        )
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("Produto Adquirido")
    )
    sellers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("Vendedor"),
    )

    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("percent"),
        F.when(F.col("l_quantity") > 45, 3).when(F.col("l_quantity") > 40, 2).otherwise(1).alias("times"),
        F.concat("l_returnflag", "l_linestatus").alias("Campanha de Marketing"),
    )
    percent = F.col("percent")
    joined = lines.join(parts, "l_partkey").join(sellers, "l_suppkey").join(orders, "l_orderkey")
    sales = joined.withColumns(
        {
            "Valor da Compra": _price_text(F.col("price")),
            "Desconto Oferecido": F.when(percent > 0, F.concat(percent.cast("string"), F.lit("%"))),
            "Código de Desconto Usado": F.when(percent > 0, F.concat(F.lit("C"), (percent % 3).cast("string"))),
        }
    )
    if scratch:
        sales = scratch.save(sales.select(*BRONZE_COLUMNS, SILVER_SOURCE, "times"), "sales")
    copied = sales.select("*", F.explode(F.array_repeat(F.lit(1), F.col("times"))))
    return copied.select(*BRONZE_COLUMNS, SILVER_SOURCE)
