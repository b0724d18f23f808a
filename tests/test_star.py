from __future__ import annotations

import random

import pytest
from landed import bronze, sale
from pyspark.sql import Window
from pyspark.sql import functions as F

from retalake import build_fact, to_gold, to_silver
from retalake.operators.keys import dense_id
from retalake.operators.star import written_dims, year_as_text
from retalake.schemas import DIMENSIONS
from retalake.session import Scratch
from retalake.sources.warehouse import jdbc_options


@pytest.fixture
def scratch(spark):
    with Scratch(spark) as folder:
        yield folder


def star(spark, scratch, *sales, legacy_keys=False):
    gold = scratch.save(to_gold(to_silver(bronze(spark, *sales))), "gold")
    dims = written_dims(gold, scratch)
    return build_fact(gold, dims, legacy_keys), dims


def test_name_with_two_contacts(spark, scratch):
    sales = [sale(), sale(email="outra@loja.example")]
    fact, dims = star(spark, scratch, *sales)
    assert dims["dim_cliente"].count() == 2
    assert fact.count() == 2 and fact.select("cliente_id").distinct().count() == 2
    assert build_fact(to_gold(to_silver(bronze(spark, *sales))), dims, legacy_keys=True).count() == 4


def test_code_with_many_rates(spark, scratch):
    """65 sales under 5 codes; literal lookups match every rate of the code."""
    sales = [sale(valor=str(i), desconto=f"{5 * (1 + i % 3)}%", codigo=f"C{i % 5}") for i in range(65)]
    fact, dims = star(spark, scratch, *sales)
    assert dims["dim_desconto"].count() == 15
    assert fact.count() == 65
    gold = to_gold(to_silver(bronze(spark, *sales)))
    assert build_fact(gold, dims, legacy_keys=True).count() == 65 * 3


def test_null_keys_stay_unless_legacy(spark, scratch):
    sales = [sale(canal=None), sale(email=None, valor="3"), sale(valor="4")]
    fact, dims = star(spark, scratch, *sales)
    assert fact.count() == 3 and fact.where("canal_id IS NULL OR cliente_id IS NULL").count() == 0
    gold = to_gold(to_silver(bronze(spark, *sales)))
    # One sale without channel and one without e-mail drop out; the name of the others has two contacts.
    legacy = build_fact(gold, dims, legacy_keys=True)
    assert [r.valor_da_compra for r in legacy.collect()] == [4.0, 4.0]


def test_ids_follow_the_natural_key_with_null_first(spark, scratch):
    _, dims = star(spark, scratch, sale(canal="b"), sale(canal=None), sale(canal="a"), sale(canal="É"))
    assert [tuple(r) for r in dims["dim_canal"].orderBy("canal_id").collect()] == [
        (0, None), (1, "a"), (2, "b"), (3, "É"),
    ]


def test_fact_and_dimensions_hold_all_of_gold(spark, scratch):
    """Random sales with gaps: following the ids back gives every gold row, and nothing else."""
    random.seed(7)
    def pick(*options):
        return random.choice([None, *options])

    sales = [
        sale(
            momento=pick("2020-01-01 03:00:00", "2021-05-05 15:00:00", "ontem"),
            nome=pick("ana", " bia "), email=pick("a@x.y", "b@x.y", "sem"), telefone=pick("1", "2"),
            produto=pick("p", "q"), valor=pick("1,5", "2", "x"), canal=pick("c"), plataforma=pick("w"),
            campanha=pick("v"), vendedor=pick("r", "s"), desconto=pick("5%", "0%"), codigo=pick("V", "I"),
        )
        for _ in range(600)
    ]
    gold = scratch.save(to_gold(to_silver(bronze(spark, *sales))), "gold")
    dims = written_dims(gold, scratch)
    fact = build_fact(gold, dims)
    back = fact
    for dim in DIMENSIONS:
        back = back.join(dims[dim.table], dim.id)
    columns = [c for c in gold.columns if c not in ("nome", "sobrenome")]
    assert sorted(map(str, back.select(*columns).collect())) == sorted(
        map(str, gold.select(*columns).withColumn(
            "valor_da_compra", F.col("valor_da_compra").cast("double")).collect())
    )
    for dim in DIMENSIONS:
        expected = {tuple(r) for r in gold.select(*dim.key).collect()}
        got = dims[dim.table].orderBy(dim.id).collect()
        assert [r[0] for r in got] == list(range(len(expected)))
        assert {tuple(r)[1:] for r in got} == expected


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_dense_id_equals_a_global_row_number(spark, scratch, partitions):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        random.seed(partitions)
        keys = [(random.choice([None, "x", "y", f"k{i % 90}"]), i) for i in random.sample(range(5000), 3000)]
        df = spark.createDataFrame(keys, "a string, b int").repartition(5)
        got = dense_id(df, "id", scratch, order=("a", "b"))
        want = df.select(
            (F.row_number().over(Window.orderBy(F.col("a").asc_nulls_first(), "b")) - 1)
            .cast("long").alias("id"), "a", "b",
        )
        assert got.exceptAll(want).count() == 0 and got.count() == 3000
        free = dense_id(df, "livre", scratch)
        assert sorted(r.livre for r in free.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_year_as_text(spark, scratch):
    fact, _ = star(spark, scratch, sale())
    assert year_as_text(fact).first().ano == "2020"
    assert fact.first().ano == 2020


def test_jdbc_options():
    options = jdbc_options("jdbc:x://h/db", "registros.registros_vendas", connections=16)
    assert options == {
        "url": "jdbc:x://h/db", "dbtable": "registros.registros_vendas", "batchsize": "10000",
        "numPartitions": "16",
    }
