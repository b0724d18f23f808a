from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from landed import bronze, sale
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from retalake import to_gold, to_silver
from retalake.schemas import GOLD, SILVER
from retalake.sources.layers import read_gold, read_silver, write_gold, write_silver


def types(schema):
    return [(f.name, f.dataType) for f in schema]


def test_copies_are_found_after_the_casts(spark):
    df = bronze(spark, sale(valor="2500,50"), sale(valor="2500.50"), sale(valor="2500.5"))
    assert to_silver(df).count() == 1


def test_equal_sales_of_two_files_both_stay(spark):
    df = bronze(spark, sale()).union(bronze(spark, sale(), source="registros_b"))
    assert to_silver(df).count() == 2


def test_rows_with_nulls_are_copies_too(spark):
    df = bronze(spark, sale(vendedor=None, desconto=None), sale(vendedor=None, desconto=None))
    assert to_silver(df).count() == 1


def test_defaults_come_after_deduplication(spark):
    df = bronze(spark, sale(vendedor=None), sale(vendedor="NÃO INFORMADO"))
    assert to_silver(df).count() == 2


@pytest.mark.parametrize("text", [None, "0%", "NaN%", "abc"])
def test_missing_discount_is_zero(spark, text):
    row = to_silver(bronze(spark, sale(desconto=text, codigo=None, vendedor=None))).first()
    assert row["Desconto Oferecido"] == 0.0
    assert row["Código de Desconto Usado"] == "NÃO DISPONÍVEL"
    assert row["Vendedor"] == "NÃO INFORMADO"


def test_silver_layout(spark):
    silver = to_silver(bronze(spark, sale(), sale(momento="ontem")))
    assert types(silver.schema) == types(SILVER)
    assert sorted((r.Ano for r in silver.collect()), key=str) == [2020, None]
    with pytest.raises(PySparkException):
        to_silver(bronze(spark, sale(momento="ontem")), strict=True).collect()


def test_gold_layout_and_values(spark):
    gold = to_gold(to_silver(bronze(spark, sale(valor="1000,5"))))
    assert types(gold.schema) == types(GOLD)
    assert tuple(gold.first()) == (
        datetime(2020, 3, 4, 5, 6, 7), "Madrugada", "ana", "LIMA", "Ana Lima", "ana@loja.example",
        "loja.example", "11900000000", "Cadeira", 1000.5, 0.1, 1000.5 * 0.9, "Redes Sociais",
        "Website", "Campanha Outono", "Rui", "OUTONO", Decimal("1000.50"), Decimal("900.45"), "registros_a", 2020,
    )


def test_unreadable_timestamp_flags(spark):
    silver = to_silver(bronze(spark, sale(momento=None)))
    assert to_gold(silver).first().turno_compra is None
    assert to_gold(silver, null_as_night=True).first().turno_compra == "Noite"


def test_layers_round_trip(spark, tmp_path):
    df = bronze(spark, sale(), sale(momento="2021-01-01 00:00:00"), sale(momento=None, valor="9"))
    silver = to_silver(df)
    write_silver(silver, f"{tmp_path}/silver")
    back = read_silver(spark, f"{tmp_path}/silver")
    assert types(back.schema) == types(SILVER)
    assert sorted(back.collect(), key=str) == sorted(silver.collect(), key=str)
    write_gold(to_gold(back), f"{tmp_path}/gold")
    gold = read_gold(spark, f"{tmp_path}/gold")
    assert sorted(gold.collect(), key=str) == sorted(to_gold(silver).collect(), key=str)


def test_overwriting_a_source_keeps_the_others(spark, tmp_path):
    path = f"{tmp_path}/silver"
    write_silver(to_silver(bronze(spark, sale(), source="registros_b")), path)
    for _ in range(2):
        write_silver(to_silver(bronze(spark, sale(), sale(valor="1"))), path)
    counts = read_silver(spark, path).groupBy("Arquivo de Origem").count().collect()
    assert {tuple(r) for r in counts} == {("registros_a", 2), ("registros_b", 1)}


def test_sources_with_digits_only_stay_text(spark, tmp_path):
    write_silver(to_silver(bronze(spark, sale(), source="2020")), f"{tmp_path}/s")
    assert read_silver(spark, f"{tmp_path}/s").first()["Arquivo de Origem"] == "2020"


def test_odd_source_names_are_found_again(spark, tmp_path):
    odd = "registros a+b=%1 [x]{y}#?*:^'\"\\é"
    write_silver(to_silver(bronze(spark, sale(), source=odd)), f"{tmp_path}/s")
    assert read_silver(spark, f"{tmp_path}/s").first()["Arquivo de Origem"] == odd
    assert read_silver(spark, f"{tmp_path}/s").where(F.col("Arquivo de Origem") == odd).count() == 1
