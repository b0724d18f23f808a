from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from retalake.functions import columns as C
from retalake.functions.names import plain_columns, plain_name
from retalake.schemas import BRONZE_COLUMNS
from retalake.session import session_conf


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_sale_timestamp_takes_one_layout_only(spark):
    texts = ["2020-02-29 23:59:58", "2021-02-29 00:00:00", "2020-01-01", "2020-01-01T10:00:00",
             "01/02/2020 10:00:00", " 2020-01-01 10:00:00", "", None]
    assert values(spark, texts, C.sale_timestamp) == [datetime(2020, 2, 29, 23, 59, 58)] + [None] * 7


def test_sale_timestamp_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # Midnight of this day did not exist in that zone.
        assert values(spark, ["2018-11-04 00:30:00"], C.sale_timestamp) == [datetime(2018, 11, 4, 0, 30)]
        assert values(spark, ["2018-11-04 00:30:00"], lambda c: C.day_part(C.sale_timestamp(c))) == ["Madrugada"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_comma_decimal(spark):
    got = values(spark, ["2500,50", "2500.50", "70", "1.234,56", "abc", "", None], C.comma_decimal)
    assert got == [2500.5, 2500.5, 70.0, None, None, None, None]


def test_exact_money(spark):
    texts = ["2500,50", "2500.5", "-3", "7,", "0,100", "9999999999999999.99", "1.234,56", "1,005", "NaN", "Infinity", "1e3", " 1", "", None]
    expected = ["2500.50", "2500.50", "-3.00", "7.00", "0.10", "9999999999999999.99", *[None] * 8]
    assert values(spark, texts, C.exact_money) == [x if x is None else Decimal(x) for x in expected]
    for text in ("NaN", "1,005", "12345678901234567"):
        with pytest.raises(PySparkException, match="not exact money"):
            values(spark, [text], lambda c: C.exact_money(c, strict=True))


def test_exact_net(spark):
    net = lambda c: C.exact_net(c.cast("decimal(18,2)"), F.lit(0.11))
    assert values(spark, ["100", "0.01", "9999999999999999.99"], net) == [
        Decimal("89"), Decimal("0.0089"), Decimal("8899999999999999.9911")
    ]
    assert values(spark, ["1"], lambda c: C.exact_net(c.cast("decimal(18,2)"), F.lit(float("inf")))) == [None]


def test_percent_fraction(spark):
    got = values(spark, ["11%", "8", "0%", "x%", None], C.percent_fraction)
    assert got == [0.11, 0.08, 0.0, None, None]


@pytest.mark.parametrize(
    "expression,text",
    [(C.comma_decimal, "1.234,56"), (C.percent_fraction, "x%"), (C.sale_timestamp, "2020-01-01"),
     (C.sale_timestamp, "2021-02-29 00:00:00")],
)
def test_strict_mode_fails(spark, expression, text):
    with pytest.raises(PySparkException):
        values(spark, [text], lambda c: expression(c, strict=True))


def test_strict_mode_keeps_good_values_and_nulls(spark):
    got = values(spark, ["2020-01-01 00:00:00", None], lambda c: C.sale_timestamp(c, strict=True))
    assert got == [datetime(2020, 1, 1), None]
    assert values(spark, ["1,5", None], lambda c: C.comma_decimal(c, strict=True)) == [1.5, None]


def test_full_name(spark):
    df = spark.createDataFrame(
        [(" joÃO".replace("Ã", "ã"), "da silva "), ("ANA", None), (None, "lima"), ("bia", "souza-reis"), (None, None)],
        "a string, b string",
    )
    got = [r[0] for r in df.select(C.full_name(F.col("a"), F.col("b"))).collect()]
    assert got == ["João Da Silva", "Ana", "Lima", "Bia Souza-reis", ""]
    literal = df.select(C.full_name(F.col("a"), F.col("b"), trim_parts=False)).first()[0]
    assert literal == " João Da Silva "


def test_email_domain(spark):
    got = values(spark, ["a@b.com", "sem-arroba", "a@b@c", "a@", None], C.email_domain)
    assert got == ["b.com", None, "b", "", None]


def test_day_part_edges(spark):
    hours = ["00:00:00", "05:59:59", "06:00:00", "11:59:59", "12:00:00", "17:59:59", "18:00:00", "23:59:59"]
    moments = [datetime.fromisoformat(f"2020-01-01 {h}") for h in hours] + [None]
    got = values(spark, moments, C.day_part, "timestamp_ntz")
    assert got == ["Madrugada"] * 2 + ["Manhã"] * 2 + ["Tarde"] * 2 + ["Noite"] * 2 + [None]
    assert values(spark, [None], lambda c: C.day_part(c, null_as_night=True), "timestamp_ntz") == ["Noite"]


def test_source_name(spark):
    got = values(spark, ["registros_a.csv", "a.b.csv", "sem"], C.source_name)
    assert got == ["registros_a", "a.b", "sem"]
    stamped = values(spark, ["r.csv"], lambda c: C.source_name(c, F.timestamp_seconds(F.lit(0))))
    assert stamped == ["19700101_000000_r"]


def test_ingest_stamp_is_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert values(spark, ["x"], lambda c: C.ingest_stamp(F.timestamp_seconds(F.lit(3661)))) == ["19700101_010101"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ingest_stamp_over_a_clock_change(spark):
    moments = [1710037800, 1710041400]  # 02:30 and 03:30 UTC on the day that New York's clocks go forward
    with session_conf(spark, "spark.sql.session.timeZone", "America/New_York"):
        stamps = values(spark, moments, lambda c: C.ingest_stamp(F.timestamp_seconds(c)), "long")
    assert stamps == ["20240310_023000", "20240310_033000"]


def test_plain_names(spark):
    assert plain_name("Código de Desconto Usado") == "codigo_de_desconto_usado"
    assert plain_name("ÁÀÂÃÄÅÇÉÈÊËÍÌÎÏÑÓÒÔÕÖÚÙÛÜÝŸ") == "aaaaaaceeeeiiiinooooouuuuyy"
    assert plain_name("Interac\u0327a\u0303o") == "interacao"
    df = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in BRONZE_COLUMNS))
    assert plain_columns(df).columns[8] == "plataforma_de_interacao"
