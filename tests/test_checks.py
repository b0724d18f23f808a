from __future__ import annotations

from landed import bronze, sale

from retalake.operators import checks


def pairs(df):
    return {r[0]: r[1] for r in df.collect()}


def test_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 2)], "g string, k int")
    assert checks.row_count(df).first().registros == 3
    assert pairs(checks.group_count(df, "g")) == {"a": 2, None: 0}
    assert checks.distinct_count(df, "k").first().distintos == 2
    assert tuple(checks.key_check(df, "k").first()) == (3, 2, False)
    assert checks.sample(df, 2).count() == 2


def test_orphans_count_rows_and_skip_nulls(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert checks.orphans(child, "k", parent, "id").first().orfaos == 2
    assert checks.orphans(parent, "id", parent, "id").first().orfaos == 0


def test_profiles(spark):
    df = bronze(spark, sale(), sale(vendedor=None, desconto=None), sale(vendedor=None))
    nulls = pairs(checks.null_counts(df))
    assert (nulls["Vendedor"], nulls["Desconto Oferecido"], nulls["Nome"]) == (2, 1, 0)
    profile = {r.coluna: (r.tipo, r.preenchidos) for r in checks.schema_profile(df).collect()}
    assert profile["Vendedor"] == ("string", 1) and len(profile) == 14


def test_duplicates(spark):
    df = bronze(spark, sale(), sale(), sale(), sale(valor="1")).union(
        bronze(spark, sale(), source="registros_b")
    )
    report = {r[0]: tuple(r)[1:] for r in checks.duplicates_report(df).collect()}
    assert report == {"registros_a": (4, 2, 2), "registros_b": (1, 0, 1)}
    who = checks.copies(df).collect()
    assert [(r["Nome"], r["vezes"]) for r in who] == [("ana", 3)]


def test_reconciliation_notices_lost_rows_and_sources(spark):
    def layer(*names):
        return spark.createDataFrame([(n,) for n in names], "arquivo_de_origem string")

    report = checks.reconcile_layers(
        {"bronze": layer("a", "a", "b", "c"), "silver": layer("a", "b", "c"), "gold": layer("a", "b")}
    )
    got = {r[0]: (r.bronze, r.silver, r.gold, r.duplicados, r.confere) for r in report.collect()}
    assert got == {"a": (2, 1, 1, 1, True), "b": (1, 1, 1, 0, True), "c": (1, 1, 0, 0, False)}
