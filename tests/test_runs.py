from __future__ import annotations

import os

import pytest
from landed import COUNTS, land_all, month_of_sales, sale, write_csv
from pyspark.errors import StreamingQueryException

from retalake import run_batch, run_stream
from retalake.operators import checks
from retalake.operators.silver import to_silver
from retalake.operators.star import drop_star, last_version, rebuild_star
from retalake.plans import jobs
from retalake.plans.jobs import CheckFailed, Lake, LandingError, gold_rows, ledger, silver_rows
from retalake.schemas import BRONZE_COLUMNS, DIMENSIONS, FACT, FACT_TABLE, GOLD, LOADS_TABLE, SOURCES_TABLE, STAGING_TABLE
from retalake.sources.landing import read_bronze
from retalake.sources.layers import load_folder, read_gold
from retalake.sources.warehouse import load_warehouse, truncate_staging


def rows(spark, lake, table):
    return sorted(spark.table(f"{lake.database}.{table}").collect(), key=str)


def sources(taken):
    return sorted(r.arquivo_de_origem for r in taken.collect())


def without_id(fact):
    return sorted((tuple(r)[1:] for r in fact), key=str)


def test_batch_keeps_every_unique_sale_once(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    land_all(landing)
    taken = run_batch(spark, str(landing), lake, stamped=False).collect()
    assert {r.arquivo_de_origem: (r.linhas, r.situacao) for r in taken} == {
        name: (n, "carregado") for name, (n, _) in COUNTS.items()
    }

    fact = spark.table(f"{lake.database}.{FACT_TABLE}")
    report = checks.reconcile_layers(
        {
            "bronze": read_bronze(spark, str(landing), stamped=False),
            "silver": silver_rows(spark, lake),
            "gold": gold_rows(spark, lake),
            "fato": fact,
        }
    ).collect()
    assert {r.arquivo_de_origem: (r.bronze, r.duplicados, r.fato) for r in report} == {
        name: (n, extra, n - extra) for name, (n, extra) in COUNTS.items()
    }
    assert all(r.confere for r in report)
    assert sum(r.bronze for r in report) == 93 and fact.count() == 70
    assert [f.dataType for f in fact.schema] == [f.dataType for f in FACT]

    dims = {d.table: spark.table(f"{lake.database}.{d.table}") for d in DIMENSIONS}
    assert checks.key_check(fact, "venda_id").first().unica
    assert all(checks.key_check(dims[d.table], d.id).first().unica for d in DIMENSIONS)
    assert all(r.orfaos == 0 for r in checks.reference_check(fact, dims).collect())
    assert dims["dim_desconto"].count() == 5 and dims["dim_cliente"].count() == 70


def test_second_run_changes_nothing(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    land_all(landing)
    tables = [STAGING_TABLE, *(d.table for d in DIMENSIONS)]
    run_batch(spark, str(landing), lake)
    first = {t: rows(spark, lake, t) for t in tables}
    fact = without_id(rows(spark, lake, FACT_TABLE))
    run_batch(spark, str(landing), lake)
    assert {t: rows(spark, lake, t) for t in tables} == first
    assert without_id(rows(spark, lake, FACT_TABLE)) == fact


def test_corrected_file_replaces_all_its_years(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    write_csv(landing / "registros_a.csv", [sale(), sale(momento="2019-01-01 00:00:00")])
    run_batch(spark, str(landing), lake, stamped=False)
    assert len(rows(spark, lake, STAGING_TABLE)) == 2
    write_csv(landing / "registros_a.csv", [sale(valor="7")])
    run_batch(spark, str(landing), lake, stamped=False)
    assert silver_rows(spark, lake).count() == gold_rows(spark, lake).count() == 1
    assert [r.valor_da_compra for r in rows(spark, lake, STAGING_TABLE)] == [7.0]
    assert [r.valor_da_compra for r in rows(spark, lake, FACT_TABLE)] == [7.0]


def test_odd_file_names_are_replaced_too(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    odd = "registros d'água =50% \\x.csv"
    write_csv(landing / odd, [sale(), sale(momento="2019-01-01 00:00:00")])
    run_batch(spark, str(landing), lake, stamped=False)
    write_csv(landing / odd, [sale(valor="7")])
    assert sources(run_batch(spark, str(landing), lake, stamped=False)) == [odd.removesuffix(".csv")]
    assert [r.valor_da_compra for r in rows(spark, lake, STAGING_TABLE)] == [7.0]


def test_file_without_rows_loads_nothing(spark, lake, tmp_path):
    write_csv(tmp_path / "landing" / "registros_a.csv", [])
    (row,) = run_batch(spark, str(tmp_path / "landing"), lake).collect()
    assert (row.linhas, row.situacao) == (0, "carregado")
    assert rows(spark, lake, STAGING_TABLE) == []


def test_stream_takes_each_file_once(spark, lake, tmp_path):
    landing, checkpoint = tmp_path / "landing", f"{tmp_path}/checkpoint"

    def drain():
        run_stream(spark, str(landing), lake, checkpoint, max_files=1).awaitTermination()
        return len(rows(spark, lake, STAGING_TABLE))

    land_all(landing)
    assert drain() == 70
    assert drain() == 70
    write_csv(landing / "registros_novo.csv", month_of_sales("novo", 5, 3))
    assert drain() == 75
    rebuild_star(spark, lake.database)
    assert spark.table(f"{lake.database}.{FACT_TABLE}").count() == 75


def test_stream_that_failed_half_way_goes_on_without_copies(spark, lake, tmp_path, monkeypatch):
    landing, checkpoint = tmp_path / "landing", f"{tmp_path}/checkpoint"
    land_all(landing)
    with monkeypatch.context() as broken:
        broken.setattr("retalake.plans.jobs.load_warehouse", lambda *_: 1 / 0)
        with pytest.raises(StreamingQueryException):
            run_stream(spark, str(landing), lake, checkpoint).awaitTermination()
    assert read_gold(spark, lake.gold).count() == 70
    assert rows(spark, lake, STAGING_TABLE) == [] == gold_rows(spark, lake).collect()
    run_stream(spark, str(landing), lake, checkpoint).awaitTermination()
    assert len(rows(spark, lake, STAGING_TABLE)) == gold_rows(spark, lake).count() == 70


def test_stream_and_batch_give_the_same_gold(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    land_all(landing)
    run_stream(spark, str(landing), lake, f"{tmp_path}/c").awaitTermination()
    streamed = rows(spark, lake, STAGING_TABLE)
    assert to_silver(read_bronze(spark, str(landing))).count() == len(streamed)
    other = Lake(f"{tmp_path}/other", f"{lake.database}_b")
    spark.sql(f"CREATE DATABASE {other.database} LOCATION '{tmp_path}/other_warehouse'")
    run_batch(spark, str(landing), other)
    assert rows(spark, other, STAGING_TABLE) == streamed


def test_rebuild_that_failed_half_way_is_repeated(spark, lake, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    land_all(landing)
    run_batch(spark, str(landing), lake)
    with monkeypatch.context() as broken:
        broken.setattr("retalake.operators.star.build_fact", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            rebuild_star(spark, lake.database)
    assert len(rows(spark, lake, FACT_TABLE)) == 70  # of the version before
    rebuild_star(spark, lake.database)
    assert len(rows(spark, lake, FACT_TABLE)) == 70
    assert [len(rows(spark, lake, d.table)) for d in DIMENSIONS][0] == 5


def test_warehouse_load_append_truncate_drop(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    land_all(landing)
    run_batch(spark, str(landing), lake)
    gold = read_gold(spark, load_folder(lake.gold, 1))
    staging = f"{lake.database}.{STAGING_TABLE}"
    load_warehouse(gold, lake.database)
    assert spark.table(staging).count() == 70
    load_warehouse(gold, lake.database, append=True)
    assert spark.table(staging).count() == 140
    truncate_staging(spark, lake.database)
    assert spark.table(staging).count() == 0
    assert spark.table(staging).columns == GOLD.names
    drop_star(spark, lake.database)
    assert {t.name for t in spark.catalog.listTables(lake.database)} == {STAGING_TABLE, LOADS_TABLE, SOURCES_TABLE}


# --- files that must not get lost


def values(spark, lake):
    return sorted(r.valor_da_compra for r in rows(spark, lake, STAGING_TABLE))


def stream(spark, lake, tmp_path, **options):
    run_stream(spark, str(tmp_path / "landing"), lake, f"{tmp_path}/c", **options).awaitTermination()
    return values(spark, lake)


def test_late_file_with_an_old_date_is_streamed(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    write_csv(landing / "registros_a.csv", [sale(valor="1")])
    assert stream(spark, lake, tmp_path) == [1.0]
    write_csv(landing / "registros_b.csv", [sale(valor="2")])
    os.utime(landing / "registros_b.csv", (1_000_000_000, 1_000_000_000))
    assert stream(spark, lake, tmp_path) == [1.0, 2.0]
    run_batch(spark, str(landing), lake)
    assert values(spark, lake) == [1.0, 2.0]


@pytest.mark.parametrize("stamped", [False, True])
def test_changed_file_is_streamed_again(spark, lake, tmp_path, stamped):
    file = tmp_path / "landing" / "registros_a.csv"
    write_csv(file, [sale(valor="200")])
    os.utime(file, (1_500_000_000, 1_500_000_000))
    assert stream(spark, lake, tmp_path, stamped=stamped) == [200.0]
    write_csv(file, [sale(valor="7"), sale(valor="8")])
    os.utime(file, (1_600_000_000, 1_600_000_000))
    expected = [7.0, 8.0, 200.0] if stamped else [7.0, 8.0]
    assert stream(spark, lake, tmp_path, stamped=stamped) == expected
    assert stream(spark, lake, tmp_path, stamped=stamped) == expected
    run_batch(spark, str(tmp_path / "landing"), lake, stamped=stamped)
    assert values(spark, lake) == expected


def test_equal_names_in_two_folders(spark, lake, tmp_path):
    for k, folder in enumerate(("x", "y")):
        file = tmp_path / "landing" / folder / "registros_a.csv"
        write_csv(file, [sale(valor=str(k))])
        os.utime(file, (1_500_000_000, 1_500_000_000))
    run_stream(spark, f"{tmp_path}/landing/*", lake, f"{tmp_path}/c", max_files=1).awaitTermination()
    assert values(spark, lake) == [0.0, 1.0]
    assert sources(run_batch(spark, f"{tmp_path}/landing/*", lake)) == []  # taken by the stream
    assert values(spark, lake) == [0.0, 1.0]


def test_malformed_lines_are_kept_aside(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    write_csv(landing / "registros_a.csv", [sale(valor="5")])
    with open(landing / "registros_a.csv", "a", encoding="utf-8") as file:
        good = "2020-03-04 05:06:07,ana,LIMA,a@b,1,Cadeira,{},Redes,Web,Campanha,Rui,10%,OUTONO\n"
        file.write(good.format("2500,50"))
        file.write("only,two\n")
    run_batch(spark, str(landing), lake)
    assert values(spark, lake) == [5.0]
    assert spark.read.parquet(lake.rejected).count() == 2
    other = Lake(f"{tmp_path}/strict", lake.database)
    with pytest.raises(LandingError, match="malformed"):
        run_batch(spark, str(landing), other, strict=True)
    assert stream(spark, lake, tmp_path) == [5.0]
    assert spark.read.parquet(lake.rejected).count() == 2


def test_run_that_loses_a_sale_fails(spark, lake, tmp_path, monkeypatch):
    land_all(tmp_path / "landing")

    def losing(spark, database):
        version = rebuild_star(spark, database)
        fact = spark.table(f"{database}.{FACT_TABLE}")
        kept = spark.createDataFrame(fact.orderBy("venda_id").collect()[1:], fact.schema)
        spark.sql(f"INSERT OVERWRITE {database}.{FACT_TABLE}_versoes PARTITION (versao = {version}) SELECT * FROM {{kept}}", kept=kept)

    monkeypatch.setattr("retalake.plans.jobs.rebuild_star", losing)
    with pytest.raises(CheckFailed, match="vendas: 69 <> 70"):
        run_batch(spark, str(tmp_path / "landing"), lake)


FAULTY = {
    "no byte": "",
    "empty lines alone": "\n\n",
    "header alone": ",".join(BRONZE_COLUMNS) + "\n",
    "malformed lines alone": ",".join(BRONZE_COLUMNS) + "\nonly,two\n",
    "another header": "a,b,c\n1,2,3\n",
    "no header": "2020-03-04 05:06:07,ana,LIMA,a@b,1,Cadeira,9,Redes,Web,Campanha,Rui,10%,OUTONO\n",
}


@pytest.mark.parametrize("stamped", [False, True])
def test_faulty_files_are_loaded_once_they_are_corrected(spark, lake, tmp_path, stamped):
    """Whatever a file was when it was first taken; by the stream as by batches."""
    landing = tmp_path / "landing"
    write_csv(landing / "registros_boa.csv", [sale(valor="100")])
    for k, content in enumerate(FAULTY.values()):
        (landing / f"registros_{k}.csv").write_text(content, encoding="utf-8")
    for file in landing.iterdir():
        os.utime(file, (1_500_000_000, 1_500_000_000))
    batch = Lake(f"{tmp_path}/batch", f"{lake.database}_b")
    spark.sql(f"CREATE DATABASE {batch.database} LOCATION '{tmp_path}/batch_warehouse'")

    def both():
        run_batch(spark, str(landing), batch, stamped=stamped)
        assert values(spark, batch) == stream(spark, lake, tmp_path, stamped=stamped)
        return values(spark, batch)

    assert both() == [100.0]
    states = {r.arquivo_de_origem[-1]: r.situacao for r in ledger(spark, lake).collect()}
    expected = {"a": "carregado", "1": "vazio", "2": "carregado", "3": "carregado", "4": "cabecalho", "5": "cabecalho"}
    assert states == expected  # Spark lists no file without a byte
    for k in range(len(FAULTY)):
        write_csv(landing / f"registros_{k}.csv", [sale(valor=str(k)), sale(valor=str(10 + k))])
    assert both() == sorted([100.0, *map(float, range(6)), *map(float, range(10, 16))])
    assert both() == values(spark, lake)


def test_file_that_becomes_empty_takes_its_rows_away(spark, lake, tmp_path):
    file = tmp_path / "landing" / "registros_a.csv"
    write_csv(tmp_path / "landing" / "registros_b.csv", [sale(valor="2")])
    write_csv(file, [sale(valor="1")])
    run_batch(spark, str(tmp_path / "landing"), lake, stamped=False)
    assert values(spark, lake) == [1.0, 2.0]
    write_csv(file, [])
    run_batch(spark, str(tmp_path / "landing"), lake, stamped=False)
    assert values(spark, lake) == [2.0]
    file.write_text("other,header\n")  # left out; what was there before goes on
    run_batch(spark, str(tmp_path / "landing"), lake, stamped=False)
    assert values(spark, lake) == [2.0]


@pytest.mark.parametrize("stamped", [False, True])
def test_file_that_changes_while_it_is_loaded(spark, lake, tmp_path, monkeypatch, stamped):
    """Between the listing and the read, and between the read and the record."""
    landing, file = tmp_path / "landing", tmp_path / "landing" / "registros_a.csv"
    write_csv(file, [sale(valor="1")])
    os.utime(file, (1_500_000_000, 1_500_000_000))
    read, record = jobs.parsed_lines, jobs.load_sales

    def changed(name, moment, then):
        def step(*args, **kwargs):
            if name == "record":
                then(*args, **kwargs)
            write_csv(file, [sale(valor=str(moment))])
            os.utime(file, (moment, moment))
            return then(*args, **kwargs) if name == "read" else None

        return step

    with monkeypatch.context() as busy:
        busy.setattr(jobs, "parsed_lines", changed("read", 1_510_000_000, read))
        busy.setattr(jobs, "load_sales", changed("record", 1_520_000_000, record))
        assert stream(spark, lake, tmp_path, stamped=stamped) == [1_510_000_000.0]
    expected = [1_510_000_000.0, 1_520_000_000.0] if stamped else [1_520_000_000.0]
    assert stream(spark, lake, tmp_path, stamped=stamped) == expected
    run_batch(spark, str(landing), lake, stamped=stamped)
    assert values(spark, lake) == expected


def test_a_second_run_opens_only_new_files(spark, lake, tmp_path, monkeypatch):
    landing, opened = tmp_path / "landing", []
    land_all(landing)
    read = jobs.parsed_lines
    monkeypatch.setattr(jobs, "parsed_lines", lambda spark, uris: opened.extend(uris) or read(spark, uris))
    run_batch(spark, str(landing), lake, max_files=3)
    assert len(opened) == len(set(opened)) == 4
    assert last_version(spark, lake.database) == (1, 2)  # two loads, one rebuild
    opened.clear()
    assert sources(run_batch(spark, str(landing), lake)) == [] and opened == []
    assert last_version(spark, lake.database) == (1, 2)
    write_csv(landing / "registros_novo.csv", month_of_sales("novo", 5, 3))
    run_batch(spark, str(landing), lake)
    assert [os.path.basename(u) for u in opened] == ["registros_novo.csv"]
    assert spark.table(f"{lake.database}.{FACT_TABLE}").count() == 75


def test_a_strict_run_names_what_it_refuses(spark, lake, tmp_path):
    write_csv(tmp_path / "landing" / "registros_a.csv", [sale()], ["x", *BRONZE_COLUMNS[1:]])
    with pytest.raises(LandingError, match="registros_a: other header"):
        run_batch(spark, str(tmp_path / "landing"), lake, stamped=False, strict=True)
    write_csv(tmp_path / "landing" / "registros_a.csv", [sale()], [c.upper() for c in BRONZE_COLUMNS])
    run_batch(spark, str(tmp_path / "landing"), lake, strict=True)
    assert values(spark, lake) == [200.0]


def test_many_files_make_few_partitions_and_statements(spark, lake, tmp_path, monkeypatch):
    said, sql = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or sql(self, text, *a, **k))

    def run(files):
        for k in range(files):
            write_csv(tmp_path / "landing" / f"registros_{files}_{k}.csv", [sale(valor=str(k), momento=f"{2019 + k % 2}-01-01 00:00:00")])
        before = len(said)
        assert len(jobs.load_new(spark, f"{tmp_path}/landing", lake)) == 1
        return len(said) - before

    assert run(300) == run(2)
    assert sql(spark, f"SHOW PARTITIONS {lake.database}.{LOADS_TABLE}").count() == 4
    assert len(values(spark, lake)) == 302


def test_ids_stay_when_keys_come_and_go(spark, lake, tmp_path):
    """Also those of keys that are absent for a while; new ones follow the largest."""

    def ids(*names):
        sales = [sale(nome=n, sobrenome=None, email=f"{n}@x.example", canal=n) for n in names]
        write_csv(tmp_path / "landing" / "registros_a.csv", sales)
        run_batch(spark, str(tmp_path / "landing"), lake, stamped=False)
        channels, customers = ({r[1]: r[0] for r in rows(spark, lake, t)} for t in ("dim_canal", "dim_cliente"))
        pairs = spark.table(f"{lake.database}.{FACT_TABLE}").select("canal_id", "cliente_id").collect()
        assert sorted(map(tuple, pairs)) == sorted((channels[n], customers[n.title()]) for n in names)
        return channels

    assert ids("bia", "davi") == {"bia": 0, "davi": 1}
    assert ids("ana", "bia", "davi") == {"bia": 0, "davi": 1, "ana": 2}
    assert ids("ana", "carla") == {"ana": 2, "carla": 3}
    assert ids("bia", "carla", "zoe") == {"bia": 0, "carla": 3, "zoe": 4}
    assert spark.sql(f"SHOW PARTITIONS {lake.database}.dim_canal_versoes").count() == 2


def test_a_load_takes_a_bounded_number_of_bytes(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    land_all(landing)
    taken = run_batch(spark, str(landing), lake, stamped=False, max_bytes=1).collect()
    assert {r.arquivo_de_origem: r.linhas for r in taken} == {name: n for name, (n, _) in COUNTS.items()}
    assert sorted(r.carga for r in taken) == list(range(1, len(COUNTS) + 1))
    assert spark.table(f"{lake.database}.{FACT_TABLE}").count() == sum(n - extra for n, extra in COUNTS.values())


def test_a_stream_s_load_takes_a_bounded_number_of_bytes(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    land_all(landing)
    run_stream(spark, str(landing), lake, f"{tmp_path}/checkpoint", stamped=False, max_bytes=1).awaitTermination()
    assert sorted(r.carga for r in ledger(spark, lake).collect()) == list(range(1, len(COUNTS) + 1))
    assert spark.table(f"{lake.database}.{STAGING_TABLE}").count() == sum(n - extra for n, extra in COUNTS.values())


def test_files_of_one_source_are_in_one_load(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    write_csv(landing / "registros_a.csv", [sale(), sale(valor="1")])
    write_csv(landing / "registros_b.csv", [sale()])
    write_csv(landing / "registros_a.txt", [sale(valor="2")])
    run_batch(spark, str(landing), lake, files="registros_*", stamped=False, max_bytes=1)
    counts = spark.table(f"{lake.database}.{STAGING_TABLE}").groupBy("arquivo_de_origem").count().collect()
    assert {tuple(r) for r in counts} == {("registros_a", 3), ("registros_b", 1)}
