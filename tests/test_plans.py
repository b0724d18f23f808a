"""Physical plans: what is read, shuffled, broadcast and split."""

from __future__ import annotations

import re
from contextlib import ExitStack

import pytest
from landed import bronze, sale
from pyspark.sql import functions as F

from retalake import build_fact, to_gold, to_silver
from retalake.operators import checks, star
from retalake.operators.silver import across_files
from retalake.operators.star import build_dim, written_dims
from retalake.plans.queries import all_queries
from retalake.plans.sales import raw_sales
from retalake.schemas import DIMENSIONS, SILVER_SOURCE
from retalake.session import Scratch, session_conf
from retalake.sources.layers import read_gold, read_silver, write_gold, write_silver

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """Plan after it has run, with what was decided at run time."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def gold(spark):
    with Scratch(spark) as scratch:
        yield scratch.save(to_gold(to_silver(raw_sales(spark, SF_DIR))), "gold")


def test_gold_is_narrow(spark, tmp_path):
    write_silver(to_silver(bronze(spark, sale())), f"{tmp_path}/s")
    assert "Exchange" not in plan(to_gold(read_silver(spark, f"{tmp_path}/s")))


def test_silver_shuffles_once_and_drops_copies_before(spark, tmp_path):
    bronze(spark, sale()).write.parquet(f"{tmp_path}/b")
    text = plan(to_silver(spark.read.parquet(f"{tmp_path}/b")))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2
    assert "SortAggregate" not in text


def test_year_filter_reads_its_partitions_and_columns_only(spark, tmp_path):
    write_gold(to_gold(to_silver(bronze(spark, sale()))), f"{tmp_path}/g")
    text = plan(read_gold(spark, f"{tmp_path}/g").where("ano = 2020").select("canal", "ano"))
    assert re.search(r"PartitionFilters: \[[^\]]*ano#\d+ = 2020", text)
    assert "ReadSchema: struct<canal:string>" in text


@pytest.mark.parametrize("dim", DIMENSIONS, ids=lambda d: d.table)
def test_dimensions_read_only_their_key(spark, gold, dim):
    text = plan(gold.select(*dim.key).distinct())
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == set(dim.key)


def test_dimension_ids_need_no_single_task(spark, gold):
    with Scratch(spark) as scratch:
        text = plan(build_dim(gold, DIMENSIONS[-1], scratch))
        # The one task adds up the row counts of the partitions, not rows.
        assert text.count("SinglePartition") == 1
        assert re.search(r"Exchange SinglePartition.*\n.*HashAggregate\(keys=.*count", text)


def test_no_python_or_cross_join_anywhere(spark):
    lazy = {
        n: q for n, q in all_queries().items()
        if n.startswith(("silver", "gold", "daypart", "profile", "dup", "check_pk", "check_fk", "source"))
    }
    for name, query in lazy.items():
        text = plan(query(spark, SF_DIR))
        for bad in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
            assert bad not in text, name


def test_lookups_broadcast_only_under_the_threshold(spark, gold):
    with Scratch(spark) as scratch:
        dims = written_dims(gold, scratch)
        assert plan(build_fact(gold, dims)).count("BroadcastHashJoin") == 7
        with session_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), session_conf(
            spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"
        ):
            text = plan(build_fact(gold, dims))
            assert text.count("SortMergeJoin") == 7 and "Broadcast" not in text


def hot_sales(spark, rows: int):
    """Sales of which a third belong to one customer, product, seller and file."""
    i = F.col("id")
    hot = i % 3 == 0
    silver = {
        "Timestamp do Registro": F.timestamp_seconds(1577836800 + i * 60).cast("string"),
        "Nome": F.when(hot, "ana").otherwise(F.concat(F.lit("cliente "), (i % 5000).cast("string"))),
        "Sobrenome": F.lit("lima"),
        "Email": F.when(hot, "a@b.c").otherwise(F.concat((i % 5000).cast("string"), F.lit("@b.c"))),
        "Telefone": F.lit("1"),
        "Produto Adquirido": F.when(hot, "x").otherwise((i % 900).cast("string")),
        "Valor da Compra": i.cast("string"),
        "Canal": F.lit("c"),
        "Plataforma de Interação": F.lit("p"),
        "Campanha de Marketing": F.lit("m"),
        "Vendedor": F.when(~hot, (i % 700).cast("string")),
        "Desconto Oferecido": F.lit("10%"),
        "Código de Desconto Usado": F.lit("OUTONO"),
        SILVER_SOURCE: F.when(hot, "registros_a").otherwise(
            F.concat(F.lit("registros_"), (i % 40).cast("string"))
        ),
    }
    return spark.range(rows).select(*(c.alias(n) for n, c in silver.items()))


def small_partitions(spark) -> ExitStack:
    """Sizes at which a test's few rows already count as big."""
    stack = ExitStack()
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        stack.enter_context(session_conf(spark, key, value))
    return stack


def test_hot_keys_are_split_in_the_fact(spark):
    with Scratch(spark) as scratch, small_partitions(spark):
        sales = scratch.save(to_gold(to_silver(hot_sales(spark, 60000))), "gold")
        dims = written_dims(sales, scratch)
        fact = build_fact(sales, dims)
        text = final_plan(fact)
        assert "SortMergeJoin(skew=true)" in text
        assert fact.count() == 60000
        assert {r.orfaos for r in checks.reference_check(fact, dims).collect()} == {0}


def test_hot_source_is_written_by_many_tasks(spark, tmp_path):
    with small_partitions(spark), session_conf(spark, "spark.sql.adaptive.enabled", "false"):
        write_silver(to_silver(hot_sales(spark, 300000)), f"{tmp_path}/s")
    layer = read_silver(spark, f"{tmp_path}/s")
    files = layer.where(F.col(SILVER_SOURCE) == "registros_a").groupBy("_metadata.file_path").count()
    sizes = [r[1] for r in files.collect()]
    assert sum(sizes) == 100000 and layer.count() == 300000
    assert max(sizes) < 25000


def test_many_copies_reach_the_shuffle_once_per_task(spark, tmp_path):
    bronze(spark, sale()).select("*", F.explode(F.sequence(F.lit(1), F.lit(50000)))).drop("col").repartition(
        4
    ).write.parquet(f"{tmp_path}/b")
    silver = to_silver(spark.read.parquet(f"{tmp_path}/b"))
    assert silver.count() == 1
    report = checks.duplicates_report(spark.read.parquet(f"{tmp_path}/b"))
    assert tuple(report.first()) == ("registros_a", 50000, 49999, 1)


def test_order_lines_are_shuffled_before_they_get_wide(spark):
    """Orders with their customers join last: nothing that has a customer's texts is shuffled for parts or sellers."""
    with session_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        joins = re.findall(r"SortMergeJoin \[(\w+)#", plan(raw_sales(spark, SF_DIR)))
    assert joins[:3] == ["l_orderkey", "l_suppkey", "l_partkey"]  # from the last one down


def test_contacts_are_looked_up_by_hash(spark, gold, monkeypatch):
    from retalake.operators import star

    with Scratch(spark) as scratch, session_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        sales = scratch.save(gold, "gold-by-hash")
        dims = written_dims(sales, scratch)
        whole = build_fact(sales, dims).drop("venda_id")
        assert "SortMergeJoin [coalesce(nome_completo" in plan(whole)
        hashed = build_fact(sales, dims, complete=True).drop("venda_id")
        assert "nome_completo" not in "".join(re.findall(r"SortMergeJoin.*", plan(hashed)))
        assert hashed.exceptAll(whole).isEmpty() and whole.exceptAll(hashed).isEmpty()
        # where two keys share a hash, whole keys are compared
        monkeypatch.setattr(star, "hash_id", lambda columns: F.lit(1).cast("long"))
        assert "SortMergeJoin [coalesce(nome_completo" in plan(build_fact(sales, dims, complete=True))


def test_few_partitions_are_written_without_a_sort(spark, tmp_path):
    """Gold rows come gathered; Spark's own sort of them spilled. Written files are of the smaller codec."""
    from retalake import session

    write_silver(to_silver(bronze(spark, sale(), sale(nome="Bia"))), f"{tmp_path}/silver")
    seen = []
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with session.open_partitions(spark):
        seen.append(int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
    assert seen[0] > 7 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    write_gold(to_gold(read_silver(spark, f"{tmp_path}/silver")), f"{tmp_path}/gold")
    files = read_gold(spark, f"{tmp_path}/gold").inputFiles() + read_silver(spark, f"{tmp_path}/silver").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_shuffles_of_a_layer_are_gone_after_it_is_written(spark, tmp_path):
    import time

    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles()) if f.getName().startswith("shuffle_")}

    before = shuffles()
    write_silver(to_silver(bronze(spark, sale(), sale(nome="Bia"))), f"{tmp_path}/silver")
    end = time.time() + 20
    while shuffles() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffles() - before


def test_sales_written_after_the_joins_are_the_same(spark):
    with Scratch(spark) as scratch:
        written = raw_sales(spark, SF_DIR, scratch)
        lazy = raw_sales(spark, SF_DIR)
        assert written.columns == lazy.columns
        assert written.exceptAll(lazy).isEmpty() and lazy.exceptAll(written).isEmpty()
        assert "Join" not in plan(written)


def test_lookups_that_multiply_sales_come_last(spark, gold, monkeypatch):
    with Scratch(spark) as scratch:
        dims = written_dims(gold, scratch)
        looked, lookup = [], star._lookup
        monkeypatch.setattr(star, "_lookup", lambda sales, rows, dim, legacy: looked.append(dim.table) or lookup(sales, rows, dim, legacy))
        build_fact(gold, dims, legacy_keys=True)
    assert len(looked) == len(DIMENSIONS)
    assert looked[-2:] == ["dim_cliente", "dim_desconto"]


def test_few_contacts_are_broadcast_whatever_the_threshold(spark, gold):
    with Scratch(spark) as scratch, session_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        fact = build_fact(gold, written_dims(gold, scratch), complete=True)
        assert plan(fact).count("BroadcastHashJoin") == 1  # of the seven, only contacts have a key of several texts


def test_copies_across_files_are_the_same_slice_by_slice(spark):
    new = to_silver(bronze(spark, *(sale(valor=str(k)) for k in range(40)), source="b"))
    new = new.union(to_silver(bronze(spark, *(sale(valor=str(k), vendedor=None) for k in range(20)), source="c")))
    new = new.union(to_silver(bronze(spark, *(sale(valor=str(k)) for k in range(30, 50)), source="a")))
    history = to_silver(bronze(spark, *(sale(valor=str(k)) for k in range(5)), source="old"))
    whole = across_files(new, history)
    with Scratch(spark) as scratch:
        sliced = across_files(new, history, scratch)
        assert sorted(sliced.collect(), key=str) == sorted(whole.collect(), key=str)
        assert whole.count() == 50 - 5 + 20
