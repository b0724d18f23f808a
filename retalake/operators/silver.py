"""Bronze text to silver: types, deduplication, defaults, year."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from retalake.functions.columns import comma_decimal, exact_money, percent_fraction, sale_timestamp
from retalake.schemas import SILVER, SILVER_EXACT, SILVER_SOURCE, SILVER_YEAR
from retalake.session import Scratch

# What stands in for missing values.
DEFAULTS = {
    "Desconto Oferecido": 0,
    "Código de Desconto Usado": "NÃO DISPONÍVEL",
    "Vendedor": "NÃO INFORMADO",
}


def typed(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Give the timestamp, value and discount columns their types, and add the exact value."""
    return bronze.withColumns(
        {
            SILVER_EXACT: exact_money(F.col("Valor da Compra"), strict),
            "Timestamp do Registro": sale_timestamp(F.col("Timestamp do Registro"), strict),
            "Valor da Compra": comma_decimal(F.col("Valor da Compra"), strict),
            "Desconto Oferecido": percent_fraction(F.col("Desconto Oferecido"), strict),
        }
    )


def deduplicated(sales: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows of the same source file.

    The source column is part of the row, so equal sales of two files stay
    apart. Every task first drops the copies it holds, so that a row with
    very many copies reaches the shuffle once per task.
    """
    return sales.dropDuplicates()


#: Slices, by the hash of their texts, in which :func:`across_files` compares rows when it may write them.
SLICES = 4


def across_files(new: DataFrame, history: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Silver rows without copies in other files: of equal sales of several sources the one of the least name stays.

    With ``history``, silver rows of earlier loads, sales that these hold are left out as well. Only digests meet:
    the history is reduced to those that the new rows have at all, by a semi join whose filter Spark pushes into the
    history's scan, before the anti join decides. For batches; a stream keeps to single files. What is left out
    because of an earlier file does not come back when that file is corrected without it. With ``scratch`` each step is
    written before the next one, and the first one slice by slice, each reading all of ``new``: only the shuffle of one
    of them stands on the disks at a time. Equal rows share a slice.
    """
    content = [c for c in new.columns if c != SILVER_SOURCE]

    def least(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*(F.col(f"`{c}`") for c in content)).agg(F.min(F.col(f"`{SILVER_SOURCE}`")).alias(SILVER_SOURCE))

    if scratch:
        texts = [F.col(f"`{c}`") for c in content if isinstance(new.schema[c].dataType, StringType)]
        piece = F.pmod(F.xxhash64(*texts), F.lit(SLICES))
        first = reduce(DataFrame.union, [scratch.save(least(new.where(piece == k)), f"first-{k}") for k in range(SLICES)])
    else:
        first = least(new)
    if history is None:
        return first.select(*(f"`{c}`" for c in new.columns))
    digest = F.unhex(F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in content)), {"ignoreNullFields": "false"}), 256))
    marked = first.withColumn("_digest", digest)
    known = history.select(digest.alias("_digest")).join(marked.select("_digest"), "_digest", "left_semi").distinct()
    if scratch:
        known = scratch.save(known, "known")
    return marked.join(known, "_digest", "left_anti").select(*(f"`{c}`" for c in new.columns))


def defaults_filled(sales: DataFrame) -> DataFrame:
    return sales.fillna(DEFAULTS)


def with_year(sales: DataFrame) -> DataFrame:
    return sales.withColumn(SILVER_YEAR, F.year("Timestamp do Registro"))


def to_silver(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """All silver steps over bronze rows that carry their source file."""
    clean = defaults_filled(deduplicated(typed(bronze, strict)))
    return with_year(clean).select(*SILVER.names)
