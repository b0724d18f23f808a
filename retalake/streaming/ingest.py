"""Landing files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from retalake.plans.jobs import MAX_BYTES, Lake, load_files, load_new
from retalake.session import Scratch, folder_exists
from retalake.sources.landing import ADMITTED_FILES, landing_root, stream_arrivals


def run_stream(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    files: str = ADMITTED_FILES,
    stamped: bool = True,
    strict: bool = False,
    max_files: int = 1000,
    every: str | None = None,
    max_bytes: int = MAX_BYTES,
) -> StreamingQuery:
    """Load files as they arrive, up to the staging table.

    A micro-batch of at most ``max_files`` files is a load, or several of at most ``max_bytes``.

    The stream tells which files have come and opens none; the load reads them and records each in the lake's ledger,
    which decides what is new. So a batch that runs again, or a batch run besides, loads nothing twice. A file lies
    wholly in one micro-batch and rows are deduplicated per file, so no state is kept between batches. Without
    ``every`` the query ends when all present files are loaded.

    The stream's checkpoint remembers files by path, whatever they held. So files that the ledger lacks although their
    path may be known, those that have changed or had no byte at first, are loaded before a stream goes on that has
    run before, and with ``every`` after each batch. Malformed lines and files with another header are left out as
    in :func:`retalake.plans.jobs.run_batch`; with ``strict`` they fail the query.
    """
    root = landing_root(spark, landing)

    def load(batch: DataFrame, batch_id: int) -> None:
        with Scratch(spark) as tables:
            batch.write.parquet(tables.path("arrivals"))
            arrivals = spark.read.schema(batch.schema).parquet(tables.path("arrivals"))
            while load_files(spark, lake, arrivals, root, stamped, strict, max_bytes) is not None:
                pass
        if every:
            load_new(spark, landing, lake, files, stamped, strict, max_files, max_bytes)

    if folder_exists(spark, checkpoint):
        load_new(spark, landing, lake, files, stamped, strict, max_files, max_bytes)
    arriving = stream_arrivals(spark, landing, files, stamped, max_files)
    writer = arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
