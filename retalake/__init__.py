"""Retail sales lakehouse on PySpark: landing files to silver, gold and a star schema."""

from retalake.operators.gold import to_gold
from retalake.operators.silver import to_silver
from retalake.operators.star import build_dim, build_fact, rebuild_star
from retalake.plans.jobs import run_batch
from retalake.sources.landing import read_bronze, stream_bronze
from retalake.streaming.ingest import run_stream

__all__ = [
    "build_dim",
    "build_fact",
    "read_bronze",
    "rebuild_star",
    "run_batch",
    "run_stream",
    "stream_bronze",
    "to_gold",
    "to_silver",
]
