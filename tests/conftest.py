from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retalake.plans.jobs import Lake  # noqa: E402
from retalake.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", "4g")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path) -> Lake:
    """Empty lake with a database of its own."""
    database = f"vendas_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/warehouse'")
    return Lake(f"{tmp_path}/lake", database)
