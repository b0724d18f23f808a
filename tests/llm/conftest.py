from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from retalake.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    yield local_session("tests", "8", "4g")


@pytest.fixture
def texts(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators might use themselves."""

    def make(*rows, lang="en"):
        data = [(i, t, lang, "s", None if t is None else len(t), "x", 1) for i, t in rows]
        return spark.createDataFrame(
            data, "doc_id long, text string, lang string, source string, n_chars long, spans string, text_key int"
        )

    return make
