"""Shared local Spark session for the test suite.

Tests run in local mode, where ``spark.checkpoint.dir`` is unset; a fresh folder from
pytest's temp factory is registered as the shared checkpoint root.
"""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import get_spark
    ckpt = tmp_path_factory.mktemp("ckpt")
    s = get_spark("local[4]", app="tidemark-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": str(ckpt)})
    s.sparkContext.setCheckpointDir(str(ckpt))
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
