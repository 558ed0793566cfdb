from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sessionloom.session import local_session

    spark = local_session("8", 4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")))
    yield spark
    spark.stop()
