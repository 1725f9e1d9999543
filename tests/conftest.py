from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meridia.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": folder})
    yield session
    session.stop()
