from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

os.environ["TZ"] = "UTC"
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import tallywake  # noqa: E402
from tallywake.session import local_session  # noqa: E402

cloudpickle.register_pickle_by_value(tallywake)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
