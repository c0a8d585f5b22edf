import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from riskweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", 8, spark__checkpoint__dir=str(tmp_path_factory.mktemp("work")))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as a list of dicts."""
    return lambda df: [r.asDict(recursive=True) for r in df.collect()]
