import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from coffer.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))

    return collect
