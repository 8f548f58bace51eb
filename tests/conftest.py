import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from scoreloom.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        "scoreloom-tests",
        **{
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def plan_of():
    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
