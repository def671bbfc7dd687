import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from seqlake.session import CHECKPOINT_DIR, build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", **{
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        CHECKPOINT_DIR: str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a text table from dicts; absent keys are ''."""
    def build(records, columns=None):
        columns = columns or sorted({c for r in records for c in r})
        schema = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame([[r.get(c, "") for c in columns] for r in records], schema)
    return build
