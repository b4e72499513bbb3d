import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from starmart.session import get_session

    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
