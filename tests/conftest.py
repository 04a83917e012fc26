import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import build_session

    root = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.ui.enabled": "false", "spark.checkpoint.dir": str(root / "shared"),
        "spark.sql.warehouse.dir": str(root / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
