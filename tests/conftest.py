import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strataline.plans.session import build

    session = build("local[4]", 4, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "3g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
