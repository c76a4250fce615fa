import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexloom.session import session

    shared = tmp_path_factory.mktemp("shared")
    s = session("local[4]", 4, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": str(shared / "warehouse"), "spark.driver.memory": "3g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
