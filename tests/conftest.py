import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tessella.session import session  # noqa: E402
from tessella.shipping import ship  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    s = session("tests", "local[4]", 4, **{"spark.ui.enabled": "false", "spark.checkpoint.dir": f"file://{folder}", "spark.sql.warehouse.dir": str(folder / "warehouse"), "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield ship(s)
    s.stop()
