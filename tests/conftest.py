import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from moodline.session import CHECKPOINT_DIR, build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            CHECKPOINT_DIR: str(tmp_path_factory.mktemp("stages")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
