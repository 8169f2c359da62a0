import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerloom.session import session, ship

    s = session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.sql.legacy.javaCharsets": "true",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield ship(s)
    s.stop()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
