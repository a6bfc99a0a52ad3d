import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cartwise.session import get_spark
    s = get_spark("local[4]", app="cartwise-tests",
                  conf={"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false",
                        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_SF
