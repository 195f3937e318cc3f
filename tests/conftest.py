import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import os

    os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
    from eocube.session import session

    s = session("tests", cores=4, **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def cube(spark):
    """rows of (time text, y, x, band values ...) and band names as a pixel table."""

    def make(rows, bands):
        schema = "t string, y double, x double, " + ", ".join(f"{b} double" for b in bands)
        return spark.createDataFrame(rows, schema).selectExpr("cast(t as timestamp_ntz) as time", "y", "x", *bands)

    return make
