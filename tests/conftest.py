import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from anchorage import session

    builder = (
        session.builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    built = builder.getOrCreate()
    if built.conf.get("spark.checkpoint.dir", None) is None:
        built.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="anchorage-tests-"))
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture
def frame(spark):
    """frame("a long, b string", (1, "x"), ...) -> DataFrame"""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: takes more than a few seconds")
