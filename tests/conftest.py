import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")


@pytest.fixture(scope="session")
def spark():
    from gneiss.session import get_spark

    s = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": 4, "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows():
    """The rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
