import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataflow.catalog import load_all  # noqa: E402
from strataflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    load_all()
    s = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
