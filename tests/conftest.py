import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TIDEMARK_TESTDATA", "/root/testdata/sf0.001")
TIGHT = {"spark.tidemark.hotRows": "32", "spark.tidemark.broadcastRows": "5"}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def tight(spark):
    """Limits so small that test data takes the split and unbroadcast ways."""
    for name, value in TIGHT.items():
        spark.conf.set(name, value)
    yield spark
    for name in TIGHT:
        spark.conf.unset(name)
