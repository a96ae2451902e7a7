import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from twinrow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "twinrow-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """JSON record frame from a list of texts."""
    from twinrow.functions.render import parse_record

    def make(texts, strict=True):
        frame = spark.createDataFrame([(t,) for t in texts], "value string")
        return frame.withColumn("v", parse_record("value", strict))

    return make


@pytest.fixture
def folder():
    """A new scratch folder."""
    import tempfile

    return tempfile.mkdtemp(prefix="run-")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
