import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martwright.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over one text column `c`."""

    def run(expression, *values):
        df = spark.createDataFrame([(v,) for v in values], "c string")
        return [row[0] for row in df.select(expression.alias("out")).collect()]

    return run


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
