import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tenderloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("TENDERLOOM_SCRATCH", str(tmp_path_factory.mktemp("scratch")))
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4",
                            spark__ui__showConsoleProgress="false",
                            spark__sql__maxMetadataStringLength="10000", spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def values(spark, rows, expression, ddl="x string"):
    """Results of a column expression over one-column rows, in row order."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, " + ddl)
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]
