import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusprep.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate one Column over texts and return the results in input order."""
    from pyspark.sql import functions as F

    def run(texts, expression, schema="i int, v string"):
        df = spark.createDataFrame(list(enumerate(texts)), schema)
        rows = df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
        return [row.r for row in rows]

    return run
