import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from archivolt.runtime import local_session

    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def column(spark):
    """Evaluate a column function on a list of texts."""
    from pyspark.sql import functions as F

    def run(function, values, schema="v string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
        return [r[0] for r in df.select("i", function(F.col("v")).alias("r")).orderBy("i").select("r").collect()]

    return run
