import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    from echoloom.session import configure
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture
def store(spark):
    from echoloom.session import scratch
    from echoloom.tables import Store
    return Store(spark, scratch(spark, "test"), buckets=4).bootstrap()


@pytest.fixture
def feedback(spark):
    """Canonical rows from short tuples (source, id, user, text, rating, time)."""
    from echoloom import schemas as S

    def make(*rows):
        import datetime as dt
        full = []
        for source, key, user, text, rating, when in rows:
            at = dt.datetime.fromisoformat(when) if isinstance(when, str) else when
            full.append((source, key, user, text, rating, at, None, None))
        return spark.createDataFrame(full, S.CLEAN)
    return make
