import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tastegraph.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield s
    s.stop()


def ratings_df(spark, rows):
    """rows: (userId, productId, score, timestamp)"""
    from tastegraph.schemas import RATING

    return spark.createDataFrame([tuple(r) for r in rows], RATING)


def history_df(spark, rows):
    """rows: (userId, productId, score, timestamp, seq)"""
    from tastegraph.schemas import RATING_EVENT

    return spark.createDataFrame([tuple(r) for r in rows], RATING_EVENT)
