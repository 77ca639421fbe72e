import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from earshot.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Force the shuffled, salted joins that large lookups take."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
