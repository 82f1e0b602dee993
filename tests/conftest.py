import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from check_oracle import session

    return session()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def many_parts(spark):
    """Shuffles of a fixed number of partitions, which are not coalesced."""
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def use(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    yield use
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
