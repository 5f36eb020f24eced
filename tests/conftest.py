import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickframe.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4,
                  extra={"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    # Without spark.checkpoint.dir, tickframe.session.shared_dir falls back to a
    # fresh scratch folder (tests on one machine only).
    yield s
    s.stop()
