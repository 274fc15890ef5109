import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martline.session import build_session
    s = build_session("martline-tests", cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    from martline.session import scratch_path
    return scratch_path(spark, f"tests/{request.node.name}")


@pytest.fixture()
def scratch_of(spark):
    """Scratch folders of cases with parameters, whose brackets Spark would take for a pattern."""
    from martline.session import scratch_path
    return lambda name: scratch_path(spark, f"tests/{name}")
