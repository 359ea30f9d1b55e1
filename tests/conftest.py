import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.config import session

    s = session("*", shuffle_partitions=8, app="quarry-tests")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def plan_text(df) -> str:
    """``explain("formatted")`` text of the initial physical plan (what AQE starts from)."""
    from quarry.operators import plan_string

    return plan_string(df, "formatted")
