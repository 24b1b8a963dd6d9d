import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from claimlens.session import get_session
    s = get_session("local[4]", 8, app_name="claimlens-tests")
    yield s


@pytest.fixture(scope="session")
def lines(spark):
    """Scored v6 line table (internal form) at sf0.001, materialised once."""
    from claimlens.plans.v6 import TEST_CONFIG, materialized_lines
    return materialized_lines(spark, SF_SMALL, TEST_CONFIG)


@pytest.fixture(scope="session")
def lines_pdf(spark):
    from claimlens.plans.queries import all_queries
    return all_queries()["v6_lines"](spark, SF_SMALL).toPandas()
