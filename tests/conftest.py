import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitpanel import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="pitpanel-tests", shuffle_partitions=4)
    yield s


@pytest.fixture()
def tmpdir_uri(spark):
    """A fresh folder under the session's checkpoint folder."""
    from pitpanel.session import work_dir
    return work_dir(spark, "test")
