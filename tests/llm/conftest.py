import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(autouse=True, scope="session")
def workers_find_the_package(spark):
    from __spark_entry__ import _prepare

    _prepare(spark)
