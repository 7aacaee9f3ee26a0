import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from landstage.session import local_session
    s = local_session("*", shuffle_partitions=8, app="landstage-tests",
                      extra={"spark.driver.memory": "4g"})
    yield s
