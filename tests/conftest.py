import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quarry.session import get_session

    shared = str(tmp_path_factory.mktemp("shared"))
    s = get_session("local[*]", app_name="quarry-tests", shuffle_partitions=8, extra={"spark.checkpoint.dir": shared})
    yield s
    s.stop()
