import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tempora.session import get_session
    wh = tempfile.mkdtemp(prefix="tempora-wh-")
    s = get_session("local[8]", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.sql.warehouse.dir": wh})
    s.sparkContext.setLogLevel("ERROR")
    yield s
