import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from plumbline.session import build_session

    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = build_session(
        "plumbline-tests", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
           "spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    return session
