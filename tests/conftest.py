import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pharmaflow.session import get_spark
    import tempfile
    s = get_spark("local[*]", app="pharmaflow-tests", shuffle_partitions=8,
                  extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="pf-warehouse-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
