import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
os.environ.setdefault("OMP_NUM_THREADS", "1")
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cytoframe.session import session

    s = session("tests", "local[8]", spark__driver__memory="6g", spark__ui__enabled="false", spark__sql__shuffle__partitions="4", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")), spark__sql__autoBroadcastJoinThreshold="1m")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
