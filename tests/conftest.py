import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for the stream's own Python processes


@pytest.fixture(scope="session")
def spark():
    from keyloom.session import local_session, ship_package

    os.environ.setdefault("BENCH_CPUS", "4")
    s = local_session("keyloom-tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    })
    ship_package(s)
    yield s
