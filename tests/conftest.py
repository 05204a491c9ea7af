import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gondola.session import checkpoint_dir, get_session

    s = get_session("local[4]", shuffle_partitions=4, app="gondola-tests",
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="gondola-test-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):   # tests only: no cluster-provided folder
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="gondola-test-ckpt-"))
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from oracle_check import duck_conn

    return duck_conn(SF_SMALL)
