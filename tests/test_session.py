import os
import subprocess
import sys
from pathlib import Path

import pytest

from objsync import session

REPO = Path(__file__).resolve().parents[1]


class Conf(dict):
    def get(self, name, default=None):
        return super().get(name, default)


class Fake:
    def __init__(self, **conf):
        self.conf = Conf({name.replace("__", "."): value for name, value in conf.items()})


def test_configured_folder_is_used():
    assert session.shared_folder(Fake(**{"spark.checkpoint.dir": "hdfs://x/shared/"})) == "hdfs://x/shared"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake(**{"spark.master": "yarn"}))


def test_a_local_session_may_do_without():
    folder = session.shared_folder(Fake(**{"spark.master": "local[2]"}))
    assert folder == session.shared_folder(Fake(**{"spark.master": "local[2]"}))


def test_tuned_settings(spark):
    session.tune(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_workers_need_not_have_the_package(tmp_path):
    """Run from elsewhere, with the package on the path of the driver alone."""
    script = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from objsync.plans.queries import CATALOG
from objsync.session import local_session
spark = local_session(2, "elsewhere", 2)
for name in ("normalize_chunks", "transform_map_in_pandas", "stream_sync"):
    assert not CATALOG[name](spark, "/root/testdata/sf0.001").isEmpty(), name
spark.stop()
print("fine")
"""
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
