"""The shared folder, and Python workers without the package on their path."""

import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

from lonja import session

ROOT = Path(__file__).resolve().parents[1]


class Conf:
    def __init__(self, **values):
        self.conf = self
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)


def test_folder_is_demanded_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.work_folder(Conf(spark_master=master), "x")
    assert session.work_folder(Conf(spark_master="yarn", spark_checkpoint_dir="hdfs:///c/"), "x").startswith("hdfs:///c/lonja/x-")
    for master in ("local", "local[8]", "local[*]", "local[2,3]"):
        assert session.work_folder(Conf(spark_master=master), "x")


def test_workers_need_no_package_on_their_path(tmp_path):
    """Started elsewhere, with the package on the driver's path only."""
    code = f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        from lonja.session import build_session
        from lonja.plans.queries import QUERIES
        spark = build_session("away", "2", 2)
        print("ROWS", QUERIES["scan_orders_csv"](spark, "/root/testdata/sf0.001").count())
        print("FILES", QUERIES["source_fingerprint"](spark, "/root/testdata/sf0.001").count())
    """
    (tmp_path / "away.py").write_text(textwrap.dedent(code))
    done = subprocess.run([sys.executable, "away.py"], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS 6067" in done.stdout and "FILES 1" in done.stdout, done.stderr[-2000:]
