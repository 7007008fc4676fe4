"""All training-data queries with Python workers that do not have the package on their path."""

import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]


def test_workers_need_no_package(tmp_path):
    code = f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        import __spark_entry__ as entry
        from lonja.session import build_session
        spark = build_session("away", "4", 4)
        for name, query in entry.queries().items():
            if name.startswith("op") or name == "pipeline":
                print("DONE", name, query(spark, "/root/testdata/sf0.001").count() > 0, flush=True)
    """
    (tmp_path / "away.py").write_text(textwrap.dedent(code))
    done = subprocess.run([sys.executable, "away.py"], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("DONE") >= 14 and "False" not in done.stdout
