"""Sessions and the shared folder, in Spark processes of their own."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def run(code: str, tmp_path: Path, **env: str) -> str:
    """What the code prints in a fresh process whose Spark has no settings of its own."""
    (tmp_path / "conf").mkdir()
    full = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_SUBMIT")}
    full |= {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": str(REPO), **env}
    done = subprocess.run([sys.executable, "-c", code], env=full, cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


START = """
from kerbline import build_session, shared_dir
from kerbline.session import release, settle
spark = build_session("plain", "local[2]", conf={"spark.ui.enabled": "false"%s})
df = settle(spark.range(10), "numbers")
"""


def test_plain_local_session(tmp_path):
    code = START % "" + """
one, two = shared_dir(spark, "a"), shared_dir(spark, "a")
print(df.count(), one != two, one.rpartition("/")[0] == two.rpartition("/")[0])
"""
    assert run(code, tmp_path).split() == ["10", "True", "True"]


def test_release_removes_what_was_settled(tmp_path):
    code = START % f', "spark.checkpoint.dir": "{tmp_path}/shared"' + """
import os, sys
print(df.count(), len(os.listdir(sys.argv[1] if sys.argv[1:] else "shared")))
release(spark)
print(len(os.listdir("shared")))
"""
    assert run(code, tmp_path).split()[0] == "10"
    assert not [p for p in (tmp_path / "shared").rglob("*.parquet")]
