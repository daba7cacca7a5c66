"""Python workers find the package although the session starts in another folder."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])
CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
from landlens.session import local_session
spark = local_session(2, 2, memory="2g")
from landlens.plans.queries import QUERIES
print("rows", QUERIES["geo_overlap_area"](spark, "/root/testdata/sf0.001").count())
"""


def test_arrow_kernels_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert int(run.stdout.split()[-1]) > 0
