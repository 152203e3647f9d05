"""The entry takes the pipeline beside it, not that of another copy on the search path."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_pipeline_is_the_one_beside_the_entry(tmp_path):
    for name in ("__spark_entry__.py", "oracles.py"):
        shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; print('pipeline' in e.queries(), 'op3_jaccard_join' in e.queries())"
    env = os.environ | {"PYTHONPATH": str(ROOT)}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert done.stdout.split() == ["False", "True"]
