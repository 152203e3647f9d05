"""The rest of the library stands without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [["wayloom/llm"], ["wayloom/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_imports_without_training_data(tmp_path, gone):
    skipped = shutil.ignore_patterns(".git", "__pycache__", "tests", *(Path(g).name for g in gone))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skipped)
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), 'op3_jaccard_join' in e.queries())"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
    count, pipeline, joins = done.stdout.split()
    assert int(count) >= 59 and pipeline == "False"
    assert joins == str("wayloom/llm" not in gone)
