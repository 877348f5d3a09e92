"""The entry without the optional training-data operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import __spark_entry__ as entry
from wardstar.session import build_session
assert not [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()], "operators without their package"
assert "pipeline" not in entry.queries()
assert len(entry.queries()) > 70
spark = build_session("entry", "local[2]", 2)
assert entry.queries()["normalise_text"](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_entry_without_the_training_data_operators(tmp_path):
    left_out = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache")
    copy = shutil.copytree(REPO, tmp_path / "copy", ignore=left_out)
    done = subprocess.run([sys.executable, "-c", RUN], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
