"""The entry without the text operators."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))
KEYS = """
import os, sys
os.environ["PYTHONPATH"] = ""
import __spark_entry__ as entry
assert entry.queries().keys() == entry.oracle_sql().keys() == entry._log_queries().keys()
print(len(entry.queries()), entry.__file__)
"""


def test_queries_without_the_text_operators(tmp_path):
    """With both folders gone, with or without the pipeline's file, the queries of the logs are there."""
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "daygauge"), copy / "daygauge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy)
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    for _ in range(2):
        run = subprocess.run([sys.executable, "-c", KEYS], cwd=copy, env=env, capture_output=True, text=True)
        assert run.returncode == 0, run.stderr
        count, place = run.stdout.split()
        assert int(count) == len(entry._log_queries()) and place.startswith(str(copy))
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
