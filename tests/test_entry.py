"""The entry module without the training-data folders."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT


def test_entry_works_without_the_llm_folders(scratch):
    copy = os.path.join(scratch, "copy")
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    for gone in (skip, shutil.ignore_patterns("llm", ".git", "__pycache__")):
        target = f"{copy}-{gone is skip}"
        shutil.copytree(ROOT, target, ignore=gone)
        code = "import __spark_entry__ as e; assert e.queries() and set(e.queries()) == set(e.oracle_sql())"
        subprocess.run([sys.executable, "-c", code], cwd=target, check=True, env=os.environ | {"PYTHONPATH": target})
