"""The registry engine stands alone: a copy of the repository without the document operators has all its queries."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.support import ROOT

PROBE = """
import __spark_entry__ as e
names, sql = e.queries(), e.oracle_sql()
assert len(names) >= 85 and set(sql) <= set(names), len(names)
assert not [n for n in names if n.startswith("op") and n[2].isdigit()] and "pipeline" not in names
"""


@pytest.mark.parametrize("pipeline_file", [True, False])
def test_entry_without_the_document_operators(tmp_path, pipeline_file):
    left_out = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(os.path.join(ROOT, "firmweave"), tmp_path / "firmweave", ignore=left_out)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    if pipeline_file and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
