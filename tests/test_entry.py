"""The entry module without the optional subpackage or one of its libraries."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import importlib.abc, sys
class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
from quarry.plans.catalog import QUERIES
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) <= set(QUERIES)
"""


@pytest.mark.parametrize("name", ["quarry.llm", "corpus_pipeline", "public_tokenizers", "numpy"])
def test_core_queries_stay_when_a_library_is_missing(name):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(name=name, root=ROOT)], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
