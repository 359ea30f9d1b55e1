"""Answers survive failed and retried tasks (run in a separate local[4,3] session)."""

import json
import os
import subprocess
import sys


def test_answers_survive_task_retries(sf_small):
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "retry_check.py"), sf_small], capture_output=True,
                         text=True, timeout=600, check=True)
    rec = json.loads([line for line in out.stdout.splitlines() if line.startswith("{")][-1])
    assert rec == {"row_numbers_equal": True, "fastest_equal": True}
