"""Operators give the same rows when tasks fail and run again."""

import json
import os
import subprocess
import sys

import pytest


@pytest.mark.parametrize("names", [["packing", "suffix_dedup", "token_output", "jaccard_join", "line_dedup"],
                                   ["minhash_dedup", "prefix_trie", "spelling_variants"],
                                   ["decontamination", "license_scan", "quality_rules"]])
def test_operators_survive_failed_tasks(sf_small, names):
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "lost_tasks.py")
    done = subprocess.run([sys.executable, script, sf_small, *names], capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    same = json.loads(done.stdout.strip().splitlines()[-1])
    assert list(same) == names and all(same.values()), same
