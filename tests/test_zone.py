"""Stamps mean the same on a machine in another zone."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = ["closed_time_range", "half_open_slice", "strictly_newer", "slice_loaded", "newer_rows_appended", "journal_row_of_a_load", "readiness_gate", "snapshot_load", "demand_chains"]


def test_queries_in_another_zone(tmp_path):
    done = subprocess.run(
        [sys.executable, "-m", "workload.check", "0.001", *NAMES], cwd=ROOT, env=os.environ | {"TZ": "America/New_York"}, capture_output=True, text=True, timeout=600, check=False
    )
    assert f"{len(NAMES)} of {len(NAMES)} agree" in done.stdout, done.stdout[-3000:]
