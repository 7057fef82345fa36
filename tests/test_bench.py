"""The bench contract: one JSON line with metric, value, unit, per-query seconds and sf."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(sf_dir):
    env = dict(os.environ, BENCH_SF_DIR=sf_dir, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "pear_best_submission"], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["metric"] == "total_sec"
    assert set(result["queries"]) == {"pear_best_submission"} and result["value"] > 0
    assert result["sf"] == os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
