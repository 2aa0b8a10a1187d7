"""bench.py prints exactly one JSON line in the driver's format."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_output_contract():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_WARM_DIR="/nonexistent")
    out = subprocess.run(
        [sys.executable, "bench.py", "trending_windows"], cwd=ROOT, env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] and result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"trending_windows"} and result["value"] > 0
