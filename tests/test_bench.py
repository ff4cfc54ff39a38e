"""bench.py prints one JSON line with the keys the driver records."""

import json
import os
import subprocess
import sys

from conftest import ROOT, sf_dir


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=sf_dir("0.001"), BENCH_CPUS="2", BENCH_RUNS="1", BENCH_WARMUPS="0",
               BENCH_QUERIES="r2_daily_orders,r6_lapsed", BENCH_DRIVER_MEMORY="1g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         timeout=600, env=env, cwd=str(tmp_path))
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"r2_daily_orders", "r6_lapsed"}
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-3
