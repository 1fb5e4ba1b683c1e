"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="trend_slope,match_canonical")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and isinstance(d["value"], float)
    assert set(d["queries"]) == {"trend_slope", "match_canonical"}
    assert abs(sum(d["queries"].values()) - d["value"]) < 0.01
