"""bench.py runs and prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="conformity_by_group,silver_layer,gold_gate,medallion_run")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         timeout=1800, check=True, env=env).stdout.strip().splitlines()
    assert len(out) == 1
    r = json.loads(out[0])
    assert r["unit"] == "sec" and r["sf"] == 0.001 and r["value"] > 0
    assert set(r["queries"]) == {"conformity_by_group", "silver_layer", "gold_gate", "medallion_run"}
