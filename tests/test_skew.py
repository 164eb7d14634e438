"""A key or a place holding a third of the rows crosses the shuffle as one row per map task.

Runs ``probes/skew_probe.py`` in its own Spark application (event log on) and checks the shuffle
record counts it reports.
"""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_ORACLE


def test_hot_keys_are_reduced_before_the_shuffle():
    probe = os.path.join(ROOT, "tests", "probes", "skew_probe.py")
    out = subprocess.run(
        [sys.executable, probe, ROOT, SF_ORACLE], capture_output=True, text=True, timeout=1800, check=True
    ).stdout.strip().splitlines()[-1]
    r = json.loads(out)
    assert r["hot_key_rows"] > r["rows"] / 4
    # dedup: the hot key ships at most one row per map task
    assert r["silver_shuffle_written"] <= r["rows"] - r["hot_key_rows"] + r["map_tasks"]
    # gold: partial aggregation ships at most one row per group and map task, not one per row
    assert r["big_rows"] > r["silver_rows"] / 3
    assert r["gold_shuffle_written"] <= r["gold_groups"] * r["silver_files"]
    assert r["gold_shuffle_written"] < r["silver_rows"]
    # and the hot group's result is whole
    assert r["big_total"] == r["big_rows"]
