"""Task failures are retried to the same result: silver and gold are deterministic plans.

Runs ``probes/retry_probe.py`` in its own Spark application with task retries enabled.
"""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_ORACLE


def test_retried_tasks_give_the_same_tables():
    probe = os.path.join(ROOT, "tests", "probes", "retry_probe.py")
    out = subprocess.run(
        [sys.executable, probe, ROOT, SF_ORACLE], capture_output=True, text=True, timeout=1800, check=True
    ).stdout.strip().splitlines()[-1]
    r = json.loads(out)
    assert r["injected_failures"] >= 1
    assert r["silver_rows"] > 0 and r["gold_rows"] > 0  # the run without failures, which the other must equal
    assert r["silver_same"] and r["gold_same"]
