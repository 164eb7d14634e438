"""Retry probe (run as a subprocess by tests/test_retry.py; argv: repo root, sf dir).

A Spark application that allows task retries (``local[4,3]``) builds and stages silver and the gold
aggregate twice: once normally, once with the first attempt of one scan task killed by an injected
error.  Deterministic plans mean the retried task recomputes the same rows; prints one JSON line.
"""

import json
import os
import sys
import tempfile

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from hydrix import bindings as B  # noqa: E402
from hydrix.plans.gold import category_is, gold_aggregate  # noqa: E402
from hydrix.plans.silver import build_silver  # noqa: E402
from hydrix.session import stage  # noqa: E402

spark = (
    SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")


MARKS = tempfile.mkdtemp(prefix="hydrix-retry-")


def flaky(it):
    # test-only fault injection: the first attempt of partition 0 dies after reading its input
    ctx = TaskContext.get()
    batches = list(it)
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        open(os.path.join(MARKS, f"failed-stage{ctx.stageId()}"), "w").close()
        raise RuntimeError("injected task failure")
    yield from batches


def run(fail: bool):
    raw = B.m_view(spark, sys.argv[2]).repartition(4, "event_id")
    if fail:
        raw = raw.mapInArrow(flaky, raw.schema)
    silver = stage(build_silver(raw, B.SILVER_SPEC), "retry-silver")
    gold = stage(gold_aggregate(silver, category_is()), "retry-gold")
    key = lambda df: sorted(map(repr, df.collect()))
    return key(silver), key(gold)


clean_silver, clean_gold = run(False)
retry_silver, retry_gold = run(True)
print(json.dumps({
    "silver_rows": len(clean_silver), "gold_rows": len(clean_gold),
    "silver_same": clean_silver == retry_silver, "gold_same": clean_gold == retry_gold,
    "injected_failures": len(os.listdir(MARKS)),
}))
