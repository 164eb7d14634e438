"""Skew probe (run as a subprocess by tests/test_skew.py; argv: repo root, sf dir).

From the measurement view of ``events``: a third of the rows get one and the same dedup key
(sample, parameter, date), another third one and the same place with distinct keys.  Over eight map
tasks, the silver dedup and the one-pass gold aggregate run with the Spark event log on; the log
gives the records each job wrote to its shuffle.  Prints one JSON line.
"""

import glob
import io
import json
import sys
import tempfile

import zstandard

sys.path.insert(0, sys.argv[1])

from pyspark.sql import functions as F  # noqa: E402

from hydrix import bindings as B  # noqa: E402
from hydrix.plans.gold import category_is, gold_aggregate  # noqa: E402
from hydrix.plans.silver import build_silver  # noqa: E402
from hydrix.session import local_session, stage  # noqa: E402

MAP_TASKS = 8
sf_dir = sys.argv[2]
log_dir = tempfile.mkdtemp(prefix="hydrix-evlog-")
spark = local_session(
    4,
    shuffle_partitions=MAP_TASKS,
    extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
           "spark.sql.adaptive.enabled": "false"},
)
sc = spark.sparkContext
hot_key = F.col("event_id") % 3 == 0
hot_place = F.col("event_id") % 3 == 1
m = (
    B.m_view(spark, sf_dir)
    .withColumn("code_prelevement", F.when(hot_key, F.lit("HOT")).otherwise(F.col("code_prelevement")))
    .withColumn("code_parametre", F.when(hot_key, F.lit("X0")).otherwise(F.col("code_parametre")))
    .withColumn("date_prelevement", F.when(hot_key, F.lit("2024-01-01T00:00:00Z")).otherwise(F.col("date_prelevement")))
    .withColumn("nom_commune", F.when(hot_key | hot_place, F.lit("BIG")).otherwise(F.col("nom_commune")))
    .withColumn("libelle_parametre", F.coalesce("libelle_parametre", F.lit("pH")))
    .withColumn("code_prelevement", F.coalesce("code_prelevement", F.lit("P-none")))
)
raw = stage(m.repartition(MAP_TASKS), "skew-raw")  # eight input files -> eight map tasks
n_rows = raw.count()
n_hot_key = raw.filter(F.col("code_prelevement") == "HOT").count()

sc.setJobGroup("silver", "silver dedup")
silver = stage(build_silver(raw, B.SILVER_SPEC), "skew-silver")
n_silver = silver.count()
n_big = silver.filter(F.col("commune") == "BIG").count()
n_silver_files = silver.inputFiles().__len__()

sc.setJobGroup("gold", "gold aggregate")
gold = stage(gold_aggregate(silver, category_is()), "skew-gold")
n_groups = gold.count()
big_total = gold.filter((F.col("commune") == "BIG") & (F.col("_gid") == 3)).first()["_n"]
spark.stop()

group_of_stage, written = {}, {}
for f in sorted(glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*.zstd")):
    stream = zstandard.ZstdDecompressor().stream_reader(open(f, "rb")) if f.endswith(".zstd") else open(f, "rb")
    for line in io.TextIOWrapper(stream, encoding="utf-8"):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                group_of_stage[s] = g
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            w = e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
            g = group_of_stage.get(e["Stage ID"])
            written[g] = written.get(g, 0) + w
print(json.dumps({
    "map_tasks": MAP_TASKS, "rows": n_rows, "hot_key_rows": n_hot_key, "silver_rows": n_silver,
    "silver_files": n_silver_files, "big_rows": n_big, "big_total": big_total, "gold_groups": n_groups,
    "silver_shuffle_written": written.get("silver"), "gold_shuffle_written": written.get("gold"),
}))
