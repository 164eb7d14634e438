"""A gate that scans only the partitions that changed (Q1-Q6, L3).

The states of a table's checks are stored per partition (``hydrix.operators.check_states``) beside a
fingerprint of the partition's files: their number, bytes, and the names, sizes and times of all of them.
The next gate lists the files, scans the partitions whose fingerprint is new or different, takes the stored
states of all others, forgets those that are gone, and adds up.  Its rows equal those of a full gate.

File lists are read as a table (path, size and time; no contents), so the fingerprints are grouped by Spark.
One writer at a time: the table must not change while a gate runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrix._util import as_list, require_columns
from hydrix.operators.check_states import CHECK, ROWS, UNEXPECTED, checks_key, partition_states, state_results
from hydrix.operators.quality import Check
from hydrix.plans.gates import SILVER, silver_checks
from hydrix.plans.incremental import MOST_PARTITIONS, in_partitions
from hydrix.session import Scratch
from hydrix.sources.files import read_parquet, write_parquet
from hydrix.sources.publish import Publication

FINGERPRINT, LIST_KEY = "_files", "_checks"


@dataclass
class GateRun:
    """``results``: one row per check.  ``scanned`` partitions were read, ``reused`` ones were not."""

    results: DataFrame
    scanned: int
    reused: int


def partition_files(spark: SparkSession, path: str, by: str | Sequence[str]) -> DataFrame:
    """``by``, ``_files``: a fingerprint of the data files of every partition of a written table."""
    cols = as_list(by)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    require_columns(files, cols, "partition column")
    name = F.element_at(F.split("path", "/"), -1)
    one = F.xxhash64(name, "length", "modificationTime")
    mark = F.struct(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.bit_xor(one).alias("hash"))
    return files.groupBy(*cols).agg(mark.alias(FINGERPRINT))


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]):
    found = left[FINGERPRINT] == right[FINGERPRINT]
    for c in cols:
        found = found & left[c].eqNullSafe(right[c])
    return found


def gate_partitions(
    spark: SparkSession,
    path: str,
    states_root: str,
    by: str | Sequence[str],
    *,
    checks: Sequence[Check] | None = None,
    table_name: str = SILVER,
) -> GateRun:
    """Gate the table at ``path``, partitioned by ``by``, from stored and fresh states.

    The states lie under ``<states_root>/<table_name>`` and are replaced all or nothing after the scan.  With
    another list of checks, or where a checked column came or went, nothing stored is used.  Where more than ``MOST_PARTITIONS`` partitions changed,
    the table is scanned whole and the others' states are simply made again.
    """
    cols, checks = as_list(by), list(checks) if checks is not None else silver_checks()
    table = read_parquet(spark, path)
    key = checks_key(checks, table.columns)
    with Publication(spark, states_root) as publication, Scratch(spark, "gate") as scratch:
        files = scratch.stage(partition_files(spark, path, cols), "files")
        stored = read_parquet(spark, f"{publication.root}/{table_name}", on_missing="skip")
        if stored is None:
            changed, kept = files, None
        else:
            stored = stored.filter(F.col(LIST_KEY) == key)
            known = stored.select(*cols, FINGERPRINT).distinct()
            changed = scratch.stage(files.join(known, _same(files, known, cols), "left_anti"), "changed")
            kept = stored.join(files, _same(stored, files, cols), "left_semi")
        values = [tuple(r) for r in changed.select(*cols).limit(MOST_PARTITIONS + 1).collect()]
        if len(values) > MOST_PARTITIONS:
            changed, kept, rows = files, None, table
        else:
            rows = table.filter(in_partitions(cols, values))
        marks = changed.select(*(F.col(c).alias(f"_p{i}") for i, c in enumerate(cols)), FINGERPRINT)
        place = F.lit(True)
        for i, c in enumerate(cols):
            place = place & F.col(c).eqNullSafe(F.col(f"_p{i}"))
        fresh = partition_states(rows, checks, cols).join(marks, place).drop(*(f"_p{i}" for i in range(len(cols))))
        fresh = fresh.withColumn(LIST_KEY, F.lit(key))
        order = [*cols, CHECK, UNEXPECTED, ROWS, FINGERPRINT, LIST_KEY]
        states = fresh.select(*order) if kept is None else kept.select(*order).unionByName(fresh.select(*order))
        write_parquet(states, publication.path(table_name))
        publication.switch()
        scanned, n_files = changed.count(), files.count()
    states = read_parquet(spark, f"{states_root.rstrip('/')}/{table_name}")
    return GateRun(state_results(states, checks, table_name, table.columns), scanned, n_files - scanned)
