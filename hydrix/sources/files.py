"""JSON Lines and Parquet readers/writers.

* Readers accept a declared schema (no inference job, stable types) or infer when none is given.
* ``read_parquet`` / ``read_json`` take a missing-input policy: ``raise`` (default) or ``skip``
  (returns ``None``); it works on any Hadoop file system because it relies on Spark's own
  ``PATH_NOT_FOUND`` error rather than a local ``os.path`` test.
* A JSON record that does not parse stops the job unless the caller skips such records or keeps them in a
  column: it never becomes a row of NULLs.
* ``write_parquet`` / ``write_json`` overwrite whole directories and refuse to overwrite a path that
  the DataFrame itself reads from (Spark would delete the input before reading it); paths are compared
  as their file system qualifies them, by the plan's root paths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hydrix._util import as_list
from hydrix.session import qualified_path

ON_MISSING = ("raise", "skip")


def _is_missing_path(err: AnalysisException) -> bool:
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(err)


def _read(reader, path: str, fmt: str, on_missing: str) -> DataFrame | None:
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing must be one of {ON_MISSING}, got {on_missing!r}")
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as err:
        if on_missing == "skip" and _is_missing_path(err):
            return None
        raise


JSON_MODES = ("PERMISSIVE", "FAILFAST", "DROPMALFORMED")
#: Column of the text of records that do not parse, unless another is named.
CORRUPT_RECORD = "_corrupt_record"
ON_MALFORMED = ("raise", "skip")


#: A field that no record has.  Spark refuses to read the corrupt text alone (a bare count), and a data column
#: beside it would let a later not-null filter on that column hide the record.
_PROBE = "_hydrix_probe"


def only_parsed(df: DataFrame, column: str, on_malformed: str = "raise", what: str = "JSON record") -> DataFrame:
    """The records that parsed, without ``column`` (the text of those that did not).

    ``raise`` fails the job on the first other one, ``skip`` leaves it out.
    """
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}, got {on_malformed!r}")
    bad = F.col(column).isNotNull()
    probe = F.col(_PROBE) if _PROBE in df.columns else F.lit(None).cast("string")
    if on_malformed == "skip":
        good = ~bad & probe.isNull()
    else:
        text = F.concat(F.lit(f"malformed {what}: "), F.substring(column, 1, 200), F.coalesce(probe, F.lit("")))
        good = F.when(bad, F.raise_error(text).cast("boolean")).otherwise(True)
    return df.filter(good).drop(column, _PROBE)


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    multiline: bool = False,
    on_missing: str = "raise",
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    on_malformed: str = "raise",
) -> DataFrame | None:
    """JSON Lines (or ``multiline`` documents).

    With no schema, Spark infers one (an extra pass) and malformed records show in ``_corrupt_record``.  With a
    declared schema, a record that does not parse, or does not fit its types, stops the job
    (``on_malformed="raise"``) or is left out (``"skip"``).  ``corrupt_column`` keeps such records as rows instead, with their text in
    that string column.  ``mode="FAILFAST"`` or ``"DROPMALFORMED"`` leaves the decision to Spark's reader.
    A query that reads few columns judges records by those columns and their syntax.
    """
    if mode not in JSON_MODES:
        raise ValueError(f"mode must be one of {JSON_MODES}, got {mode!r}")
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}, got {on_malformed!r}")
    reader = spark.read.option("multiLine", multiline).option("mode", mode)
    column, keep = corrupt_column or CORRUPT_RECORD, corrupt_column is not None or schema is None or mode != "PERMISSIVE"
    if schema is not None:
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema) if hasattr(StructType, "fromDDL") else _ddl(spark, schema)
        if column in schema.fieldNames():
            keep = True  # the caller's schema asks for the column
        elif mode == "PERMISSIVE" or corrupt_column is not None:
            probe = [] if keep else [StructField(_PROBE, StringType())]
            schema = StructType([*schema.fields, StructField(column, StringType()), *probe])
        reader = reader.schema(schema)
    df = _read(reader.option("columnNameOfCorruptRecord", column), path, "json", on_missing)
    if df is None or keep:
        return df
    return only_parsed(df, column, on_malformed)


def _ddl(spark: SparkSession, ddl: str) -> StructType:
    return spark.createDataFrame([], ddl).schema


def read_parquet(spark: SparkSession, path: str, *, on_missing: str = "raise") -> DataFrame | None:
    return _read(spark.read, path, "parquet", on_missing)


def _file_relations(df: DataFrame):
    """File-based relations in the DataFrame's plan, subqueries included."""
    plan = df._jdf.queryExecution().analyzed()
    plans = [plan]
    inner = plan.subqueriesAll()
    plans += [inner.apply(i) for i in range(inner.size())]
    for p in plans:
        leaves = p.collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            if leaf.getClass().getSimpleName() == "LogicalRelation":
                relation = leaf.relation()
                if relation.getClass().getSimpleName() == "HadoopFsRelation":
                    yield relation


def source_roots(df: DataFrame) -> list[str]:
    """Qualified root paths that the DataFrame reads (the given folders or files, not every file)."""
    found = []
    for relation in _file_relations(df):
        roots = relation.location().rootPaths()
        found += [qualified_path(df.sparkSession, roots.apply(i).toString()) for i in range(roots.size())]
    return found


def reads_json(df: DataFrame) -> bool:
    return any("Json" in r.fileFormat().getClass().getSimpleName() for r in _file_relations(df))


def guard_not_input(df: DataFrame, path: str) -> None:
    """Refuse to overwrite ``path`` when ``df`` reads it, a folder in it, or a folder that holds it."""
    target = qualified_path(df.sparkSession, path)
    for src in source_roots(df):
        if src == target or src.startswith(target + "/") or target.startswith(src + "/"):
            raise ValueError(f"refusing to overwrite {path!r}: the DataFrame reads from it ({src})")


def write_parquet(
    df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: Sequence[str] | None = None, rebalance: bool = True
) -> str:
    """Write ``df`` as a Parquet directory; returns ``path``.

    With ``partition_by`` the rows are rebalanced on those columns first (unless the caller did so): a
    partition value gets few files, and adaptive execution splits the large values over several tasks.
    """
    if mode == "overwrite":
        guard_not_input(df, path)
    if partition_by and rebalance:
        df = df.hint("rebalance", *as_list(partition_by))
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*as_list(partition_by))
    writer.parquet(path)
    return path


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite", compression: str | None = None) -> str:
    """Write ``df`` as JSON Lines (one object per line); returns ``path``."""
    if mode == "overwrite":
        guard_not_input(df, path)
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)
    return path


def written_counts(spark: SparkSession, path: str, by: str) -> DataFrame:
    """Write-then-verify: re-read a written Parquet directory and count rows per ``by`` value."""
    df = read_parquet(spark, path)
    return df.groupBy(by).count()
