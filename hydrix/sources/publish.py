"""Publishing tables all or nothing (L1, L2).

New tables are written beside the published ones, and moved into place only when all are written and the
caller's gates passed.  The switch is a list of folder renames.  Before the first one a journal names them
all, so a run that dies in between is completed by the next ``recover`` (every ``Publication`` starts with
one): readers find the former tables or, after recovery, the new ones, never a half-written table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from hydrix.session import _hadoop_path, delete_path, path_exists

STAGED, FORMER, JOURNAL = "_staged", "_former", "_publish.json"


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    jvm_source, fs = _hadoop_path(spark, source)
    jvm_target, _ = _hadoop_path(spark, target)
    fs.mkdirs(jvm_target.getParent())
    if not fs.rename(jvm_source, jvm_target):
        raise OSError(f"could not move {source} to {target}")


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, complete or not there: written under another name, then renamed."""
    draft = f"{path}.{uuid.uuid4().hex}"
    jvm_path, fs = _hadoop_path(spark, draft)
    out = fs.create(jvm_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    delete_path(spark, path)
    rename_path(spark, draft, path)


def read_small(spark: SparkSession, path: str) -> str:
    jvm_path, fs = _hadoop_path(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _switch(spark: SparkSession, root: str, run: str, names: list[str]) -> None:
    for name in names:
        staged, final, former = f"{root}/{STAGED}/{run}/{name}", f"{root}/{name}", f"{root}/{FORMER}/{run}/{name}"
        if not path_exists(spark, staged):
            continue  # moved before
        if path_exists(spark, final):
            rename_path(spark, final, former)
        rename_path(spark, staged, final)
    delete_path(spark, f"{root}/{JOURNAL}")
    delete_path(spark, f"{root}/{FORMER}/{run}")
    delete_path(spark, f"{root}/{STAGED}/{run}")


def recover(spark: SparkSession, root: str) -> bool:
    """Completes a switch that was cut off; whether there was one."""
    root = root.rstrip("/")
    if not path_exists(spark, f"{root}/{JOURNAL}"):
        return False
    entry = json.loads(read_small(spark, f"{root}/{JOURNAL}"))
    _switch(spark, root, entry["run"], entry["tables"])
    return True


class Publication:
    """``with Publication(spark, root) as p``: write tables to ``p.path(name)``, then ``p.switch()``.

    Leaving the block without ``switch`` (an error, a failed gate) drops what was staged; the published
    tables stay as they were.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run, self.names = spark, root.rstrip("/"), uuid.uuid4().hex, []

    def __enter__(self) -> Publication:
        recover(self.spark, self.root)
        return self

    def path(self, name: str) -> str:
        """Where to write the table that will be ``<root>/<name>``."""
        if name not in self.names:
            self.names.append(name)
        return f"{self.root}/{STAGED}/{self.run}/{name}"

    def switch(self) -> None:
        missing = [n for n in self.names if not path_exists(self.spark, f"{self.path(n)}/_SUCCESS")]
        if missing:
            raise ValueError(f"not completely written: {missing}")
        write_small(self.spark, f"{self.root}/{JOURNAL}", json.dumps({"run": self.run, "tables": self.names}))
        _switch(self.spark, self.root, self.run, self.names)

    def __exit__(self, *exc) -> None:
        if not path_exists(self.spark, f"{self.root}/{JOURNAL}"):  # a switch that was cut off is completed later
            delete_path(self.spark, f"{self.root}/{STAGED}/{self.run}")
