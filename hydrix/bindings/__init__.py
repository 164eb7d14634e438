"""Bindings of the operators to the driver's tables, each with an independent DuckDB oracle.

* ``inputs``  -- the driver tables (declared schemas), the raw-measurement view ``M`` over ``events``,
  the silver table built from it, and the binding parameters;
* ``queries`` -- ``QUERIES[name](spark, sf_dir) -> DataFrame``, one entry per operator binding;
* ``oracle``  -- ``oracle_sql()[name]``: hand-written DuckDB SQL over the same Parquet tables
  (registered as views by table name) that must return the same rows.
"""

from hydrix.bindings.inputs import (
    GOLD_SPEC,
    K,
    M_COLUMNS,
    M_SQL,
    PAGE_SIZE,
    SILVER_SPEC,
    STATUS_OK,
    TABLE_SCHEMAS,
    WINDOW,
    m_view,
    silver_m,
    table,
)
from hydrix.bindings.oracle import oracle_sql
from hydrix.bindings.queries import QUERIES

__all__ = [
    "GOLD_SPEC",
    "K",
    "M_COLUMNS",
    "M_SQL",
    "PAGE_SIZE",
    "QUERIES",
    "SILVER_SPEC",
    "STATUS_OK",
    "TABLE_SCHEMAS",
    "WINDOW",
    "m_view",
    "oracle_sql",
    "silver_m",
    "table",
]
