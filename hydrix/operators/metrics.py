"""Analytic aggregates: conformity rate, yearly trend, non-conformity counts, value counts, worst-k.

All grouped aggregates are partial+final hash aggregates: each map task pre-aggregates its rows, so
a group that holds a large share of the data (one very big place) ships one row per task into the
shuffle.  Outputs are one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix._util import as_col, as_list, require_columns, require_nonempty
from hydrix.functions.arith import count_true, ratio
from hydrix.functions.exact import kind_of, mean_of, state_columns

# Output names of the gold tables.
TOTAL = "total_tests"
OK = "nb_conformes"
KO = "nb_non_conformes"
RATE = "taux_conformite"
MEAN = "moyenne_resultat"
N_MEASURES = "nb_mesures"


def _group_exprs(df: DataFrame, group: Sequence[Column | str]) -> list[Column]:
    names = [g for g in group if isinstance(g, str)]
    require_columns(df, names, "group column")
    return [as_col(g) for g in group]


def conformity_by_group(
    df: DataFrame,
    group: Sequence[Column | str],
    predicate: Column,
    *,
    total: str = TOTAL,
    ok: str = OK,
    ko: str = KO,
    rate: str = RATE,
) -> DataFrame:
    """Per group: row count, rows where ``predicate`` is TRUE, rows where it is FALSE, and the rate.

    A NULL predicate counts in the total only.  ``rate = ok / total`` as DOUBLE.
    """
    group = as_list(group) if isinstance(group, str) else list(group)
    require_nonempty(group, "group")
    return (
        df.groupBy(*_group_exprs(df, group))
        .agg(
            F.count(F.lit(1)).alias(total),
            count_true(predicate).alias(ok),
            count_true(~predicate).alias(ko),
        )
        .withColumn(rate, ratio(F.col(ok), F.col(total)))
    )


def yearly_trend(
    df: DataFrame,
    period: Column | str,
    group: Sequence[Column | str],
    value: Column | str,
    *,
    mean: str = MEAN,
    count: str = N_MEASURES,
    round_digits: int | None = None,
    exact: bool = False,
) -> DataFrame:
    """Per (period, group): mean of ``value`` (NULLs skipped) and row count (NULLs included).

    A NULL period is its own group.  ``round_digits`` rounds the mean.  ``exact`` sums exactly (see
    ``functions.exact``), so that the mean has the same bits under any partitioning.
    """
    group = as_list(group) if isinstance(group, str) else list(group)
    if isinstance(value, str):
        require_columns(df, [value], "value column")
    avg = F.avg(as_col(value))
    if exact:
        kind = kind_of(df.select(as_col(value)).schema[0].dataType)
        names = [period, *group]
        sums = df.groupBy(*_group_exprs(df, names)).agg(
            *state_columns(as_col(value), "_x", kind), F.count(F.lit(1)).alias(count)
        )
        avg = mean_of("_x", kind)
        avg = avg if round_digits is None else F.round(avg, round_digits)
        return sums.select(*sums.columns[: len(names)], avg.alias(mean), count)
    if round_digits is not None:
        avg = F.round(avg, round_digits)
    return df.groupBy(*_group_exprs(df, [period, *group])).agg(
        avg.alias(mean), F.count(F.lit(1)).alias(count)
    )


def nonconformity_by_group(
    df: DataFrame,
    group: Sequence[Column | str],
    predicate: Column,
    *,
    count: str = KO,
    sort: bool = True,
) -> DataFrame:
    """Rows where ``predicate`` is FALSE (NULL rows drop out), counted per group, largest first.

    Ties are ordered by the group columns so the order is reproducible.
    """
    group = as_list(group) if isinstance(group, str) else list(group)
    require_nonempty(group, "group")
    out = df.filter(~predicate).groupBy(*_group_exprs(df, group)).agg(F.count(F.lit(1)).alias(count))
    if sort:
        out = out.orderBy(F.col(count).desc(), *[F.col(c).asc_nulls_first() for c in out.columns[:-1]])
    return out


def value_counts(df: DataFrame, col: str, *, name: str = "count", sort: bool = True) -> DataFrame:
    """Rows per distinct value of ``col`` (NULL is a value), optionally most frequent first."""
    require_columns(df, [col])
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias(name))
    if sort:
        out = out.orderBy(F.col(name).desc(), F.col(col).asc_nulls_first())
    return out


def worst_k(
    df: DataFrame, k: int, rate: str = RATE, keys: Sequence[str] = ("commune",)
) -> DataFrame:
    """The ``k`` rows with the lowest ``rate`` (NULL first), ties broken by ``keys``.

    Planned as ``TakeOrderedAndProject``: each task keeps its own top ``k``; one task merges
    ``k x tasks`` rows.  No full sort, no shuffle of the table.
    """
    if k <= 0:
        raise ValueError(f"k must be positive, got {k}")
    keys = as_list(keys)
    require_columns(df, [rate, *keys])
    return df.orderBy(F.col(rate).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in keys]).limit(k)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``cols`` (partial+final hash aggregate)."""
    cols = as_list(cols)
    require_nonempty(cols, "columns")
    require_columns(df, cols)
    return df.select(*cols).distinct()
