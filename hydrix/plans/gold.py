"""Silver -> gold (L2): the four analytic tables.

=====================  =================================================================
conformite_commune     per place: total, conforming, non-conforming, rate
evolution_temporelle   per (year, parameter): mean result, number of measurements
top_10_pires_communes  the k places with the lowest rate (ties by place)
non_conformites_param  per parameter: non-conforming rows, largest first
=====================  =================================================================

"Conforming" is a predicate argument.  ``category_is("Conforme")`` reproduces the source pipeline's
literal test on the family column (never true there, so every rate is 0); ``status_is`` tests a real
status column.  ``worst`` is derived from the conformity table, never from a second scan of silver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.functions.arith import count_true, ratio
from hydrix.functions.exact import kind_of, mean_of, merged_columns, state_columns, state_names
from hydrix.operators.metrics import (
    KO,
    MEAN,
    N_MEASURES,
    OK,
    RATE,
    TOTAL,
    conformity_by_group,
    nonconformity_by_group,
    worst_k,
    yearly_trend,
)

# Gold table names.
CONFORMITY = "conformite_commune"
TREND = "evolution_temporelle"
WORST = "top_10_pires_communes"
NONCONFORMITY = "non_conformites_parametre"
GOLD_TABLES = (CONFORMITY, TREND, WORST, NONCONFORMITY)


def category_is(label: str = "Conforme", col: str = "categorie") -> Column:
    return F.col(col) == F.lit(label)


def status_is(value: str, col: str = "conclusion_conformite_prelevement") -> Column:
    return F.col(col) == F.lit(value)


@dataclass(frozen=True)
class GoldSpec:
    group: Sequence[str] = ("commune",)
    year_col: str = "annee"
    parameter_col: str = "parametre_nom"
    value_col: str = "resultat_valeur_float"
    k: int = 10
    trend_round: int | None = None
    #: means whose bits do not depend on the order of the rows (``functions.exact``)
    exact_means: bool = False


def gold_conformity(silver: DataFrame, predicate: Column, spec: GoldSpec = GoldSpec()) -> DataFrame:
    return conformity_by_group(silver, list(spec.group), predicate)


def gold_trend(silver: DataFrame, spec: GoldSpec = GoldSpec()) -> DataFrame:
    return yearly_trend(
        silver, spec.year_col, [spec.parameter_col], spec.value_col, round_digits=spec.trend_round,
        exact=spec.exact_means,
    )


def gold_worst(conformity: DataFrame, spec: GoldSpec = GoldSpec()) -> DataFrame:
    return worst_k(conformity, spec.k, keys=list(spec.group))


def gold_nonconformity(silver: DataFrame, predicate: Column, spec: GoldSpec = GoldSpec()) -> DataFrame:
    return nonconformity_by_group(silver, [spec.parameter_col], predicate)


def build_gold(silver: DataFrame, predicate: Column, spec: GoldSpec = GoldSpec()) -> dict[str, DataFrame]:
    """The four gold tables as lazy DataFrames keyed by table name."""
    conformity = gold_conformity(silver, predicate, spec)
    return {
        CONFORMITY: conformity,
        TREND: gold_trend(silver, spec),
        WORST: gold_worst(conformity, spec),
        NONCONFORMITY: gold_nonconformity(silver, predicate, spec),
    }


def _gid(cols: Sequence[str], grouping: Sequence[str]) -> int:
    """``grouping_id()`` of a grouping set: bit (n-1-i) is set when cols[i] is aggregated away."""
    n = len(cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in grouping)


def _sets(spec: GoldSpec) -> tuple[list[str], dict[str, list[str]]]:
    tables = {
        CONFORMITY: list(spec.group),
        TREND: [spec.year_col, spec.parameter_col],
        NONCONFORMITY: [spec.parameter_col],
    }
    cols: list[str] = []
    for g in tables.values():
        cols += [c for c in g if c not in cols]
    return cols, tables


def gold_aggregate(silver: DataFrame, predicate: Column, spec: GoldSpec = GoldSpec()) -> DataFrame:
    """Conformity, trend and non-conformity figures in ONE aggregate over silver (GROUPING SETS).

    Plan: one scan, an ``Expand`` (one copy per grouping set, inside the scan stage), a partial
    aggregate, one hash exchange, a final aggregate.  Three gold tables for the price of one shuffle
    whose size is the number of groups, not the number of rows.  ``split_gold`` turns the result
    into the gold tables.
    """
    cols, tables = _sets(spec)
    sets = []
    for g in tables.values():
        if g not in sets:
            sets.append(g)
    if spec.exact_means:
        return finish_states(gold_states(silver, predicate, spec), value_kind(silver, spec))
    return silver.groupingSets(sets, *cols).agg(
        F.count(F.lit(1)).alias("_n"),
        count_true(predicate).alias("_ok"),
        count_true(~predicate).alias("_ko"),
        F.avg(F.col(spec.value_col)).alias("_mean"),
        F.grouping_id().alias("_gid"),
    )


COUNTS = ("_n", "_ok", "_ko")


def value_kind(silver: DataFrame, spec: GoldSpec = GoldSpec()) -> str:
    return kind_of(silver.schema[spec.value_col].dataType)


def gold_states(silver: DataFrame, predicate: Column, spec: GoldSpec = GoldSpec()) -> DataFrame:
    """``gold_aggregate`` as mergeable states: integer counts and exact sums (``functions.exact``) a group.

    States of disjoint row sets add up to the states of all rows, and can be taken away again.
    """
    cols, tables = _sets(spec)
    sets = []
    for g in tables.values():
        if g not in sets:
            sets.append(g)
    return silver.groupingSets(sets, *cols).agg(
        F.count(F.lit(1)).alias("_n"),
        count_true(predicate).alias("_ok"),
        count_true(~predicate).alias("_ko"),
        *state_columns(F.col(spec.value_col), "_mean", value_kind(silver, spec)),
        F.grouping_id().alias("_gid"),
    )


def merge_states(states: DataFrame, kind: str, spec: GoldSpec = GoldSpec(), sign: str | None = None) -> DataFrame:
    """One state a group from any number of them; ``sign`` is a column of 1 and -1.  Groups without rows go."""
    cols, _ = _sets(spec)
    weight = F.lit(1) if sign is None else F.col(sign)
    sums = [F.sum(F.col(c) * weight).alias(c) for c in COUNTS]
    merged = states.groupBy(*cols, "_gid").agg(*sums, *merged_columns("_mean", kind, weight))
    return merged.select(*cols, *COUNTS, *state_names("_mean", kind), "_gid")


def finish_states(states: DataFrame, kind: str) -> DataFrame:
    """The aggregate that ``split_gold`` takes, from one state a group."""
    out = states.filter(F.col("_n") > 0).withColumn("_mean", mean_of("_mean", kind))
    return out.drop(*state_names("_mean", kind))


def split_gold(agg: DataFrame, spec: GoldSpec = GoldSpec()) -> dict[str, DataFrame]:
    """The four gold tables from ``gold_aggregate``'s output (ideally a written/staged copy).

    ``spec`` must be the one the aggregate was built with: the grouping ids depend on it, so a
    different grouping is refused rather than split wrongly.
    """
    cols, tables = _sets(spec)
    grouping = [c for c in agg.columns if not c.startswith("_")]
    if grouping != cols:
        raise ValueError(f"aggregate grouped by {grouping}, spec expects {cols}: pass the same GoldSpec")
    part = {t: agg.filter(F.col("_gid") == _gid(cols, g)) for t, g in tables.items()}
    conformity = part[CONFORMITY].select(
        *spec.group,
        F.col("_n").alias(TOTAL),
        F.col("_ok").alias(OK),
        F.col("_ko").alias(KO),
        ratio(F.col("_ok"), F.col("_n")).alias(RATE),
    )
    mean = F.col("_mean") if spec.trend_round is None else F.round("_mean", spec.trend_round)
    trend = part[TREND].select(spec.year_col, spec.parameter_col, mean.alias(MEAN), F.col("_n").alias(N_MEASURES))
    # rows whose predicate is FALSE, per parameter; a parameter without any is absent, as with a filter
    nonconf = (
        part[NONCONFORMITY]
        .filter(F.col("_ko") > 0)
        .select(spec.parameter_col, F.col("_ko").alias(KO))
        .orderBy(F.col(KO).desc(), F.col(spec.parameter_col).asc_nulls_first())
    )
    return {
        CONFORMITY: conformity,
        TREND: trend,
        WORST: gold_worst(conformity, spec),
        NONCONFORMITY: nonconf,
    }
