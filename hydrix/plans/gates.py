"""Quality gates over the silver table (L3) and the gold tables (L4).

Each gate returns one result row per check (see ``hydrix.operators.quality``), computed with one
aggregate pass per table.  Gates do not stop anything by themselves: pass the result to
``assert_checks(results, "raise")`` to block a run on failure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrix.operators.quality import (
    Check,
    at_least,
    at_least_mostly,
    between,
    check_subset,
    counts_within_total,
    expect,
    greater_than,
    not_null,
    run_checks,
)
from hydrix.plans.gold import CONFORMITY, NONCONFORMITY, TREND, WORST, GoldSpec
from hydrix.sources.files import read_parquet

SILVER = "silver"

# The plausible-year range and the tolerated share of negative results (percent).
YEAR_MIN, YEAR_MAX = 2000, 2030
NEGATIVE_MAX_PCT = 5.0


def silver_checks(
    required: Sequence[str] = ("code_prelevement", "commune", "parametre_nom"),
    year_col: str = "annee",
    value_col: str = "resultat_valeur_float",
    date_col: str = "date_prelevement",
    clean_date_col: str = "date_prelevement_clean",
) -> list[Check]:
    """Silver rules on the silver column names: required fields, plausible years, mostly >= 0 results,
    no date text that does not parse."""
    return [
        *[not_null(c) for c in required],
        between(year_col, YEAR_MIN, YEAR_MAX),
        at_least_mostly(value_col, 0, NEGATIVE_MAX_PCT),
        expect(date_col, F.col(date_col).isNotNull() & F.col(clean_date_col).isNull(), "parses as a date"),
    ]


def source_silver_checks() -> list[Check]:
    """The source pipeline's silver rules as written there: two of its columns were renamed before
    the check and one never existed, so three of the five rules are reported as ``skipped``."""
    return [
        not_null("code_prelevement"),
        not_null("nom_commune"),
        not_null("libelle_parametre"),
        between("annee", YEAR_MIN, YEAR_MAX),
        at_least_mostly("resultat", 0, NEGATIVE_MAX_PCT),
    ]


def silver_gate(silver: DataFrame, checks: Sequence[Check] | None = None, table_name: str = SILVER) -> DataFrame:
    return run_checks(silver, list(checks) if checks is not None else silver_checks(), table_name)


def silver_gate_at(
    spark: SparkSession, path: str, *, on_missing: str = "raise", checks: Sequence[Check] | None = None
) -> DataFrame | None:
    """Gate a written silver table; ``on_missing='skip'`` returns None when ``path`` does not exist."""
    df = read_parquet(spark, path, on_missing=on_missing)
    return None if df is None else silver_gate(df, checks)


def gold_gate(tables: Mapping[str, DataFrame], spec: GoldSpec = GoldSpec()) -> DataFrame:
    """Seven column rules over three gold tables plus the conformity/worst-k consistency checks.

    One aggregate pass per table: the consistency rule ``ok + ko <= total`` is evaluated in the same
    pass as the conformity table's column rules; the worst-k subset check is a semi-join whose
    strategy is left to Spark's statistics.
    """
    conf, trend, nonconf = tables[CONFORMITY], tables[TREND], tables[NONCONFORMITY]
    group = list(spec.group)
    out = run_checks(
        conf,
        [
            between("taux_conformite", 0, 1),
            greater_than("total_tests", 0),
            *[not_null(g) for g in group],
            counts_within_total(),
        ],
        CONFORMITY,
    )
    out = out.unionByName(
        run_checks(trend, [between(spec.year_col, YEAR_MIN, YEAR_MAX), greater_than("nb_mesures", 0)], TREND)
    )
    out = out.unionByName(
        run_checks(nonconf, [at_least("nb_non_conformes", 0), not_null(spec.parameter_col)], NONCONFORMITY)
    )
    worst = tables.get(WORST)
    if worst is not None:
        out = out.unionByName(check_subset(worst, conf, group, CONFORMITY))
    return out
