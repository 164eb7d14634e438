"""Bronze -> silver (L1): typed, categorised, filtered, deduplicated measurements.

Steps (one projection, one filter, one keyed dedup -- a single shuffle):

1. ``date_prelevement_clean`` = ISO text -> DATE, ``annee`` = its year;
2. ``resultat_valeur_float`` = lab-result text -> FLOAT (detection limits kept by default);
3. four renames (place / parameter / department names);
4. ``categorie`` = keyword family of the parameter name;
5. rows without sample code, parameter name or place are dropped;
6. one row per (sample, parameter, date), the first in ``tie_break`` order.  A date text that does not
   parse stands for itself in the key, so only equal texts merge; the silver gate counts such rows.

All column names are parameters (``SilverSpec``); the defaults are the source system's names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix._util import require_columns
from hydrix.functions.categories import DEFAULT_CATEGORY, DEFAULT_RULES, Rule, categorize
from hydrix.functions.dates import in_window, parse_date, year_of
from hydrix.functions.measures import parse_measurement
from hydrix.operators.columns import require_fields
from hydrix.operators.dedup import dedup_keys, orderable_columns
from hydrix.operators.rejects import RejectRule

# Source column names, the renames and the derived column names of the silver table.
DEFAULT_RENAMES = {
    "libelle_parametre": "parametre_nom",
    "nom_commune": "commune",
    "nom_departement": "departement",
    "code_departement": "code_dept",
}


@dataclass(frozen=True)
class SilverSpec:
    date_col: str = "date_prelevement"
    result_col: str = "resultat_alphanumerique"
    renames: Mapping[str, str] = field(default_factory=lambda: dict(DEFAULT_RENAMES))
    parameter_col: str = "parametre_nom"
    required: Sequence[str] = ("code_prelevement", "parametre_nom", "commune")
    dedup_keys: Sequence[str] = ("code_prelevement", "code_parametre", "date_prelevement_clean")
    # survivor order within a duplicate key; None = every other orderable column, ascending
    tie_break: Sequence[Column | str] | None = None
    rules: Sequence[Rule] = DEFAULT_RULES
    default_category: str = DEFAULT_CATEGORY
    censored: str = "limit"
    clean_date_col: str = "date_prelevement_clean"
    year_col: str = "annee"
    value_col: str = "resultat_valeur_float"
    category_col: str = "categorie"


def clean(raw: DataFrame, spec: SilverSpec = SilverSpec()) -> DataFrame:
    """Steps 1-4: derived columns and renames, no rows removed (one narrow projection)."""
    require_columns(raw, [spec.date_col, spec.result_col, *spec.renames])
    parsed_date = parse_date(spec.date_col)
    typed = raw.withColumns(
        {
            spec.clean_date_col: parsed_date,
            spec.year_col: year_of(parsed_date),
            spec.value_col: parse_measurement(spec.result_col, spec.censored),
        }
    ).withColumnsRenamed(dict(spec.renames))
    require_columns(typed, [spec.parameter_col], "parameter column")
    return typed.withColumn(
        spec.category_col, categorize(spec.parameter_col, spec.rules, spec.default_category)
    )


BAD_DATE = "__hydrix_bad_date"


def bad_date(spec: SilverSpec = SilverSpec()) -> Column:
    """The raw date text where it does not parse (needs the clean date column), else NULL."""
    raw = spec.renames.get(spec.date_col, spec.date_col)
    return F.when(F.col(spec.clean_date_col).isNull(), F.col(raw))


# Defects of a raw row, by family.
MALFORMED, MISSING, DATE, RESULT = "malformed", "missing", "bad_date", "unparseable"
DEFECTS = (MALFORMED, MISSING, DATE, RESULT)
#: What silver never takes; the other defects leave a NULL in the row.
NOT_TAKEN = (MALFORMED, MISSING)


def reject_rules(
    spec: SilverSpec = SilverSpec(),
    *,
    drop: Sequence[str] = NOT_TAKEN,
    corrupt_column: str | None = None,
    windowed: bool = False,
) -> list[RejectRule]:
    """The defects of raw rows as rules: ``malformed`` (text in ``corrupt_column``), ``missing_<field>`` of every
    required field, ``bad_date`` and ``unparseable_result`` (text that does not parse).

    ``drop`` names the families whose rows are rejected.  Under a date window (``windowed``) a row without a
    readable date cannot be placed, so ``bad_date`` and ``missing_<date>`` always reject.
    """
    unknown = sorted(set(drop) - set(DEFECTS))
    if unknown:
        raise ValueError(f"unknown defects {unknown}; known: {DEFECTS}")
    raw_name = {new: old for old, new in spec.renames.items()}
    rules = []
    if corrupt_column is not None:
        rules.append(RejectRule("malformed", F.col(corrupt_column).isNotNull(), MALFORMED in drop))
    fields = [raw_name.get(c, c) for c in spec.required]
    rules += [RejectRule(f"missing_{c}", F.col(c).isNull(), MISSING in drop) for c in fields]
    date, result = F.col(spec.date_col), F.col(spec.result_col)
    if windowed and spec.date_col not in fields:
        rules.append(RejectRule(f"missing_{spec.date_col}", date.isNull()))
    rules.append(RejectRule("bad_date", date.isNotNull() & parse_date(date).isNull(), windowed or DATE in drop))
    unparsed = result.isNotNull() & parse_measurement(result, spec.censored).isNull()
    if spec.censored == "null":  # a detection limit that is set aside did parse
        unparsed = result.isNotNull() & parse_measurement(result).isNull()
    rules.append(RejectRule("unparseable_result", unparsed, RESULT in drop))
    return rules


def window_counts(raw: DataFrame, window: tuple[str, str], spec: SilverSpec = SilverSpec()) -> DataFrame:
    """One row: rows inside and outside a date window, and rows that cannot be placed (no date, a bad date)."""
    require_columns(raw, [spec.date_col])
    text, day = F.col(spec.date_col), parse_date(spec.date_col)
    return raw.agg(
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if(in_window(day, *window)).alias("rows_inside"),
        F.count_if(~in_window(day, *window)).alias("rows_outside"),
        F.count_if(text.isNull()).alias("rows_without_date"),
        F.count_if(text.isNotNull() & day.isNull()).alias("bad_dates"),
    )


def build_silver(raw: DataFrame, spec: SilverSpec = SilverSpec()) -> DataFrame:
    """Steps 1-6.  The only shuffle is the keyed dedup (hash exchange on ``spec.dedup_keys``).

    Only what the filter and the dedup need (renames, the parsed date) is computed before the
    shuffle; the result parser, the year and the keyword family are computed after it, on the
    surviving rows only and in the post-shuffle tasks.  The shuffle carries the raw columns, which
    the silver table keeps anyway.
    """
    require_columns(raw, [spec.date_col, spec.result_col, *spec.renames])
    keyed = raw.withColumn(spec.clean_date_col, parse_date(spec.date_col)).withColumnsRenamed(
        dict(spec.renames)
    )
    require_columns(keyed, [spec.parameter_col, *spec.required, *spec.dedup_keys])
    kept = require_fields(keyed, spec.required)
    order = spec.tie_break
    if order is None:
        order = orderable_columns(kept, exclude=spec.dedup_keys)
    kept = kept.withColumn(BAD_DATE, bad_date(spec))
    survivors = dedup_keys(kept, [*spec.dedup_keys, BAD_DATE], order).drop(BAD_DATE)
    result_col = spec.renames.get(spec.result_col, spec.result_col)  # the result text may be renamed too
    out = survivors.withColumns(
        {
            spec.year_col: year_of(spec.clean_date_col),
            spec.value_col: parse_measurement(result_col, spec.censored),
            spec.category_col: categorize(spec.parameter_col, spec.rules, spec.default_category),
        }
    )
    # same column order as ``clean``: source columns, then the derived ones
    derived = [spec.clean_date_col, spec.year_col, spec.value_col, spec.category_col]
    return out.select(*[c for c in out.columns if c not in derived], *derived)
