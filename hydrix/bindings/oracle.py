"""DuckDB oracle SQL for every registered query, written by hand.

It shares only fixed values with the Spark side: the rule list, the number pattern, the ``M``
text, the check rules' display text and the binding parameters.  Column names and types match the
Spark output (counts BIGINT, years INTEGER, rates and means DOUBLE, parsed values FLOAT).
"""

from __future__ import annotations

from hydrix.bindings.inputs import K, M_COLUMNS, M_SQL, PAGE_SIZE, STATUS_OK, WINDOW
from hydrix.functions.categories import DEFAULT_CATEGORY, DEFAULT_RULES
from hydrix.functions.measures import NUMERIC_TEXT
from hydrix.operators import quality as Q
from hydrix.plans.silver import DEFAULT_RENAMES




def _m() -> str:
    return M_SQL.format(events="events")


def _sql_date(c: str) -> str:
    return f"TRY_CAST(substr({c}, 1, 10) AS DATE)"


def _sql_parse(c: str, censored: str = "limit") -> str:
    b = f"trim(replace({c}, ',', '.'))"
    t = f"trim(CASE WHEN starts_with({b}, '<') THEN substr({b}, 2) ELSE {b} END)"
    v = f"CASE WHEN regexp_full_match({t}, '{NUMERIC_TEXT}') THEN CAST(TRY_CAST({t} AS DOUBLE) AS FLOAT) END"
    if censored == "null":
        v = f"CASE WHEN starts_with({b}, '<') THEN NULL ELSE {v} END"
    return v


def _sql_category(c: str) -> str:
    whens = []
    for label, kws in DEFAULT_RULES:
        cond = " OR ".join(f"contains(lower({c}), '{kw}')" for kw in kws)
        whens.append(f"WHEN {cond} THEN '{label}'")
    return f"CASE {' '.join(whens)} ELSE '{DEFAULT_CATEGORY}' END"


_CLEAN_SELECT = f"""SELECT code_prelevement, code_parametre, libelle_parametre AS parametre_nom, nom_commune AS commune,
  nom_departement AS departement, code_departement AS code_dept, date_prelevement, resultat_alphanumerique,
  resultat_numerique, libelle_unite, code_type_parametre, conclusion_conformite_prelevement, event_id,
  {_sql_date('date_prelevement')} AS date_prelevement_clean,
  CAST(year({_sql_date('date_prelevement')}) AS INTEGER) AS annee,
  {_sql_parse('resultat_alphanumerique')} AS resultat_valeur_float,
  {_sql_category('libelle_parametre')} AS categorie
FROM m"""

_SILVER_CTE = f"""m AS ({_m()}),
c AS ({_CLEAN_SELECT}),
silver AS (
  SELECT * FROM c WHERE code_prelevement IS NOT NULL AND parametre_nom IS NOT NULL AND commune IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY code_prelevement, code_parametre, date_prelevement_clean,
    CASE WHEN date_prelevement_clean IS NULL THEN date_prelevement END ORDER BY event_id) = 1)"""


def _sql_conformity(src: str, group: str, pred: str) -> str:
    ok = f"count(CASE WHEN {pred} THEN TRUE END)"
    return f"""SELECT {group}, count(*) AS total_tests, {ok} AS nb_conformes,
  count(CASE WHEN NOT ({pred}) THEN TRUE END) AS nb_non_conformes,
  CAST({ok} AS DOUBLE) / CAST(count(*) AS DOUBLE) AS taux_conformite
FROM {src} GROUP BY {group}"""


def _sql_violation(check: Q.Check) -> str:
    c = check.column
    if check.kind == Q.NOT_NULL:
        return f"{c} IS NULL"
    if check.kind == Q.BETWEEN:
        return f"({c} < {check.lo} OR {c} > {check.hi})"
    op = "<=" if check.strict else "<"
    return f"{c} {op} {check.lo}"


def _sql_check(src: str, table_name: str, check: Q.Check, *, skipped: bool = False, violation: str | None = None) -> str:
    head = f"SELECT '{table_name}' AS table_name, '{check.kind}' AS check_name, '{check.column}' AS column_name, '{check.rule()}' AS rule"
    total = "CAST(count(*) AS BIGINT) AS total"
    if skipped:
        return (f"{head}, CAST(NULL AS BIGINT) AS unexpected_count, {total}, CAST(NULL AS BOOLEAN) AS success, "
                f"'skipped' AS status FROM {src}")
    u = f"count(*) FILTER (WHERE {violation or _sql_violation(check)})"
    if check.kind == Q.MIN_TOLERANCE:
        ok = (f"(coalesce(CAST({u} AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0) * 100.0, 0.0) "
              f"< {float(check.max_pct)})")
    else:
        ok = f"({u} = 0)"
    return (f"{head}, CAST({u} AS BIGINT) AS unexpected_count, {total}, {ok} AS success, "
            f"CASE WHEN {ok} THEN 'passed' ELSE 'failed' END AS status FROM {src}")


def _sql_checks(src: str, table_name: str, checks: list, present: set[str]) -> str:
    return "\nUNION ALL\n".join(
        _sql_check(src, table_name, ch, skipped=ch.column not in present) for ch in checks
    )


_SILVER_COLUMNS = {
    DEFAULT_RENAMES.get(c, c) for c in M_COLUMNS
} | {"date_prelevement_clean", "annee", "resultat_valeur_float", "categorie"}


def _gold_cte(pred: str = "categorie = 'Conforme'") -> str:
    return f"""{_SILVER_CTE},
conf AS ({_sql_conformity('silver', 'commune', pred)}),
worst AS (SELECT * FROM conf ORDER BY taux_conformite ASC NULLS FIRST, commune ASC NULLS FIRST LIMIT {K}),
trend AS (SELECT annee, parametre_nom, round(avg(resultat_valeur_float), 4) AS moyenne_resultat,
                 count(*) AS nb_mesures FROM silver GROUP BY annee, parametre_nom),
nonconf AS (SELECT parametre_nom, count(*) AS nb_non_conformes FROM silver
            WHERE NOT ({pred}) GROUP BY parametre_nom)"""


def _violated_cte() -> str:
    """The gold tables with the violations that the Spark side seeds."""
    return f"""{_gold_cte().replace(chr(10) + 'conf AS (', chr(10) + 'conf0 AS (').replace('FROM conf ORDER', 'FROM conf0 ORDER').replace('worst AS (', 'worst0 AS (')},
worst AS (SELECT * FROM conf0 WHERE commune IN ('C7', 'C8')),
conf AS (SELECT commune, total_tests, CASE WHEN commune = 'C3' THEN total_tests + 1 ELSE nb_conformes END AS nb_conformes,
  nb_non_conformes, CASE WHEN commune = 'C5' THEN 1.5 ELSE taux_conformite END AS taux_conformite
  FROM conf0 WHERE commune IS NULL OR commune <> 'C7')"""


_DATE_RULE = Q.Check(Q.RULE, "date_prelevement", rule_text="parses as a date")
_SILVER_GATE = (
    _sql_checks("silver", "silver", [
        Q.not_null("code_prelevement"), Q.not_null("commune"), Q.not_null("parametre_nom"), Q.between("annee", 2000, 2030),
        Q.at_least_mostly("resultat_valeur_float", 0, 5.0),
    ], _SILVER_COLUMNS)
    + "\nUNION ALL\n"
    + _sql_check("silver", "silver", _DATE_RULE, violation="date_prelevement IS NOT NULL AND date_prelevement_clean IS NULL")
)


def _sql_consistency() -> str:
    rule = Q.Check(Q.RULE, "nb_conformes+nb_non_conformes", rule_text="nb_conformes + nb_non_conformes <= total_tests")
    first = _sql_check("conf", "conformite_commune", rule,
                       violation="nb_conformes + nb_non_conformes > total_tests")
    sub = """SELECT 'conformite_commune' AS table_name, 'subset_of' AS check_name, 'commune' AS column_name,
  'keys present in parent table' AS rule,
  CAST(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM conf WHERE conf.commune IS NOT DISTINCT FROM wk.commune)) AS BIGINT) AS unexpected_count,
  CAST(count(*) AS BIGINT) AS total,
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM conf WHERE conf.commune IS NOT DISTINCT FROM wk.commune)) = 0 AS success,
  CASE WHEN count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM conf WHERE conf.commune IS NOT DISTINCT FROM wk.commune)) = 0
       THEN 'passed' ELSE 'failed' END AS status
FROM (SELECT DISTINCT commune FROM worst) wk"""
    return f"{first}\nUNION ALL\n{sub}"


def _sql_raw_profile() -> str:
    numeric = ["resultat_numerique", "event_id"]
    parts = ["SELECT 'rows' AS section, '*' AS column_name, 'count' AS item, CAST(count(*) AS DOUBLE) AS value FROM m"]
    for c in numeric:
        x = f"CAST({c} AS DOUBLE)"
        for item, expr in (("n", f"count({x})"), ("mean", f"round(avg({x}), 6)"), ("stddev", f"round(stddev_samp({x}), 6)"),
                           ("min", f"min({x})"), ("max", f"max({x})")):
            parts.append(f"SELECT 'describe', '{c}', '{item}', CAST({expr} AS DOUBLE) FROM m")
    for c in M_COLUMNS:
        z = f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)"
        parts.append(f"SELECT 'nulls', '{c}', 'null_count', {z} FROM m")
        parts.append(f"SELECT 'nulls', '{c}', 'null_pct', round({z} * 100.0 / NULLIF(CAST(count(*) AS DOUBLE), 0), 2) FROM m")
    r = "resultat_numerique"
    parts += [
        f"SELECT 'extremes', '{r}', 'min', CAST(min({r}) AS DOUBLE) FROM m",
        f"SELECT 'extremes', '{r}', 'max', CAST(max({r}) AS DOUBLE) FROM m",
        f"SELECT 'extremes', '{r}', 'avg', round(avg({r}), 6) FROM m",
    ]
    for c in ("nom_departement", "code_type_parametre", "conclusion_conformite_prelevement"):
        parts.append(f"SELECT 'distribution', '{c}', CAST({c} AS VARCHAR), CAST(count(*) AS DOUBLE) FROM m GROUP BY {c}")
    return f"WITH m AS ({_m()})\n" + "\nUNION ALL\n".join(parts)


def _sql_m_renamed() -> str:
    cols = ", ".join(f"{c} AS {DEFAULT_RENAMES[c]}" if c in DEFAULT_RENAMES else c for c in M_COLUMNS)
    return f"WITH m AS ({_m()}) SELECT {cols} FROM m"


def _oracle() -> dict[str, str]:
    m = f"WITH m AS ({_m()})"
    conf_orders = _sql_conformity("orders", "o_custkey", "o_orderstatus = 'F'")
    parsed = f"{m} SELECT event_id, resultat_alphanumerique, {{v}} AS resultat_valeur_float FROM m"
    silver_src = f"WITH {_SILVER_CTE}"
    gold_src = f"WITH {_gold_cte()}"
    gold_status = f"WITH {_gold_cte(f'conclusion_conformite_prelevement = {chr(39)}{STATUS_OK}{chr(39)}')}"
    violated = f"WITH {_violated_cte()}"
    # the source's rules, written out: two of its columns were renamed before and one never existed
    suite = [Q.not_null("code_prelevement"), Q.not_null("nom_commune"), Q.not_null("libelle_parametre"),
             Q.between("annee", 2000, 2030), Q.at_least_mostly("resultat", 0, 5.0)]
    check_suite = _sql_checks("silver", "silver", suite, _SILVER_COLUMNS)
    sql = {
        "conformity_by_group": conf_orders,
        "worst_k": f"SELECT * FROM ({conf_orders}) ORDER BY taux_conformite ASC NULLS FIRST, o_custkey ASC NULLS FIRST LIMIT {K}",
        "yearly_trend": """SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, o_orderpriority,
  round(avg(o_totalprice), 4) AS moyenne_resultat, count(*) AS nb_mesures
FROM orders GROUP BY 1, 2""",
        "nonconformity_by_group": """SELECT o_orderpriority, count(*) AS nb_non_conformes FROM orders
WHERE NOT (o_orderstatus = 'F') GROUP BY o_orderpriority""",
        "value_counts": f"{silver_src} SELECT categorie, count(*) AS count FROM silver GROUP BY categorie",
        "parse_measurement": parsed.format(v=_sql_parse("resultat_alphanumerique")),
        "parse_measurement_censored_null": parsed.format(v=_sql_parse("resultat_alphanumerique", "null")),
        "parse_failures": f"""{m} SELECT count(*) AS parse_failures FROM m
WHERE resultat_alphanumerique IS NOT NULL AND ({_sql_parse('resultat_alphanumerique')}) IS NULL""",
        "categorize_keywords": f"{m} SELECT event_id, libelle_parametre AS parametre_nom, {_sql_category('libelle_parametre')} AS categorie FROM m",
        "clean_dates": f"""{m} SELECT event_id, date_prelevement, {_sql_date('date_prelevement')} AS date_prelevement_clean,
  CAST(year({_sql_date('date_prelevement')}) AS INTEGER) AS annee FROM m""",
        "iso_date_part": f"{m} SELECT event_id, split_part(nullif(date_prelevement, ''), 'T', 1) AS date_text FROM m",
        "date_window": f"""{m} SELECT event_id, {_sql_date('date_prelevement')} AS date_prelevement_clean FROM m
WHERE {_sql_date('date_prelevement')} BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'""",
        "standardize_columns": _sql_m_renamed(),
        "require_fields": f"{m} SELECT * FROM m WHERE code_prelevement IS NOT NULL AND libelle_parametre IS NOT NULL AND nom_commune IS NOT NULL",
        "dedup_keys": """SELECT *, CAST(ts AS DATE) AS day FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) = 1""",
        "dedup_stats": f"""{m}, g AS (SELECT count(*) AS n FROM m
  GROUP BY code_prelevement, code_parametre, {_sql_date('date_prelevement')},
    CASE WHEN {_sql_date('date_prelevement')} IS NULL THEN date_prelevement END)
SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after, CAST(sum(n) - count(*) AS BIGINT) AS rows_removed FROM g""",
        "distinct_pairs": f"WITH m AS ({_m()}), c AS ({_CLEAN_SELECT}) SELECT DISTINCT parametre_nom, categorie FROM c",
        "numeric_extremes": f"""{m} SELECT round(CAST(min(resultat_numerique) AS DOUBLE), 6) AS min,
  round(CAST(max(resultat_numerique) AS DOUBLE), 6) AS max, round(avg(resultat_numerique), 6) AS avg FROM m""",
        "describe_numeric": f"{m} " + "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM m"""
            for c in ("resultat_numerique", "event_id")),
        "null_profile": f"{m} " + "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / NULLIF(CAST(count(*) AS DOUBLE), 0), 2) AS null_pct FROM m"""
            for c in M_COLUMNS),
        "paged_json_rows": f"{m} SELECT * FROM m",
        "paged_json_crawl_rows": f"{m} SELECT * FROM m",
        "paged_json_stats": f"""SELECT count(DISTINCT event_id // {PAGE_SIZE}) AS n_pages, count(*) AS n_rows,
  CAST(0 AS BIGINT) AS n_empty_pages, count(*) > 0 AS has_last_page, CAST(0 AS BIGINT) AS n_malformed FROM events""",
        "paged_json_stats_numbered": f"""WITH p AS (SELECT event_id // {PAGE_SIZE} AS page, count(*) AS n FROM events GROUP BY 1),
t AS (SELECT max(page) AS last, count(*) FILTER (WHERE page <> 2) AS landed, count(*) FILTER (WHERE page = 1) AS ones,
  sum(n) FILTER (WHERE page <> 2) AS n, max(CASE WHEN page = 0 THEN n END) AS n0 FROM p)
SELECT CAST(landed + (last <> 2)::INT + ones + 1 AS BIGINT) AS n_pages,
  CAST(n + n0 + coalesce((SELECT n FROM p WHERE page = last AND page <> 2), 0) AS BIGINT) AS n_rows,
  CAST(ones AS BIGINT) AS n_empty_pages, TRUE AS has_last_page, CAST(1 AS BIGINT) AS n_malformed, CAST(last AS BIGINT) AS end_page,
  CAST((last <> 2)::INT + ones AS BIGINT) AS n_repeated_pages, CAST(1 AS BIGINT) AS n_pages_after_end,
  CAST(0 AS BIGINT) AS n_unnumbered,
  CAST((last > 2)::INT AS BIGINT) AS n_missing_pages FROM t""",
        "silver_window": f"""WITH m0 AS ({_m()}), m AS (SELECT * FROM m0
  WHERE {_sql_date('date_prelevement')} BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'),
{_SILVER_CTE[_SILVER_CTE.index("c AS ("):]} SELECT * FROM silver""",
        "jsonl_roundtrip": f"{m} SELECT * FROM m",
        "parquet_roundtrip": f"{m} SELECT * FROM m",
        "jsonl_roundtrip_inferred": f"{m} SELECT * FROM m",
        "silver_verify": f"{silver_src} SELECT categorie, count(*) AS count FROM silver GROUP BY categorie",
        "preview_rows": f"SELECT * FROM events ORDER BY event_id LIMIT {K}",
        "silver_layer": f"{silver_src} SELECT * FROM silver",
        "gold_conformity": f"{gold_src} SELECT * FROM conf",
        "gold_conformity_status": f"{silver_src} {_sql_conformity('silver', 'commune', f'conclusion_conformite_prelevement = {chr(39)}{STATUS_OK}{chr(39)}')}",
        "gold_trend": f"{gold_src} SELECT * FROM trend",
        "gold_worst_k": f"{gold_src} SELECT * FROM worst",
        "gold_nonconformity": f"{gold_src} SELECT * FROM nonconf",
        "check_not_null": f"{m} " + _sql_checks("m", "raw", [Q.not_null(c) for c in ("code_prelevement", "nom_commune", "libelle_parametre")], set(M_COLUMNS)),
        "check_between": f"{silver_src} " + _sql_checks("silver", "silver", [Q.between("annee", 2000, 2030), Q.between("resultat_valeur_float", 0, 100)], _SILVER_COLUMNS),
        "check_min": f"WITH conf AS ({conf_orders}) " + _sql_checks("conf", "conformity", [Q.greater_than("total_tests", 0), Q.at_least("nb_conformes", 1)], {"total_tests", "nb_conformes"}),
        "check_min_tolerance": f"{m} " + _sql_checks("m", "raw", [Q.at_least_mostly("resultat_numerique", 0), Q.at_least_mostly("resultat_numerique", 10)], set(M_COLUMNS)),
        "check_suite": f"{silver_src} {check_suite}",
        "check_suite_summary": f"""{silver_src}, r AS ({check_suite})
SELECT count(*) AS n_rules, count(*) FILTER (WHERE success IS NOT NULL) AS n_checks,
  count(*) FILTER (WHERE success) AS n_passed, count(*) FILTER (WHERE NOT success) AS n_failed,
  count(*) FILTER (WHERE success IS NULL) AS n_skipped, count(*) FILTER (WHERE NOT success) = 0 AS all_passed,
  coalesce(string_agg(CASE WHEN NOT success THEN concat_ws(':', table_name, check_name, column_name) END, ','
           ORDER BY CASE WHEN NOT success THEN concat_ws(':', table_name, check_name, column_name) END), '') AS failed
FROM r""",
        "check_aggregate_consistency": f"{violated} {_sql_consistency()}",
        "silver_gate": f"{silver_src} " + _SILVER_GATE,
        "gold_gate": f"""{violated}
{_sql_checks('conf', 'conformite_commune', [Q.between('taux_conformite', 0, 1), Q.greater_than('total_tests', 0), Q.not_null('commune')], {'taux_conformite', 'total_tests', 'commune'})}
UNION ALL
{_sql_checks('trend', 'evolution_temporelle', [Q.between('annee', 2000, 2030), Q.greater_than('nb_mesures', 0)], {'annee', 'nb_mesures'})}
UNION ALL
{_sql_checks('nonconf', 'non_conformites_parametre', [Q.at_least('nb_non_conformes', 0), Q.not_null('parametre_nom')], {'nb_non_conformes', 'parametre_nom'})}
UNION ALL
{_sql_consistency()}""",
        "raw_profile": _sql_raw_profile(),
        "gold_onepass_conformity": f"{gold_status} SELECT * FROM conf",
        "gold_onepass_trend": f"{gold_status} SELECT * FROM trend",
        "gold_onepass_nonconformity": f"{gold_status} SELECT * FROM nonconf",
        "gold_onepass_worst_k": f"{gold_status} SELECT * FROM worst",
        "below_minimum_rows": f"""{silver_src} SELECT event_id, resultat_valeur_float FROM silver
WHERE resultat_valeur_float < 10""",
        "null_rows": f"{m} SELECT event_id, nom_departement FROM m WHERE nom_commune IS NULL",
        "parse_failure_rows": f"""{m} SELECT event_id, resultat_alphanumerique FROM m
WHERE resultat_alphanumerique IS NOT NULL AND ({_sql_parse('resultat_alphanumerique')}) IS NULL""",
        "out_of_range_rows": f"""{silver_src} SELECT event_id, resultat_valeur_float FROM silver
WHERE resultat_valeur_float < 0 OR resultat_valeur_float > 100""",
        "department_counts": f"{m} SELECT nom_departement, count(*) AS count FROM m GROUP BY nom_departement",
        "parameter_type_counts": f"{m} SELECT code_type_parametre, count(*) AS count FROM m GROUP BY code_type_parametre",
        "status_counts": f"""{m} SELECT conclusion_conformite_prelevement, count(*) AS count FROM m
GROUP BY conclusion_conformite_prelevement""",
    }
    cut = "event_id % 211 = 0"
    date, value = _sql_date("date_prelevement"), _sql_parse("resultat_alphanumerique")
    bad_date = f"(date_prelevement IS NOT NULL AND {date} IS NULL)"
    unparsed = f"(resultat_alphanumerique IS NOT NULL AND ({value}) IS NULL)"
    required = "(code_prelevement IS NOT NULL AND libelle_parametre IS NOT NULL AND nom_commune IS NOT NULL)"
    inside = f"{date} BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'"
    missing = ", ".join(
        f"CASE WHEN {cut} OR {c} IS NULL THEN 'missing_{c}' END" for c in ("code_prelevement", "libelle_parametre", "nom_commune")
    )
    keys = f"code_prelevement, code_parametre, {date}, CASE WHEN {date} IS NULL THEN date_prelevement END"

    def report(src: str, kept: str, extra: str) -> str:
        return f"""SELECT count(*) AS rows_raw, count(*) FILTER (WHERE NOT lost AND {unparsed}) AS parse_failures,
  count(*) FILTER (WHERE NOT lost AND {bad_date}) AS bad_dates, count(*) FILTER (WHERE NOT lost AND {required}) AS rows_required,
  count(*) FILTER (WHERE NOT ({kept})) - {extra} AS rows_rejected,
  (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {src} WHERE {kept})) AS rows_silver,
  count(*) FILTER (WHERE {kept}) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {src} WHERE {kept})) AS duplicates_removed"""

    # a sum of doubles as an exact whole number of 2^-60 (the values have at least two digits before that)
    unit = "1152921504606846976"
    exact_mean = lambda c: f"(sum((CAST({c} AS DOUBLE) * {unit})::HUGEINT)::VARCHAR::DOUBLE / {unit}) / count({c})"
    trend = "SELECT annee, parametre_nom, avg(resultat_valeur_float) AS moyenne_resultat, count(*) AS nb_mesures FROM silver GROUP BY annee, parametre_nom"
    sql |= {
        "reject_rows": f"""{m} SELECT * FROM (SELECT CASE WHEN NOT ({cut}) THEN event_id END AS event_id,
  concat_ws(',', CASE WHEN {cut} THEN 'malformed' END, {missing}, CASE WHEN NOT ({cut}) AND {bad_date} THEN 'bad_date' END,
            CASE WHEN NOT ({cut}) AND {unparsed} THEN 'unparseable_result' END) AS reasons FROM m) WHERE reasons <> ''""",
        "reject_kept_rows": f"{m} SELECT * FROM m WHERE NOT ({cut}) AND {required} AND NOT {bad_date} AND NOT {unparsed}",
        "silver_report": f"""{m}, t AS (SELECT *, {cut} AS lost FROM m)
{report("t", f"NOT lost AND {required}", "0")}, count(*) FILTER (WHERE lost) AS rows_malformed FROM t""",
        "silver_window_report": f"""{m}, t AS (SELECT *, FALSE AS lost, {required} AND {date} IS NOT NULL AND NOT {inside} AS outside FROM m)
{report("t", f"coalesce({required} AND {inside}, FALSE)", "count(*) FILTER (WHERE outside)")},
  count(*) FILTER (WHERE outside) AS rows_outside FROM t""",
        "window_counts": f"""{m} SELECT count(*) AS rows_raw, count(*) FILTER (WHERE {inside}) AS rows_inside,
  count(*) FILTER (WHERE NOT ({inside})) AS rows_outside, count(*) FILTER (WHERE date_prelevement IS NULL) AS rows_without_date,
  count(*) FILTER (WHERE {bad_date}) AS bad_dates FROM m""",
        "paged_json_stats_unnumbered": f"""WITH p AS (SELECT event_id // {PAGE_SIZE} AS page, count(*) AS n FROM events GROUP BY 1)
SELECT count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_empty_pages, TRUE AS has_last_page,
  CAST(0 AS BIGINT) AS n_malformed, CAST(max(CASE WHEN page <> 1 THEN page END) FILTER (WHERE page = (SELECT max(page) FROM p)) AS BIGINT) AS end_page,
  CAST(0 AS BIGINT) AS n_repeated_pages, CAST(0 AS BIGINT) AS n_pages_after_end, count(*) FILTER (WHERE page = 1) AS n_unnumbered,
  CAST(0 AS BIGINT) AS n_missing_pages FROM p""",
        "incremental_silver": f"{silver_src} SELECT * FROM silver",
        "incremental_gold_conformity": f"{gold_status} SELECT * FROM conf",
        "incremental_gold_trend": f"{silver_src} {trend}",
        "silver_window_rerun": f"""{silver_src} SELECT * REPLACE (CASE WHEN date_prelevement_clean BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'
  THEN 'ug/L' ELSE libelle_unite END AS libelle_unite) FROM silver""",
        "silver_gate_states": f"{silver_src} " + _SILVER_GATE,
        "paged_json_landed_rows": f"{m} SELECT * FROM m",
        "categorize_rule_table": f"{m} SELECT event_id, libelle_parametre, {_sql_category('libelle_parametre')} AS categorie FROM m",
        "categorize_many_rules": """WITH o AS (SELECT o_orderkey, 'Order ' || CAST(o_orderkey * 7919 AS VARCHAR) AS o_name FROM orders),
r AS (SELECT CAST(round(c_acctbal) AS BIGINT) AS rank, c_mktsegment AS label, right(c_name, 4) AS keyword FROM customer),
best AS (SELECT o_name, arg_min(label, (rank, label)) AS label FROM (SELECT DISTINCT o_name FROM o) JOIN r ON contains(o_name, keyword) GROUP BY o_name)
SELECT o_orderkey, o_name, coalesce(label, 'none') AS segment FROM o LEFT JOIN best USING (o_name)""",
        "gold_trend_exact": f"{silver_src} {trend}",
        "gold_onepass_trend_exact": f"{silver_src} {trend}",
        "numeric_extremes_exact": f"{m} SELECT min(resultat_numerique) AS min, max(resultat_numerique) AS max, {exact_mean('resultat_numerique')} AS avg FROM m",
        "describe_numeric_exact": f"""{m} SELECT 'resultat_numerique' AS column_name, count(resultat_numerique) AS n,
  {exact_mean('resultat_numerique')} AS mean, min(resultat_numerique) AS min, max(resultat_numerique) AS max FROM m
UNION ALL SELECT 'event_id', count(event_id), avg(event_id), CAST(min(event_id) AS DOUBLE), CAST(max(event_id) AS DOUBLE) FROM m""",
    }
    return sql


def oracle_sql() -> dict[str, str]:
    return _oracle()
