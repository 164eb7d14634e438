"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator binding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrix.bindings.inputs import (
    GOLD_SPEC,
    K,
    PAGE_SIZE,
    SILVER_SPEC,
    STATUS_OK,
    WINDOW,
    _f_pred,
    _orders,
    m_view,
    silver_m,
    table,
)
from hydrix.functions.dates import iso_date_part, parse_date, year_of
from hydrix.functions.measures import parse_measurement
from hydrix.operators import quality as Q
from hydrix.operators.columns import (
    count_parse_failures,
    date_window,
    parse_failures,
    require_fields,
    standardize_columns,
)
from hydrix.operators.dedup import dedup_keys, dedup_stats
from hydrix.operators.metrics import (
    conformity_by_group,
    distinct_values,
    nonconformity_by_group,
    value_counts,
    worst_k,
    yearly_trend,
)
from hydrix.operators.rejects import write_split
from hydrix.operators.rule_tables import KEYWORD, LABEL, RANK, categorize_by_table, rule_table
from hydrix.operators.profile import describe_numeric, null_profile, numeric_extremes
from hydrix.plans.explore import raw_profile
from hydrix.plans.gate_states import gate_partitions
from hydrix.plans.gates import gold_gate, silver_gate, source_silver_checks
from hydrix.plans.gold import GoldSpec, build_gold, category_is, gold_aggregate, split_gold, status_is
from hydrix.plans.incremental import merge_batch, publish_gold, rerun_window
from hydrix.plans.medallion import read_bronze, silver_path_of, write_silver
from hydrix.plans.silver import (
    BAD_DATE,
    DEFAULT_RENAMES,
    DEFECTS,
    bad_date,
    build_silver,
    clean,
    reject_rules,
    window_counts,
)
from hydrix.session import scratch_path, stage
from hydrix.sources.files import read_json, read_parquet, write_json, write_parquet, written_counts
from hydrix.sources.paged import crawl_landed, page_rows, page_stats, read_pages, write_pages
from hydrix.sources.preview import preview_rows
from hydrix.streaming.landing import land_pages




def q_conformity_by_group(spark, sf_dir):
    return conformity_by_group(_orders(spark, sf_dir), ["o_custkey"], _f_pred())


def q_worst_k(spark, sf_dir):
    return worst_k(q_conformity_by_group(spark, sf_dir), K, keys=["o_custkey"])


def q_yearly_trend(spark, sf_dir):
    return yearly_trend(
        _orders(spark, sf_dir), year_of("o_orderdate").alias("annee"), ["o_orderpriority"], "o_totalprice",
        round_digits=4,
    )


def q_nonconformity_by_group(spark, sf_dir):
    return nonconformity_by_group(_orders(spark, sf_dir), ["o_orderpriority"], _f_pred())


def q_value_counts(spark, sf_dir):
    return value_counts(silver_m(spark, sf_dir), "categorie")


def q_parse_measurement(spark, sf_dir):
    m = m_view(spark, sf_dir)
    return m.select("event_id", "resultat_alphanumerique",
                    parse_measurement("resultat_alphanumerique").alias("resultat_valeur_float"))


def q_parse_measurement_censored_null(spark, sf_dir):
    m = m_view(spark, sf_dir)
    return m.select("event_id", "resultat_alphanumerique",
                    parse_measurement("resultat_alphanumerique", censored="null").alias("resultat_valeur_float"))


def q_parse_failures(spark, sf_dir):
    return count_parse_failures(clean(m_view(spark, sf_dir), SILVER_SPEC), "resultat_alphanumerique",
                                "resultat_valeur_float")


def q_categorize_keywords(spark, sf_dir):
    return clean(m_view(spark, sf_dir), SILVER_SPEC).select("event_id", "parametre_nom", "categorie")


def q_clean_dates(spark, sf_dir):
    m = m_view(spark, sf_dir)
    d = parse_date("date_prelevement")
    return m.select("event_id", "date_prelevement", d.alias("date_prelevement_clean"), year_of(d).alias("annee"))


def q_iso_date_part(spark, sf_dir):
    return m_view(spark, sf_dir).select("event_id", iso_date_part("date_prelevement").alias("date_text"))


def q_date_window(spark, sf_dir):
    m = m_view(spark, sf_dir).withColumn("date_prelevement_clean", parse_date("date_prelevement"))
    return date_window(m, "date_prelevement_clean", *WINDOW).select("event_id", "date_prelevement_clean")


def q_standardize_columns(spark, sf_dir):
    return standardize_columns(m_view(spark, sf_dir), DEFAULT_RENAMES)


def q_require_fields(spark, sf_dir):
    return require_fields(m_view(spark, sf_dir), ["code_prelevement", "libelle_parametre", "nom_commune"])


def q_dedup_keys(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return dedup_keys(ev, ["user_id", "event_type", "day"], ["event_id"])


def q_dedup_stats(spark, sf_dir):
    m = m_view(spark, sf_dir).withColumn("date_prelevement_clean", parse_date("date_prelevement"))
    return dedup_stats(m.withColumn(BAD_DATE, bad_date(SILVER_SPEC)), [*SILVER_SPEC.dedup_keys, BAD_DATE])


def q_distinct_pairs(spark, sf_dir):
    return distinct_values(clean(m_view(spark, sf_dir), SILVER_SPEC), ["parametre_nom", "categorie"])


def q_numeric_extremes(spark, sf_dir):
    return numeric_extremes(m_view(spark, sf_dir), "resultat_numerique", digits=6)


def q_describe_numeric(spark, sf_dir):
    return describe_numeric(m_view(spark, sf_dir), digits=6)


def q_null_profile(spark, sf_dir):
    return null_profile(m_view(spark, sf_dir))


def q_paged_json_rows(spark, sf_dir):
    m = m_view(spark, sf_dir)
    path = write_pages(m, scratch_path(spark, "pages"), PAGE_SIZE, "event_id")
    return page_rows(read_pages(spark, path, m.schema))


def q_paged_json_stats(spark, sf_dir):
    m = m_view(spark, sf_dir)
    path = write_pages(m, scratch_path(spark, "pages"), PAGE_SIZE, "event_id")
    return page_stats(read_pages(spark, path, m.schema))


def q_paged_json_crawl_rows(spark, sf_dir):
    """S1 with the paging rules.  The landing also holds a re-requested last page, an empty copy of page
    1 and a stray page past the end (a copy of the first page under a later number); every M row comes
    out once."""
    return page_rows(_crawl_landing(spark, sf_dir), page_col="page")


def _crawl_landing(spark, sf_dir, extra=()):
    m = m_view(spark, sf_dir)
    path = write_pages(m, scratch_path(spark, "pages-crawl"), PAGE_SIZE, "event_id", with_page=True)
    pages = read_pages(spark, path, m.schema, with_page=True)
    repeated_last = pages.filter(F.col("next").isNull())
    empty_copy = pages.filter(F.col("page") == 1).withColumns({"data": F.slice("data", 1, 0), "next": F.lit(None).cast("string")})
    stray = pages.filter(F.col("page") == 0).withColumn("page", F.lit(10**9).cast("long"))
    return pages.unionByName(repeated_last).unionByName(empty_copy).unionByName(stray)


def q_paged_json_stats_numbered(spark, sf_dir):
    """S2 on a landing with a repeated last page, an empty copy beside a full one, a gap (page 2), a
    page past the end and a malformed envelope (the first page's text cut short)."""
    pages = _crawl_landing(spark, sf_dir).filter("page is null or page <> 2")
    broken = pages.filter("page = 0").limit(1).withColumns({
        "page": F.lit(None).cast("long"), "data": F.slice("data", 1, 0), "next": F.lit(None).cast("string"),
        "_corrupt_page": F.substring(F.to_json("data"), 1, 40),
    })
    return page_stats(pages.unionByName(broken), page_col="page")


def q_silver_window(spark, sf_dir):
    """S3 in the pipeline: silver over the rows of a period, as read from bronze Parquet."""
    path = write_parquet(m_view(spark, sf_dir), scratch_path(spark, "bronze-window"))
    return build_silver(read_bronze(spark, path, fmt="parquet", window=WINDOW), SILVER_SPEC)


def q_jsonl_roundtrip(spark, sf_dir):
    m = m_view(spark, sf_dir)
    return read_json(spark, write_json(m, scratch_path(spark, "jsonl")), m.schema)


def q_jsonl_roundtrip_inferred(spark, sf_dir):
    """S5 as the source uses it: no declared schema, Spark infers one (an extra pass over the files)."""
    return read_json(spark, write_json(m_view(spark, sf_dir), scratch_path(spark, "jsonl-inferred")))


def q_parquet_roundtrip(spark, sf_dir):
    return read_parquet(spark, write_parquet(m_view(spark, sf_dir), scratch_path(spark, "parquet")))


def q_silver_verify(spark, sf_dir):
    path = write_parquet(silver_m(spark, sf_dir), scratch_path(spark, "silver"))
    return written_counts(spark, path, "categorie")


def q_preview_rows(spark, sf_dir):
    return preview_rows(table(spark, sf_dir, "events"), K, order_by=["event_id"])


def q_silver_layer(spark, sf_dir):
    return silver_m(spark, sf_dir)


def _gold(spark, sf_dir, predicate=None):
    return build_gold(silver_m(spark, sf_dir), category_is() if predicate is None else predicate, GOLD_SPEC)


def q_gold_conformity(spark, sf_dir):
    return _gold(spark, sf_dir)["conformite_commune"]


def q_gold_conformity_status(spark, sf_dir):
    return _gold(spark, sf_dir, status_is(STATUS_OK))["conformite_commune"]


def q_gold_trend(spark, sf_dir):
    return _gold(spark, sf_dir)["evolution_temporelle"]


def q_gold_worst_k(spark, sf_dir):
    return _gold(spark, sf_dir)["top_10_pires_communes"]


def q_gold_nonconformity(spark, sf_dir):
    return _gold(spark, sf_dir)["non_conformites_parametre"]


def q_check_not_null(spark, sf_dir):
    return Q.check_not_null(m_view(spark, sf_dir), ["code_prelevement", "nom_commune", "libelle_parametre"], "raw")


def q_check_between(spark, sf_dir):
    # both range rules in one aggregate pass over silver
    checks = [Q.between("annee", 2000, 2030), Q.between("resultat_valeur_float", 0, 100)]
    return Q.run_checks(silver_m(spark, sf_dir), checks, "silver")


def q_check_min(spark, sf_dir):
    checks = [Q.greater_than("total_tests", 0), Q.at_least("nb_conformes", 1)]
    return Q.run_checks(q_conformity_by_group(spark, sf_dir), checks, "conformity")


def q_check_min_tolerance(spark, sf_dir):
    checks = [Q.at_least_mostly("resultat_numerique", 0), Q.at_least_mostly("resultat_numerique", 10)]
    return Q.run_checks(m_view(spark, sf_dir), checks, "raw")


def q_check_suite(spark, sf_dir):
    return silver_gate(silver_m(spark, sf_dir), source_silver_checks())


def q_check_suite_summary(spark, sf_dir):
    return Q.suite_summary(q_check_suite(spark, sf_dir))


def _gold_staged(spark, sf_dir):
    """Gold tables as the end-to-end run produces them: one grouping-sets aggregate over silver
    (silver's only consumer, so it is computed once inside that job) written once, the tables split
    from it, the gates reading the written aggregate."""
    return split_gold(stage(gold_aggregate(silver_m(spark, sf_dir), category_is(), GOLD_SPEC), "gold-aggregate"), GOLD_SPEC)


def q_check_aggregate_consistency(spark, sf_dir):
    g = _gold_violated(spark, sf_dir)
    return Q.aggregate_consistency(g["conformite_commune"], g["top_10_pires_communes"], ["commune"], "conformite_commune")


def q_silver_gate(spark, sf_dir):
    return silver_gate(silver_m(spark, sf_dir))


def q_gold_gate(spark, sf_dir):
    return gold_gate(_gold_violated(spark, sf_dir), GOLD_SPEC)


def _gold_violated(spark, sf_dir):
    """The gold tables as a faulty job might leave them: the conformity table lost place C7, counts
    place C3's conforming rows double and one too many, and gives C5 a rate above 1."""
    g = dict(_gold_staged(spark, sf_dir))
    conf = g["conformite_commune"].filter("commune is null or commune <> 'C7'")
    g["top_10_pires_communes"] = g["conformite_commune"].filter("commune in ('C7', 'C8')")
    g["conformite_commune"] = conf.withColumns({
        "nb_conformes": F.when(F.col("commune") == "C3", F.col("total_tests") + 1).otherwise(F.col("nb_conformes")),
        "taux_conformite": F.when(F.col("commune") == "C5", F.lit(1.5)).otherwise(F.col("taux_conformite")),
    })
    return g


def q_raw_profile(spark, sf_dir):
    return raw_profile(m_view(spark, sf_dir))


def _gold_one_pass(spark, sf_dir):
    return split_gold(gold_aggregate(silver_m(spark, sf_dir), status_is(STATUS_OK), GOLD_SPEC), GOLD_SPEC)


def q_gold_onepass_conformity(spark, sf_dir):
    return _gold_one_pass(spark, sf_dir)["conformite_commune"]


def q_gold_onepass_trend(spark, sf_dir):
    return _gold_one_pass(spark, sf_dir)["evolution_temporelle"]


def q_gold_onepass_nonconformity(spark, sf_dir):
    return _gold_one_pass(spark, sf_dir)["non_conformites_parametre"]


def q_gold_onepass_worst_k(spark, sf_dir):
    return _gold_one_pass(spark, sf_dir)["top_10_pires_communes"]


def q_parse_failure_rows(spark, sf_dir):
    typed = clean(m_view(spark, sf_dir), SILVER_SPEC)
    return parse_failures(typed, "resultat_alphanumerique", "resultat_valeur_float").select(
        "event_id", "resultat_alphanumerique")


def q_out_of_range_rows(spark, sf_dir):
    rows = Q.failing_rows(silver_m(spark, sf_dir), Q.between("resultat_valeur_float", 0, 100))
    return rows.select("event_id", "resultat_valeur_float")


def q_below_minimum_rows(spark, sf_dir):
    """The rows below a lower bound."""
    rows = Q.failing_rows(silver_m(spark, sf_dir), Q.at_least("resultat_valeur_float", 10))
    return rows.select("event_id", "resultat_valeur_float")


def q_null_rows(spark, sf_dir):
    """The rows with a NULL in a field that must not be."""
    return Q.failing_rows(m_view(spark, sf_dir), Q.not_null("nom_commune")).select("event_id", "nom_departement")


def q_department_counts(spark, sf_dir):
    return value_counts(m_view(spark, sf_dir), "nom_departement")


def q_parameter_type_counts(spark, sf_dir):
    return value_counts(m_view(spark, sf_dir), "code_type_parametre", sort=False)


def q_status_counts(spark, sf_dir):
    return value_counts(m_view(spark, sf_dir), "conclusion_conformite_prelevement", sort=False)


def _landing_lines(spark, sf_dir):
    """M as landed JSON lines, of which some were cut short; the cut ones are kept in ``_corrupt_record``."""
    m = m_view(spark, sf_dir)
    line = F.to_json(F.struct(*m.columns))
    cut = F.when(F.col("event_id") % 211 == 0, F.substring(line, 1, 40)).otherwise(line)
    path = scratch_path(spark, "cut-lines")
    m.select(cut.alias("value")).write.text(path)
    return read_bronze(spark, path, row_schema=m.schema, corrupt_column="_corrupt_record")


def _split_all_defects(spark, sf_dir):
    rules = reject_rules(SILVER_SPEC, drop=DEFECTS, corrupt_column="_corrupt_record")
    return write_split(_landing_lines(spark, sf_dir), scratch_path(spark, "split"), rules)


def q_reject_rows(spark, sf_dir):
    """The written rejects, with the codes of all their defects."""
    return _split_all_defects(spark, sf_dir).rejects.select("event_id", F.array_join("reject_reasons", ",").alias("reasons"))


def q_reject_kept_rows(spark, sf_dir):
    """The rows without any defect; with the rejects they are all rows of the landing."""
    return _split_all_defects(spark, sf_dir).kept.drop("_corrupt_record")


def q_silver_report(spark, sf_dir):
    """The cleaning report observed in the writes of silver and the rejects."""
    _, _, report = write_silver(
        spark, _landing_lines(spark, sf_dir), scratch_path(spark, "report"), SILVER_SPEC, corrupt_column="_corrupt_record"
    )
    return spark.createDataFrame([report], ", ".join(f"{k} long" for k in sorted(report)))


def q_silver_window_report(spark, sf_dir):
    """S3: what a date window keeps, leaves out and cannot place, from the writes."""
    bronze = read_parquet(spark, write_parquet(m_view(spark, sf_dir), scratch_path(spark, "bronze-window")))
    _, _, report = write_silver(spark, bronze, scratch_path(spark, "window-report"), SILVER_SPEC, window=WINDOW)
    return spark.createDataFrame([report], ", ".join(f"{k} long" for k in sorted(report)))


def q_window_counts(spark, sf_dir):
    return window_counts(m_view(spark, sf_dir), WINDOW, SILVER_SPEC)


def q_paged_json_stats_unnumbered(spark, sf_dir):
    """S2 on a landing whose page 1 lost its number."""
    m = m_view(spark, sf_dir)
    path = write_pages(m, scratch_path(spark, "pages-unnumbered"), PAGE_SIZE, "event_id", with_page=True)
    pages = read_pages(spark, path, m.schema, with_page=True)
    return page_stats(pages.withColumn("page", F.when(F.col("page") != 1, F.col("page"))), page_col="page")


EXACT_SPEC = GoldSpec(exact_means=True)


def q_gold_trend_exact(spark, sf_dir):
    """A3 with exact sums, unrounded."""
    return build_gold(silver_m(spark, sf_dir), category_is(), EXACT_SPEC)["evolution_temporelle"]


def q_gold_onepass_trend_exact(spark, sf_dir):
    return split_gold(gold_aggregate(silver_m(spark, sf_dir), status_is(STATUS_OK), EXACT_SPEC), EXACT_SPEC)["evolution_temporelle"]


def q_numeric_extremes_exact(spark, sf_dir):
    """A7 with an exact sum, unrounded."""
    return numeric_extremes(m_view(spark, sf_dir), "resultat_numerique", exact=True)


def q_describe_numeric_exact(spark, sf_dir):
    """A8's means with exact sums, unrounded; the deviation is left out (it stays a floating sum)."""
    return describe_numeric(m_view(spark, sf_dir), exact=True).drop("stddev")


def _merged(spark, sf_dir):
    """M taken in as three batches, whose keys meet across batches; the root folder."""
    m, root = m_view(spark, sf_dir), scratch_path(spark, "batches")
    for i in (2, 0, 1):
        merge_batch(spark, m.filter(F.col("event_id") % 3 == i), root, f"batch-{i}", status_is(STATUS_OK), spec=SILVER_SPEC)
    return root


def q_incremental_silver(spark, sf_dir):
    """A11 across batches: the rows of one full build."""
    return read_parquet(spark, silver_path_of(_merged(spark, sf_dir)))


def _merged_gold(spark, sf_dir, name):
    root = _merged(spark, sf_dir)
    publish_gold(spark, root)
    return read_parquet(spark, f"{root}/gold/{name}")


def q_incremental_gold_conformity(spark, sf_dir):
    """L2 from the states of three batches: the table of one full build."""
    return _merged_gold(spark, sf_dir, "conformite_commune")


def q_incremental_gold_trend(spark, sf_dir):
    return _merged_gold(spark, sf_dir, "evolution_temporelle")


def q_silver_window_rerun(spark, sf_dir):
    """Silver whose rows of one window were built anew (from rows in another unit); all others stay."""
    m, path = m_view(spark, sf_dir), scratch_path(spark, "rerun")
    write_parquet(build_silver(m, SILVER_SPEC), path, partition_by=("annee",))
    rerun_window(spark, m.withColumn("libelle_unite", F.lit("ug/L")), path, WINDOW, spec=SILVER_SPEC)
    return read_parquet(spark, path)


def _gated_twice(spark, sf_dir):
    """Silver by department, gated before and after the last department and a second part of another came in."""
    silver, root = silver_m(spark, sf_dir), scratch_path(spark, "gate-states")
    late = (F.col("code_dept") == "3") | ((F.col("code_dept") == "5") & (F.col("annee").isNull() | F.col("commune").endswith("5")))
    path = write_parquet(silver.filter(~late), f"{root}/table", partition_by=("code_dept",))
    gate_partitions(spark, path, f"{root}/states", "code_dept")
    write_parquet(silver.filter(late), path, mode="append", partition_by=("code_dept",))
    return gate_partitions(spark, path, f"{root}/states", "code_dept")


def q_silver_gate_states(spark, sf_dir):
    """L3, Q1-Q6 from stored states: the rows of a full gate, though only two partitions are scanned again."""
    return _gated_twice(spark, sf_dir).results


def q_paged_json_landed_rows(spark, sf_dir):
    """S1, S2 from a landing with manifest: page 1 was landed twice, page 2 lost its rows in one of two copies."""
    m, root = m_view(spark, sf_dir), scratch_path(spark, "pages-manifest")
    first = write_pages(m, f"{root}/json/first", PAGE_SIZE, "event_id", with_page=True)
    envelopes = read_pages(spark, first, m.schema, with_page=True)
    again = envelopes.filter("page = 1").unionByName(
        envelopes.filter("page = 2").withColumn("data", F.slice("data", 1, 0)))
    write_json(again.drop("_corrupt_page"), f"{root}/json/again")
    land_pages(spark, f"{root}/json/*", f"{root}/pages", m.schema).awaitTermination()
    return page_rows(crawl_landed(read_parquet(spark, f"{root}/pages")))


def q_categorize_rule_table(spark, sf_dir):
    """F5 with the rules as a table: the families of every row's parameter name."""
    m = m_view(spark, sf_dir).select("event_id", "libelle_parametre")
    return categorize_by_table(m, "libelle_parametre", rule_table(spark))


def q_categorize_many_rules(spark, sf_dir):
    """F5 with a rule for every customer: a keyword of the last digits of its name, ranked by balance."""
    customers = table(spark, sf_dir, "customer")
    rules = customers.select(
        F.round("c_acctbal").cast("long").alias(RANK), F.col("c_mktsegment").alias(LABEL), F.expr("right(c_name, 4)").alias(KEYWORD))
    orders = _orders(spark, sf_dir).select("o_orderkey", F.concat(F.lit("Order "), F.col("o_orderkey") * 7919).alias("o_name"))
    return categorize_by_table(orders, "o_name", rules, "segment", "none")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
