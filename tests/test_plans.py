"""Silver, gold, gates, raw profile and an end-to-end run on the measurement view of sf0.001."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from hydrix import bindings as B
from hydrix.operators.quality import CheckFailed, assert_checks
from hydrix.plans import (
    build_gold,
    build_silver,
    category_is,
    cleaning_report,
    gold_gate,
    raw_profile,
    read_bronze,
    run_medallion,
    silver_gate,
    silver_gate_at,
    status_is,
)
from hydrix.plans.silver import SilverSpec
from hydrix.session import Scratch, scratch_path, scratch_root
from hydrix.sources import write_json, write_pages


@pytest.fixture(scope="module")
def m(spark):
    df = B.m_view(spark, SF_SMALL).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def silver(spark, m):
    df = build_silver(m, B.SILVER_SPEC).cache()
    yield df
    df.unpersist()


def test_fixture_counts(m, silver):
    agg = m.agg(F.count(F.lit(1)), F.count("resultat_alphanumerique"), F.count("date_prelevement")).first()
    assert tuple(agg) == (1000, 800, 990)
    assert silver.count() == 880
    assert silver.agg(F.count("resultat_valeur_float"), F.count("annee")).first()[:] == (530, 862)
    cats = {r.categorie: r["count"] for r in silver.groupBy("categorie").count().collect()}
    assert cats == {
        "Autre": 197, "Chimie_Metaux": 95, "Chimie_Pesticides": 190,
        "Microbiologie": 100, "Physico-Chimie": 200, "Radioactivité": 98,
    }


def test_silver_schema(silver):
    types = dict(silver.dtypes)
    assert types["date_prelevement_clean"] == "date" and types["annee"] == "int"
    assert types["resultat_valeur_float"] == "float" and types["categorie"] == "string"
    assert {"parametre_nom", "commune", "departement", "code_dept"} <= set(silver.columns)
    assert not {"libelle_parametre", "nom_commune"} & set(silver.columns)


def test_silver_default_tie_break_is_deterministic(spark, m):
    spec = SilverSpec()  # tie-break on every other column
    a = sorted(map(repr, build_silver(m.repartition(3), spec).collect()))
    b = sorted(map(repr, build_silver(m.repartition(5, "event_id"), spec).collect()))
    assert a == b and len(a) == 880


def test_cleaning_report(m):
    r = cleaning_report(m).first()
    assert (r.rows_raw, r.parse_failures, r.rows_required) == (1000, 200, 966)


def test_gold_tables(silver):
    lit = build_gold(silver, category_is())
    conf = {r.commune: r for r in lit["conformite_commune"].collect()}
    assert len(conf) == 15
    assert (conf["C0"].total_tests, conf["C0"].nb_conformes, conf["C0"].nb_non_conformes) == (51, 0, 51)
    assert all(r.taux_conformite == 0.0 for r in conf.values())
    assert lit["evolution_temporelle"].count() == 18
    assert lit["non_conformites_parametre"].count() == 9
    worst = [r.commune for r in lit["top_10_pires_communes"].collect()]
    assert worst == sorted(conf)[:10]  # every rate ties at 0: the place name decides
    st = {r.commune: r for r in build_gold(silver, status_is("CONFORME"))["conformite_commune"].collect()}
    assert (st["C0"].total_tests, st["C0"].nb_conformes, st["C0"].nb_non_conformes) == (51, 15, 15)


def test_gates(silver):
    res = {(r.table_name, r.check_name, r.column_name): r for r in silver_gate(silver).collect()}
    bad = res.pop(("silver", "rule", "date_prelevement"))
    assert (bad.status, bad.unexpected_count) == ("failed", 9)
    assert len(res) == 5 and all(r.status == "passed" for r in res.values())
    gold = build_gold(silver, category_is())
    g = gold_gate(gold).collect()
    assert len(g) == 9 and all(r.success for r in g)
    assert_checks(gold_gate(gold), "raise")


def test_gold_gate_catches_bad_rate(spark, silver):
    gold = build_gold(silver, category_is())
    gold["conformite_commune"] = gold["conformite_commune"].withColumn("taux_conformite", F.lit(1.5))
    with pytest.raises(CheckFailed):
        assert_checks(gold_gate(gold), "raise")


def test_raw_profile_sections(m):
    prof = raw_profile(m).collect()
    sections = {r.section for r in prof}
    assert sections == {"rows", "describe", "nulls", "extremes", "distribution"}
    rows = [r for r in prof if r.section == "rows"][0]
    assert rows.value == 1000.0
    depts = sum(r.value for r in prof if r.section == "distribution" and r.column_name == "nom_departement")
    assert depts == 1000.0


def test_medallion_end_to_end(spark, m):
    root = scratch_path(spark, "t-run")
    path = write_pages(m, f"{root}/bronze", 250, "event_id")
    bronze = read_bronze(spark, path, fmt="pages", row_schema=m.schema)
    res = run_medallion(spark, bronze, root)
    assert res.report == {
        "rows_raw": 1000, "parse_failures": 200, "bad_dates": 9, "rows_required": 966, "rows_rejected": 34, "rows_silver": 880,
        "duplicates_removed": 86,
    }
    assert len(res.checks) == 15 and [r["column_name"] for r in res.checks if not r["success"]] == ["date_prelevement"]
    assert spark.read.parquet(res.gold_paths["top_10_pires_communes"]).count() == 10
    assert silver_gate_at(spark, res.silver_path).count() == 6
    assert silver_gate_at(spark, f"{root}/nothing-here", on_missing="skip") is None


def test_medallion_from_jsonl(spark, m):
    root = scratch_path(spark, "t-run-jsonl")
    path = write_json(m, f"{root}/bronze")
    res = run_medallion(spark, read_bronze(spark, path, row_schema=m.schema), root, predicate=status_is("CONFORME"))
    conf = {r.commune: r for r in spark.read.parquet(res.gold_paths["conformite_commune"]).collect()}
    assert conf["C0"].nb_conformes == 15


def test_one_pass_gold_equals_separate_tables(silver):
    from hydrix.plans.gold import GoldSpec, gold_aggregate, split_gold

    for pred in (category_is(), status_is("CONFORME")):
        spec = GoldSpec(trend_round=6)
        one = split_gold(gold_aggregate(silver, pred, spec), spec)
        sep = build_gold(silver, pred, spec)
        for name in sep:
            a = sorted(map(repr, one[name].collect()))
            b = sorted(map(repr, sep[name].collect()))
            assert a == b, name
            assert one[name].columns == sep[name].columns


def test_one_pass_gold_is_one_shuffle(spark, silver):
    import contextlib
    import io

    from hydrix.plans.gold import gold_aggregate
    from hydrix.session import stage

    written = stage(silver, "t-silver")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        gold_aggregate(written, category_is()).explain()
    text = buf.getvalue()
    assert "Expand" in text and text.count("Exchange hashpartitioning") == 1


def test_partitioned_silver_prunes_years(spark, m):
    import contextlib
    import io

    from hydrix.operators import date_window
    from hydrix.sources import read_parquet

    root = scratch_path(spark, "t-run-part")
    path = write_json(m, f"{root}/bronze")
    bronze = read_bronze(spark, path, row_schema=m.schema, partitions=4)
    res = run_medallion(spark, bronze, root, silver_spec=B.SILVER_SPEC, silver_partition_by=("annee",))
    silver = read_parquet(spark, res.silver_path)
    win = date_window(silver, "date_prelevement_clean", "2024-01-10", "2024-01-20", year_col="annee")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        win.explain()
    assert re.search(r"PartitionFilters: \[isnotnull\(annee#\d+\), \(annee#\d+ >= 2024\), \(annee#\d+ <= 2024\)\]", buf.getvalue())
    assert win.count() == date_window(silver, "date_prelevement_clean", "2024-01-10", "2024-01-20").count() > 0
    assert res.report["rows_silver"] == 880


def test_malformed_bronze_lines_are_counted(spark, m):
    import os

    root = scratch_path(spark, "t-bad-bronze")
    path = write_json(m, f"{root}/bronze")
    local = path[len("file:"):] if path.startswith("file:") else path
    with open(os.path.join(local, "zz-extra.json"), "w") as f:
        f.write("{not json at all\n")
    bronze = read_bronze(spark, path, row_schema=m.schema, corrupt_column="_corrupt_record")
    r = cleaning_report(bronze, B.SILVER_SPEC, corrupt_column="_corrupt_record").first()
    assert (r.rows_raw, r.rows_malformed) == (1001, 1)
    assert build_silver(bronze, B.SILVER_SPEC).count() == 880  # the malformed line has no keys


def test_split_gold_refuses_another_spec(silver):
    from hydrix.plans.gold import GoldSpec, gold_aggregate, split_gold

    spec = GoldSpec(group=("commune", "departement"))
    agg = gold_aggregate(silver, category_is(), spec)
    assert split_gold(agg, spec)["conformite_commune"].count() == 15
    with pytest.raises(ValueError, match="same GoldSpec"):
        split_gold(agg)


def test_read_bronze_pages_with_crawl_rules(spark, m):
    root = scratch_path(spark, "t-crawl-bronze")
    path = write_pages(m, f"{root}/bronze", 300, "event_id", with_page=True)
    bronze = read_bronze(spark, path, fmt="pages", row_schema=m.schema, page_col="page")
    assert bronze.count() == 1000


def test_silver_with_renamed_result_column(spark, m):
    from hydrix.plans.silver import DEFAULT_RENAMES

    renames = dict(DEFAULT_RENAMES, resultat_alphanumerique="resultat_texte")
    spec = SilverSpec(renames=renames, tie_break=("event_id",))
    out = build_silver(m, spec)
    assert "resultat_texte" in out.columns and "resultat_alphanumerique" not in out.columns
    assert out.count() == 880 and out.filter("resultat_valeur_float IS NOT NULL").count() == 530


def test_cleaning_report_with_renamed_result_column(m):
    from hydrix.plans.silver import DEFAULT_RENAMES

    spec = SilverSpec(renames=dict(DEFAULT_RENAMES, resultat_alphanumerique="resultat_texte"))
    r = cleaning_report(m, spec).first()
    assert (r.rows_raw, r.parse_failures, r.rows_required) == (1000, 200, 966)


class _Master:
    """Just what scratch_root asks of a session."""

    def __init__(self, master):
        self.master, self.sparkContext, self.conf = master, self, {}

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"])
def test_no_machine_local_scratch_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_Master(master))


def test_scratch_tables_are_removed_by_their_owner(spark):
    import os

    with Scratch(spark, "owner") as s:
        gone, kept = s.stage(spark.range(3), "a"), s.stage(spark.range(4), "b", keep=True)
        assert gone.count() == 3
    assert kept.count() == 4
    path = gone._scratch_path.removeprefix("file:")
    assert not os.path.exists(path) and os.path.exists(os.path.dirname(path))
