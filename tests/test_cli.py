"""The command line drives each step of a run on the measurement view of sf0.001."""

import json

from conftest import SF_SMALL
from hydrix import bindings as B
from hydrix.__main__ import main
from hydrix.session import scratch_path
from hydrix.sources import read_parquet, write_json, write_pages


def test_cli_steps(spark, capsys):
    m = B.m_view(spark, SF_SMALL)
    root = scratch_path(spark, "t-cli")
    bronze = write_json(m, f"{root}/landing-jsonl")
    assert main(["silver-quality", "--out", root, "--on-missing", "skip"], spark) == 0
    assert "checks skipped" in capsys.readouterr().out

    assert main(["silver", "--bronze", bronze, "--out", root], spark) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["rows_raw"] == 1000 and report["parse_failures"] == 200
    # the default tie-break keeps one row per key, as with the event_id tie-break
    assert report["rows_silver"] == 880

    assert main(["gold", "--out", root, "--status", "CONFORME"], spark) == 0
    conf = {r.commune: r for r in read_parquet(spark, f"{root}/gold/conformite_commune").collect()}
    assert (conf["C0"].total_tests, conf["C0"].nb_conformes) == (51, 15)
    assert read_parquet(spark, f"{root}/gold/top_10_pires_communes").count() == 10

    assert main(["silver-quality", "--out", root, "--on-failure", "raise"], spark) == 1  # bad dates
    assert "FAIL silver.parses as a date" in capsys.readouterr().out
    assert main(["gold-quality", "--out", root], spark) == 0
    text = capsys.readouterr().out
    assert "PASS conformite_commune.taux_conformite between 0 and 1" in text and "FAIL" not in text

    assert main(["profile", "--bronze", bronze, "--out", root], spark) == 0
    assert read_parquet(spark, f"{root}/profile").filter("section = 'rows'").first().value == 1000.0


def test_cli_ingest_then_run(spark, capsys):
    m = B.m_view(spark, SF_SMALL)
    root = scratch_path(spark, "t-cli-run")
    write_pages(m, f"{root}/landing/batch1", 200, "event_id")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in m.schema.fields)
    assert main(["ingest", "--landing", f"{root}/landing/*", "--bronze", f"{root}/bronze", "--schema", ddl,
                 "--checkpoint", f"{root}/ckpt"], spark) == 0
    assert main(["run", "--bronze", f"{root}/bronze", "--format", "parquet", "--out", f"{root}/out"], spark) == 0
    out = capsys.readouterr().out
    assert '"rows_silver": 880' in out and out.count("FAIL") == 1  # the bad dates
    # a blocking run stops at the silver checks
    assert main(["run", "--bronze", f"{root}/bronze", "--format", "parquet", "--out", f"{root}/strict", "--on-failure", "raise"], spark) == 1
    assert read_parquet(spark, f"{root}/strict/gold/conformite_commune", on_missing="skip") is None


def test_cli_pipeline_arguments(spark, capsys):
    import os

    m = B.m_view(spark, SF_SMALL)
    root = scratch_path(spark, "t-cli-args")
    path = write_json(m, f"{root}/landing")
    with open(os.path.join(path.removeprefix("file:"), "zz-extra.json"), "w") as f:
        f.write("{broken\n")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in m.schema.fields)
    common = ["--bronze", path, "--schema", ddl, "--corrupt-column", "_bad", "--tie-break", "event_id"]
    assert main(["silver", *common, "--out", f"{root}/a", "--partition-by", "annee", "--silver-table", "s"], spark) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (report["rows_raw"], report["rows_malformed"], report["rows_silver"], report["bad_dates"]) == (1001, 1, 880, 9)
    silver = read_parquet(spark, f"{root}/a/silver/s")
    assert "_bad" not in silver.columns and os.path.isdir(f"{root}/a/silver/s/annee=2024".removeprefix("file:"))
    assert main(["silver", *common, "--out", f"{root}/b", "--start", "2024-01-10", "--end", "2024-01-12"], spark) == 0
    days = read_parquet(spark, f"{root}/b/silver/measurements").selectExpr("min(date_prelevement_clean) a", "max(date_prelevement_clean) b").first()
    assert (str(days.a), str(days.b)) == ("2024-01-10", "2024-01-12")
    capsys.readouterr()


def test_cli_page_column(spark, capsys):
    m = B.m_view(spark, SF_SMALL)
    root = scratch_path(spark, "t-cli-pages")
    write_pages(m, f"{root}/landing/a", 200, "event_id", with_page=True)
    write_pages(m, f"{root}/landing/b", 200, "event_id", with_page=True)  # every page landed twice
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in m.schema.fields)
    args = ["silver", "--bronze", f"{root}/landing/*", "--format", "pages", "--schema", ddl, "--page-col", "page", "--out", root]
    assert main(args, spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows_raw"] == 1000
