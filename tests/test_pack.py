from __future__ import annotations

from pyspark.sql import functions as F

from conftest import TextTables, subscribed
from revlattice.plans import pack, reports
from revlattice.sources import tables as sources
from revlattice.testbed.queries import QUERIES


def test_every_metric_and_business_case_has_a_query(spark):
    assert len(pack.METRICS) == 40 and not set(pack.METRICS.values()) - set(QUERIES)
    cases = pack.business_cases()
    assert len(cases) == 41 and not set(cases.values()) - set(QUERIES)
    assert (cases["BC001"], cases["BC034"], cases["BC041"]) == (
        "monthly_mrr_bridge",
        "invoice_reconciliation",
        "regional_operating_review",
    )


def test_views_and_reports_accept_empty_tables(tables, spark):
    t, landing = tables(), TextTables(spark)
    day = F.lit("2024-01-01").cast("date")
    for name, view in pack.business_views(day).items():
        assert view(t).count() in (0, 1), name
    built = pack.report_pack(t, landing, day, day)
    assert len(built) == 13
    for name, report in built.items():
        report.count()


def test_summary_is_one_row_and_written_as_json(tables, spark, tmp_path):
    t = tables(**subscribed([("a", "2024-01-01", "2024-02-29", 5)]))
    day = lambda s: F.lit(s).cast("date")
    results = spark.createDataFrame([("error", True), ("error", False)], "severity string, passed boolean")
    summary = reports.executive_summary(t, results, day("2024-01-01"), day("2024-02-01"))
    sources.write_summary(summary, str(tmp_path / "summary"))
    row = spark.read.json(str(tmp_path / "summary")).collect()[0]
    assert (row["reporting_month"], row["active_accounts"], row["closing_mrr_eur"], row["arr_eur"]) == ("2024-02-01", 1, 5.0, 60.0)
    assert (row["quality_checks"], row["quality_failures"], row["accounts_at_risk"]) == (2, 1, 0)
