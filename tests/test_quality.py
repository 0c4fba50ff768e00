from __future__ import annotations

import pytest

from revlattice.contracts import CONTRACTS, cast_to_contract, export_contracts, references_of, split_quarantine
from revlattice.plans import quality


def failures(frame):
    return {r["check_id"]: r["failure_count"] for r in frame.collect()}


def test_contract_totals():
    kinds = [k for c in CONTRACTS.values() for k in c.columns.values()]
    assert len(CONTRACTS) == 41 and len(kinds) == 350
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "string": 194,
        "decimal": 45,
        "date": 35,
        "timestamp": 33,
        "integer": 30,
        "boolean": 13,
    }
    assert sum(len(references_of(t)) for t in CONTRACTS) == 43


def test_a_clean_set_of_tables_gives_531_checks(texts):
    row = {c.table: [{k: "1" for k in c.key}] for c in CONTRACTS.values()}
    results = quality.validate(texts(**row))
    # Empty references are no children: every table has one row, so every check is made.
    assert results.count() == 531


def test_validation_runs_part_by_part_and_leaves_no_shuffle_files(spark, texts):
    import time
    from pathlib import Path

    t = texts(
        accounts=[{"account_id": "a"}, {"account_id": "a"}, {"account_id": "b"}],
        subscriptions=[{"subscription_id": "s", "account_id": "b"}, {"subscription_id": "t", "account_id": "x"}, {"subscription_id": None, "account_id": None}],
        invoices=[{"invoice_id": "i", "account_id": "x", "subscription_id": "t"}, {"invoice_id": "j", "account_id": "a", "subscription_id": "y"}],
    )
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {p.name for d in local for p in Path(str(d)).glob("*/shuffle_*.data")}
    before = files()
    results = quality.validate(t)
    for _ in range(50):
        if left := files() - before:
            time.sleep(0.2)
    assert not left
    got = {r["check_id"]: tuple(r) for r in results.collect()}
    parts = (quality.column_checks, quality.primary_key_checks, quality.foreign_key_checks, quality.business_rule_checks, quality.invoice_line_checks, quality.payment_attempt_checks)
    assert got == {r["check_id"]: tuple(r) for part in parts for r in part(t).select(*quality.CHECK_COLUMNS).collect()}
    assert results.count() == len(got) and got["invoices.fk_1"][5] == got["invoices.fk_2"][5] == 1


@pytest.mark.parametrize("table", list(CONTRACTS))
def test_references_point_at_single_keys(table):
    for column, parent in references_of(table):
        assert CONTRACTS[parent].key == (column,)


QUANTITIES = [" 12 ", "12.0", "2.5", "", "abc", None]


def test_cast_accepts_whole_numbers_only(texts):
    items = [{"subscription_item_id": str(i), "quantity": q} for i, q in enumerate(QUANTITIES)]
    landing = texts(subscription_items=items)["subscription_items"]
    loose = {r["subscription_item_id"]: r["quantity"] for r in cast_to_contract(landing, "subscription_items", strict=False).collect()}
    assert loose == {"0": 12, "1": 12, "2": None, "3": None, "4": None, "5": None}
    with pytest.raises(Exception):
        cast_to_contract(landing, "subscription_items").collect()
    good, broken = split_quarantine(landing, "subscription_items")
    assert good.count() == 4 and {r["quantity"] for r in broken.collect()} == {"2.5", "abc"}


def test_type_checks(texts):
    t = texts(
        subscription_items=[{"subscription_item_id": str(i), "quantity": q} for i, q in enumerate(QUANTITIES)],
        accounts=[{"account_id": str(i), "tax_id_present": v} for i, v in enumerate(["True", "1", "yes", None])],
        invoices=[{"invoice_id": "1", "due_date": "2024-13-01"}, {"invoice_id": "2", "due_date": "2024-02-29"}],
    )
    got = failures(quality.column_checks(t))
    # Blank text is given but not a number; only an absent value is skipped.
    assert got["subscription_items.quantity.type"] == 3
    assert got["accounts.tax_id_present.type"] == 1
    assert got["invoices.due_date.type"] == 1


def test_missing_and_unexpected_columns(texts):
    t = texts()
    t["plans"] = t["plans"].drop("plan_rank").selectExpr("*", "'x' as extra")
    del t["regions"]
    rows = {r["check_id"]: r for r in quality.column_checks(t).collect()}
    assert rows["plans.columns"]["failure_count"] == 1 and "extra" in rows["plans.columns"]["details"]
    assert "plans.plan_id.type" not in rows
    assert rows["regions.exists"]["passed"] is False and "regions.columns" not in rows


def test_repeated_and_missing_keys(texts):
    t = texts(
        accounts=[{"account_id": a} for a in ("x", "x", None, "y")],
        account_health_history=[
            {"account_id": "x", "health_month": "2024-01-01"},
            {"account_id": "x", "health_month": "2024-02-01"},
        ],
    )
    got = failures(quality.primary_key_checks(t))
    assert got["accounts.pk_unique"] == 2 and got["accounts.pk_not_null"] == 1
    assert got["account_health_history.pk_unique"] == 0
    assert got["plans.pk_unique"] == 0


def test_orphans_empty_parents_and_empty_children(texts):
    t = texts(
        accounts=[{"account_id": "a", "country_code": "DE"}],
        subscriptions=[
            {"subscription_id": "1", "account_id": "missing_account"},
            {"subscription_id": "2", "account_id": "a"},
            {"subscription_id": "3", "account_id": None},
        ],
    )
    got = failures(quality.foreign_key_checks(t))
    assert got["subscriptions.fk_1"] == 1
    assert got["accounts.fk_1"] == 1  # no countries at all
    assert "leads.fk_1" not in got  # no leads at all


def test_unknown_scores_fail_the_rule_but_not_the_control(texts, tables):
    scored = failures(quality.business_rule_checks(texts(nps_responses=[{"nps_response_id": "1", "nps_score": None}])))
    assert scored["nps.score_range"] == 1
    controls = quality.control_results(tables(nps_responses=[{"nps_response_id": "1"}])).collect()
    assert len(controls) == 50
    assert {r["control_id"]: r["failure_count"] for r in controls}["Q012"] == 0


def test_reconciliations(texts):
    t = texts(
        invoices=[{"invoice_id": "1", "subtotal_local": "10"}, {"invoice_id": "2", "subtotal_local": "5"}],
        invoice_lines=[
            {"invoice_line_id": "1", "invoice_id": "1", "line_total_local": "4"},
            {"invoice_line_id": "2", "invoice_id": "1", "line_total_local": "6.01"},
        ],
        payments=[{"payment_id": "1", "payment_attempt_id": "a"}, {"payment_id": "2", "payment_attempt_id": "b"}],
        payment_attempts=[
            {"payment_attempt_id": "a", "attempt_status": "succeeded"},
            {"payment_attempt_id": "b", "attempt_status": "failed"},
        ],
    )
    assert failures(quality.invoice_line_checks(t)) == {"invoices.lines_reconcile": 1}
    assert failures(quality.payment_attempt_checks(t)) == {"payments.successful_attempt": 1}


def test_gate(spark):
    schema = "severity string, passed boolean"
    gate = lambda rows: quality.gate(spark.createDataFrame(rows, schema)).collect()[0]["gate_passed"]
    assert gate([("error", True), ("warning", False)]) is True
    assert gate([("error", False)]) is False
    assert gate([]) is False


def test_contract_export(tmp_path):
    export_contracts(tmp_path)
    assert len(list(tmp_path.glob("*.json"))) == 42


def test_whole_numbers_are_what_the_cast_reads(spark):
    from revlattice.plans.quality import type_failure

    rows = [("1", False), ("-3.000", False), ("1.0000000001", True), ("2.5", True), ("1e3", True), ("x", True), ("9" * 20, True), (None, False)]
    frame = spark.createDataFrame(rows, "n string, bad boolean")
    assert frame.selectExpr(f"{type_failure('n', 'integer')} as got", "bad").where("got <> bad").isEmpty()


def test_reconciliations_are_not_made_without_rows(texts):
    t = texts()
    assert not quality.invoice_line_checks(t).count() and not quality.payment_attempt_checks(t).count()


def test_reconciliations_are_not_made_without_the_other_table(texts):
    one = texts(invoices=[{"invoice_id": "1", "subtotal_local": "10"}], payments=[{"payment_id": "1", "payment_attempt_id": "a"}])
    assert not quality.invoice_line_checks(one).count() and not quality.payment_attempt_checks(one).count()
    other = texts(invoice_lines=[{"invoice_line_id": "1"}], payment_attempts=[{"payment_attempt_id": "a"}])
    assert not quality.invoice_line_checks(other).count() and not quality.payment_attempt_checks(other).count()
