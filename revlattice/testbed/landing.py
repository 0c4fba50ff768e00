"""Landed text for the contract checks: the bound tables as strings, with faults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.contracts import CONTRACTS
from revlattice.sources.tables import CSV
from revlattice.testbed.bind import BoundTables

# column -> SQL that replaces its text; {v} is the clean text.
FAULTS: dict[tuple[str, str], str] = {
    ("accounts", "country_code"): "case when account_id % 67 = 1 then 'missing_country' else {v} end",
    ("accounts", "tax_id_present"): "case when account_id % 61 = 0 then 'yes' else {v} end",
    ("account_health_history", "health_score"): "case when account_id % 31 = 3 then null else {v} end",
    ("contracts", "contract_term_months"): "case when contract_id % 71 = 0 then concat({v}, '.0') else {v} end",
    ("invoices", "due_date"): "case when invoice_id % 113 = 0 then 'not a date' else {v} end",
    ("leads", "lead_id"): "case when lead_id % 45 = 2 then cast(lead_id - 1 as string) else {v} end",
    ("leads", "lead_score"): "case when lead_id % 43 = 0 then '2.5' else {v} end",
    ("opportunities", "created_at"): "case when opportunity_id % 109 = 0 then '' else {v} end",
    ("payments", "amount_eur"): "case when payment_id % 73 = 0 then 'abc' else {v} end",
    ("refunds", "payment_id"): "case when refund_id % 7 = 0 then null else {v} end",
    ("subscriptions", "account_id"): "case when subscription_id % 89 = 0 then 'missing_account' else {v} end",
    ("subscription_items", "quantity"): "case when quantity = 17 then ' 17 ' when quantity = 18 then 'abc' else {v} end",
    ("users", "user_id"): "case when user_id % 149 = 1 then null else {v} end",
}
# Rows that are landed with a field too many: their last column's text has a comma that no quote protects.
WIDE: dict[str, str] = {
    "invoices": "invoice_id % 101 = 7",
    "leads": "lead_id % 97 = 5",
    "payments": "payment_id % 103 = 11",
    "users": "user_id % 107 = 3",
}
DROPPED = {"experiments": ("status",)}
ADDED = {"partners": {"note": "'unplanned'"}}


def landing_text(table: str, wide: bool = False) -> str:
    """The landed text of a table; with ``wide`` also which rows have a field too many."""
    columns = [f"{WIDE.get(table, 'false')} as wide_row"] if wide else []
    for name in CONTRACTS[table].columns:
        if name in DROPPED.get(table, ()):
            continue
        text = f"cast({name} as string)"
        columns.append(f"{FAULTS.get((table, name), '{v}').replace('{v}', text)} as {name}")
    columns += [f"{expression} as {name}" for name, expression in ADDED.get(table, {}).items()]
    return f"select {', '.join(columns)} from {{{table}}}"


class LandedTables:
    """The text form of every bound table."""

    def __init__(self, tables: BoundTables):
        self.tables = tables
        self._frames = tables.landed

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.tables.spark.sql(landing_text(name), **{name: self.tables[name]})
        return self._frames[name]

    def __contains__(self, name: str) -> bool:
        return name in CONTRACTS

    def __iter__(self):
        return iter(CONTRACTS)


def land_csv(tables: BoundTables, folder: str, names) -> None:
    """Write landed text as CSV files whose ``WIDE`` rows have a field too many."""
    for name in names:
        frame = tables.spark.sql(landing_text(name, wide=True), **{name: tables[name]})
        last = frame.columns[-1]
        surplus = F.when(F.col("wide_row"), F.concat(F.coalesce(last, F.lit("")), F.lit(",surplus"))).otherwise(F.col(last))
        frame.withColumn(last, surplus).drop("wide_row").write.options(**CSV).option("quote", "").csv(f"{folder}/{name}.csv")
