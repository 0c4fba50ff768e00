from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from revlattice.contracts import CONTRACTS  # noqa: E402
from revlattice.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def typed(kind: str, value):
    if value is None:
        return None
    if kind == "date":
        return dt.date.fromisoformat(value)
    if kind == "timestamp":
        return dt.datetime.fromisoformat(value)
    if kind == "decimal":
        return Decimal(str(value))
    return value


class Tables(dict):
    """Contract tables from a few rows each; tables without rows are empty."""

    def __init__(self, spark, **rows):
        super().__init__()
        for name, contract in CONTRACTS.items():
            given = rows.get(name, [])
            data = [tuple(typed(k, r.get(c)) for c, k in contract.columns.items()) for r in given]
            schema = contract.schema
            for field in schema.fields:
                field.nullable = True
            self[name] = spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def tables(spark):
    return lambda **rows: Tables(spark, **rows)


class TextTables(dict):
    """The same as landed text."""

    def __init__(self, spark, **rows):
        super().__init__()
        for name, contract in CONTRACTS.items():
            data = [tuple(r.get(c) for c in contract.columns) for r in rows.get(name, [])]
            self[name] = spark.createDataFrame(data, contract.landing_schema)


@pytest.fixture(scope="session")
def texts(spark):
    return lambda **rows: TextTables(spark, **rows)


def subscribed(items, accounts=("a",)):
    """One subscription per account and its items as (account, start, end, mrr[, item_type, quantity])."""
    rows = []
    for i, (account, start, end, mrr, *rest) in enumerate(items):
        kind = rest[0] if rest else "plan"
        rows.append(
            {
                "subscription_item_id": f"i{i}",
                "subscription_id": f"s_{account}",
                "item_type": kind,
                "plan_id": "p1" if kind == "plan" else None,
                "add_on_id": None if kind == "plan" else "x1",
                "quantity": rest[1] if len(rest) > 1 else 1,
                "effective_start": start,
                "effective_end": end,
                "mrr_local": mrr,
                "mrr_eur": mrr,
            }
        )
    names = sorted({r["subscription_id"][2:] for r in rows} | set(accounts))
    return {
        "subscription_items": rows,
        "subscriptions": [{"subscription_id": f"s_{a}", "account_id": a, "subscription_start_date": "2020-01-01"} for a in names],
        "accounts": [
            {
                "account_id": a,
                "country_code": "DE",
                "region_id": "EU",
                "segment": "small",
                "sales_motion": "self_service",
                "acquisition_channel": "events",
            }
            for a in names
        ],
        "plans": [{"plan_id": "p1", "plan_name": "Team"}],
    }
