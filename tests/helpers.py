"""Small builders shared by the tests."""

from __future__ import annotations

import re
from datetime import datetime
from decimal import Decimal

RAW_SCHEMA = (
    "merchant_id string, purchase_date string, purchase_amount string, city_id long, "
    "state_id long, category string, installments long, authorized_flag string"
)
SILVER_SCHEMA = (
    "merchant_id string, city_id long, state_id long, category string, installments long, "
    "authorized_flag string, purchase_date timestamp, purchase_amount decimal(28,2), "
    "merchant_name string, merchant_name_ambiguous boolean, merchant_lookup_matched boolean"
)


def raw_row(**changes):
    row = {
        "merchant_id": "k5",
        "purchase_date": "2018-03-04 09:30:00",
        "purchase_amount": "7.50",
        "city_id": 1,
        "state_id": 1,
        "category": "A",
        "installments": 1,
        "authorized_flag": "Y",
    }
    return tuple((row | changes).values())


def silver_row(**changes):
    row = {
        "merchant_id": "k5",
        "city_id": 1,
        "state_id": 1,
        "category": "A",
        "installments": 1,
        "authorized_flag": "Y",
        "purchase_date": datetime(2018, 3, 4, 9, 30),
        "purchase_amount": Decimal("7.50"),
        "merchant_name": "Kiosk",
        "merchant_name_ambiguous": False,
        "merchant_lookup_matched": True,
    }
    return tuple((row | changes).values())


def silver_frame(spark, rows):
    return spark.createDataFrame([silver_row(**r) for r in rows], SILVER_SCHEMA)


def rows(frame):
    return [row.asDict() for row in frame.collect()]


def final_plan(frame):
    """Text of the plan adaptive execution ended with."""
    frame.collect()
    return str(frame._jdf.queryExecution().executedPlan()).split("== Initial Plan ==")[0]


def scans(plan):
    return len(re.findall("FileScan parquet", plan))
