from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tests.helpers import RAW_SCHEMA, raw_row, rows

from tallyforge.functions import values as v
from tallyforge.plans import silver

# A plain merchant, one under two trade names, one without a name, one spelled with and without
# blanks around, and a name that belongs to nobody.
MERCHANTS = [
    ("p7", "Papyrus"),
    ("d1", "Harbour Deli"),
    ("d1", "Deli & Sons"),
    ("e4", "   "),
    ("w2", "Wool"),
    ("w2", "  Wool "),
    (None, "Ghost"),
]


@pytest.fixture(scope="module")
def merchants(spark):
    return spark.createDataFrame(MERCHANTS, "merchant_id string, merchant_name string")


def attempts(spark, *changes):
    return spark.createDataFrame([raw_row(**c) for c in changes], RAW_SCHEMA)


def test_every_row_is_kept_and_named(spark, merchants):
    source = attempts(
        spark,
        {"merchant_id": "p7", "category": "C"},
        {"merchant_id": "p7", "category": "C"},
        {"merchant_id": "z9", "category": None},
        {"merchant_id": "d1", "category": "   "},
        {"merchant_id": None, "category": "\t"},
        {"merchant_id": "e4", "category": "B"},
        {"merchant_id": "w2"},
    )
    result = silver.to_silver(source, merchants)
    want = {
        "p7": ("Papyrus", False, True, "C"),
        "z9": ("z9", False, False, "Unknown category"),
        "d1": ("d1", True, True, "Unknown category"),
        None: ("Unknown merchant", False, False, "\t"),
        "e4": ("e4", False, True, "B"),
        "w2": ("Wool", False, True, "A"),
    }
    got = rows(result.transactions)
    assert len(got) == 7 and {r["merchant_id"] for r in got} == set(want)
    names = ("merchant_name", "merchant_name_ambiguous", "merchant_lookup_matched", "category")
    for r in got:
        assert tuple(r[n] for n in names) == want[r["merchant_id"]]
    assert result.transactions.columns[0] == "merchant_id"
    assert dict(result.transactions.dtypes)["purchase_amount"] == "decimal(28,2)"
    assert dict(result.transactions.dtypes)["purchase_date"] == "timestamp"


def test_lookup_and_conflicts(spark, merchants):
    named = {r["merchant_id"]: r["merchant_name"] for r in rows(silver.merchant_lookup(merchants))}
    assert named == {
        "p7": "Papyrus", "d1": "d1", "e4": "e4", "w2": "Wool", None: "Unknown merchant",
    }
    conflicts = sorted(tuple(r.values()) for r in rows(silver.merchant_conflicts(merchants)))
    assert conflicts == [("d1", "Deli & Sons"), ("d1", "Harbour Deli")]


@pytest.mark.parametrize(
    "change",
    [
        {"purchase_date": "yesterday"},
        {"purchase_date": None},
        {"purchase_date": "2017-02-30 00:00:00"},
        {"purchase_date": "2017-1-1 1:00:00"},
        {"purchase_date": "2017-01-01T10:00:00"},
        {"purchase_amount": "12 euro"},
        {"purchase_amount": None},
        {"purchase_amount": "NaN"},
        {"purchase_amount": "Infinity"},
    ],
)
def test_unusable_values_are_refused(spark, merchants, change):
    with pytest.raises(ValueError, match="invalid/null"):
        silver.to_silver(attempts(spark, {}, change), merchants)


def test_missing_columns_and_empty_source(spark, merchants):
    source = attempts(spark, {})
    with pytest.raises(ValueError, match="missing required columns: city_id, state_id"):
        silver.to_silver(source.drop("state_id", "city_id"), merchants)
    with pytest.raises(ValueError, match="merchant source is missing required columns"):
        silver.to_silver(source, merchants.drop("merchant_name"))
    with pytest.raises(ValueError, match="empty"):
        silver.to_silver(source.filter("false"), merchants)


@pytest.mark.parametrize("kind", ["string", "double", "decimal(20,5)"])
def test_amounts_round_half_up(spark, merchants, kind):
    source = attempts(
        spark, {"purchase_amount": "37.486"}, {"purchase_amount": "4.375"}
    ).withColumn("purchase_amount", F.col("purchase_amount").cast(kind))
    got = silver.to_silver(source, merchants).transactions.select("purchase_amount").collect()
    assert sorted(r[0] for r in got) == [Decimal("4.38"), Decimal("37.49")]


def test_nonfinite_double_amount(spark, merchants):
    source = attempts(spark, {}).withColumn("purchase_amount", F.lit(float("nan")))
    with pytest.raises(ValueError, match="invalid/null"):
        silver.to_silver(source, merchants)


def test_timestamps_are_accepted_as_they_are(spark, merchants):
    source = attempts(spark, {}).withColumn(
        "purchase_date", F.col("purchase_date").cast("timestamp")
    )
    got = silver.to_silver(source, merchants).transactions.first()
    assert str(got["purchase_date"]) == "2018-03-04 09:30:00"


def test_extra_columns_pass_through(spark, merchants):
    source = attempts(spark, {}).withColumn("extra", F.lit(7))
    assert silver.to_silver(source, merchants).transactions.first()["extra"] == 7


def test_predicates_are_never_null(spark):
    flags = spark.createDataFrame([("Y",), ("N",), ("X",), (None,)], "flag string")
    flag = F.col("flag")
    got = flags.select(
        v.approved(flag).alias("a"), v.denied(flag).alias("d"),
        v.unknown_authorization(flag).alias("u"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, False, False),
        (False, True, False),
        (False, False, True),
        (False, False, True),
    ]


def test_plan_size_and_label(spark):
    counts = spark.createDataFrame([(0,), (1,), (3,), (999,), (-1,), (None,)], "n long")
    plan = v.plan_size(F.col("n"))
    got = [tuple(r) for r in counts.select(plan, v.plan_label(plan)).collect()]
    assert got == [
        (1, "Baseline (0/1)"),
        (1, "Baseline (0/1)"),
        (3, "3 payments"),
        (None, "Unknown"),
        (None, "Unknown"),
        (None, "Unknown"),
    ]
