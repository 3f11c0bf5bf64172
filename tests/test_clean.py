from datetime import datetime

import pytest

from tidemark.operators import clean
from tidemark.sources import tables

DAY = datetime(2011, 1, 5, 9, 30)


def line(invoice="A1", code="P1", text="mug", quantity=2, date=DAY, price=1.5, customer=7,
         country="France"):
    return (invoice, code, text, quantity, date, price, customer, country)


def cleaned(spark, rows):
    raw = spark.createDataFrame(rows, tables.RAW_SCHEMA)
    return clean.build_transactions(raw)


@pytest.mark.parametrize("rows, kept", [
    ([line(), line()], 1),
    ([line(), line(text="MUG")], 1),
    ([line(invoice=" A1 "), line(invoice="\tA1"), line(code="P1\n"), line(country=" France")], 1),
    ([line(invoice="C123")], 0),
    ([line(invoice="c123")], 1),
    ([line(quantity=0), line(quantity=-1), line(quantity=None)], 0),
    ([line(price=0.0), line(price=None), line(price=float("nan"))], 0),
    ([line(customer=None)], 0),
    ([line(code=c) for c in clean.NON_PRODUCT_CODES], 0),
    ([line(code="gift_0001_20"), line(code="DCGS0003")], 0),
    ([line(code="post"), line(code="Gift_1")], 2),
    ([line(code=None)], 1),
    ([line(invoice=None)], 1),
    ([line(price=1.5), line(price=1.6), line(quantity=3), line(date=datetime(2011, 1, 6))], 4),
])
def test_rows_kept(spark, rows, kept):
    assert cleaned(spark, rows).count() == kept


def test_revenue_rounds_the_scaled_value_to_even(spark):
    [row] = cleaned(spark, [line(quantity=1, price=1.005)]).collect()
    assert row["line_revenue"] == 1.0
    [row] = cleaned(spark, [line(quantity=3, price=0.375)]).collect()
    assert row["line_revenue"] == 1.12


def test_columns_types_and_double_ids(spark):
    raw = spark.createDataFrame([line()], tables.RAW_SCHEMA).withColumn(
        "CustomerID", clean.F.lit(17850.0)).unionByName(
        spark.createDataFrame([line()], tables.RAW_SCHEMA).withColumn(
            "CustomerID", clean.F.lit(float("nan"))))
    out = clean.build_transactions(raw)
    assert out.columns == tables.TRANSACTION_COLUMNS
    assert dict(out.dtypes)["customer_id"] == "bigint"
    assert dict(out.dtypes)["invoice_date"] == "timestamp_ntz"
    assert [r["customer_id"] for r in out.collect()] == [17850]


def test_filters_reach_the_scan_and_copies_combine_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([line()], tables.RAW_SCHEMA).write.parquet(path)
    plan = clean.build_transactions(tables.read_raw(spark, path)) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Quantity)" in plan or "GreaterThan(Quantity,0)" in plan
    assert "Description" not in plan.split("ReadSchema")[1]
    assert plan.count("Exchange") == 1


def test_profile(spark):
    profile = clean.profile(cleaned(spark, [
        line(), line(customer=8, date=datetime(2011, 2, 1)), line(customer=8)])).first()
    assert tuple(profile) == (3, 2, DAY, datetime(2011, 2, 1))


@pytest.mark.parametrize("quantity, customer", [(1.5, 7.0), (2.0, 7.25)])
def test_fractions_raise(spark, quantity, customer):
    raw = spark.createDataFrame(
        [("A1", "P1", "x", quantity, datetime(2011, 1, 1), 1.0, customer, "France"),
         ("A2", "P1", "x", 2.0, datetime(2011, 1, 1), 1.0, float("nan"), "France")],
        "InvoiceNo string, StockCode string, Description string, Quantity double, "
        "InvoiceDate timestamp_ntz, UnitPrice double, CustomerID double, Country string")
    with pytest.raises(Exception, match="is no whole number"):
        clean.normalise(raw).collect()
    good = clean.normalise(raw.filter("InvoiceNo = 'A2'")).first()
    assert (good["quantity"], good["customer_id"]) == (2, None)
