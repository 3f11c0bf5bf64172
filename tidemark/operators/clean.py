"""From raw sales lines to valid, identified product sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import round_half_even, starts_with_any, strip
from tidemark.sources.tables import TRANSACTION_COLUMNS

# Codes and prefixes that are not products, and the cancellation prefix.
NON_PRODUCT_CODES = [
    "POST", "DOT", "C2", "M", "m", "B", "D", "S", "PADS",
    "BANK CHARGES", "AMAZONFEE", "CRUK",
]
NON_PRODUCT_PREFIXES = ["gift_", "DCGS"]
CANCELLATION_PREFIX = "C"

# Raw column name to engine column name.
RENAMES = {
    "InvoiceNo": "invoice_no", "StockCode": "stock_code", "Description": "description",
    "Quantity": "quantity", "InvoiceDate": "invoice_date", "UnitPrice": "unit_price",
    "CustomerID": "customer_id", "Country": "country",
}

BUSINESS_KEY = ["invoice_no", "stock_code", "quantity", "invoice_date",
                "unit_price", "customer_id", "country"]


def normalise(raw: DataFrame) -> DataFrame:
    """Rename, strip the text keys, and cast; NaN counts as missing."""
    lines = raw.withColumnsRenamed(RENAMES)
    number = {name: dtype in ("double", "float") for name, dtype in lines.dtypes}

    def clean_number(name: str):
        column = F.col(name)
        return F.when(~F.isnan(column), column) if number[name] else column

    def whole_number(name: str):
        """An id or a quantity; a fraction is bad data and raises, as text that is no number does."""
        column = clean_number(name)
        if not number[name]:
            return column.cast("bigint").alias(name)
        bad = F.raise_error(F.concat(F.lit(f"{name} is no whole number: "), column.cast("string")))
        return F.when(column == F.rint(column), column.cast("bigint")) \
            .when(column.isNotNull(), bad.cast("bigint")).alias(name)

    return lines.select(
        whole_number("customer_id"),
        strip("invoice_no").alias("invoice_no"),
        F.col("invoice_date").cast("timestamp_ntz").alias("invoice_date"),
        strip("stock_code").alias("stock_code"),
        whole_number("quantity"),
        clean_number("unit_price").cast("double").alias("unit_price"),
        strip("country").alias("country"),
    )


def is_product(code="stock_code"):
    """Not a fee, voucher or adjustment. A missing code is kept."""
    column = F.col(code)
    return F.coalesce(
        ~column.isin(NON_PRODUCT_CODES) & ~starts_with_any(column, NON_PRODUCT_PREFIXES),
        F.lit(True))


def is_valid_sale():
    """A product line, not cancelled, with positive quantity and price, of a known customer."""
    not_cancelled = F.coalesce(
        ~F.startswith(F.col("invoice_no"), F.lit(CANCELLATION_PREFIX)), F.lit(True))
    return (is_product() & not_cancelled & (F.col("quantity") > 0)
            & (F.col("unit_price") > 0) & F.col("customer_id").isNotNull())


def drop_copies(lines: DataFrame) -> DataFrame:
    """Keep one row per business key.

    Copies are combined before the shuffle, and the shuffle is on the whole key, so neither a
    large group of copies nor a large customer ends up in one task.
    """
    return lines.dropDuplicates(BUSINESS_KEY)


def with_line_revenue(lines: DataFrame) -> DataFrame:
    return lines.withColumn(
        "line_revenue", round_half_even(F.col("quantity") * F.col("unit_price"), 2))


def build_transactions(raw: DataFrame) -> DataFrame:
    """Raw extract to the transaction table. Filters read key columns only, so they commute
    with the removal of copies and run first."""
    sales = drop_copies(normalise(raw).filter(is_valid_sale()))
    return with_line_revenue(sales).select(*TRANSACTION_COLUMNS)


def profile(transactions: DataFrame) -> DataFrame:
    """Rows, distinct customers, first and last date."""
    return transactions.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("customer_id").alias("customers"),
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"))
