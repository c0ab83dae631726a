"""Declared schemas of every layer. Nothing is inferred."""

from pyspark.sql.types import (
    DateType, DecimalType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType,
)

PRICE = DecimalType(12, 2)
TOTAL = DecimalType(14, 2)
# Invoice timestamps carry no zone; NTZ keeps them independent of the
# session time zone (the test parquet also loads as NTZ).
TS = TimestampNTZType()

# Source CSV, bound by position (header row skipped).
CSV_SCHEMA = StructType([
    StructField("invoice", StringType(), True),
    StructField("stockcode", StringType(), True),
    StructField("description", StringType(), True),
    StructField("quantity", IntegerType(), True),
    StructField("invoicedate", TS, True),
    StructField("price", PRICE, True),
    StructField("customer_id", IntegerType(), True),
    StructField("country", StringType(), True),
])

RAW_COLUMNS = [f.name for f in CSV_SCHEMA.fields]

# Sync key: a row is new when no raw row has the same six values.
SYNC_KEYS = ["invoice", "stockcode", "invoicedate", "quantity", "price", "country"]

STAGING_SCHEMA = StructType(CSV_SCHEMA.fields + [StructField("total_price", TOTAL, True)])
STAGING_COLUMNS = [f.name for f in STAGING_SCHEMA.fields]

DIM_DATE_SCHEMA = StructType([
    StructField("date_key", IntegerType(), False),
    StructField("full_date", DateType(), False),
    StructField("day", IntegerType(), False),
    StructField("day_of_week", IntegerType(), False),
    StructField("day_name", StringType(), False),
    StructField("week_of_year", IntegerType(), False),
    StructField("quarter", IntegerType(), False),
    StructField("month", IntegerType(), False),
    StructField("month_name", StringType(), False),
    StructField("year", IntegerType(), False),
])

DIM_COUNTRY_SCHEMA = StructType([
    StructField("country_id", LongType(), False),
    StructField("country", StringType(), False),
])

DIM_PRODUCT_SCHEMA = StructType([
    StructField("stockcode", StringType(), False),
    StructField("product_name", StringType(), True),
])

DIM_CUSTOMER_SCHEMA = StructType([
    StructField("customer_id", IntegerType(), False),
    StructField("first_seen_date", DateType(), True),
    StructField("last_seen_date", DateType(), True),
])

FACT_TABLE_SCHEMA = StructType([
    StructField("fact_id", LongType(), False),
    StructField("invoice", StringType(), False),
    StructField("stockcode", StringType(), False),
    StructField("customer_id", IntegerType(), True),
    StructField("country_id", LongType(), False),
    StructField("date_key", IntegerType(), False),
    StructField("quantity", IntegerType(), False),
    StructField("price", PRICE, False),
    StructField("total_price", TOTAL, True),
    StructField("invoice_ts", TS, False),
    StructField("date_month", IntegerType(), False),
])

KPI_SCHEMA = StructType([
    StructField("date_key", IntegerType(), False),
    StructField("full_date", DateType(), False),
    StructField("year", IntegerType(), False),
    StructField("month", IntegerType(), False),
    StructField("month_name", StringType(), False),
    StructField("country", StringType(), False),
    StructField("daily_orders", LongType(), False),
    StructField("gross_revenue", DecimalType(24, 2), True),
    StructField("returns_revenue", DecimalType(24, 2), True),
    StructField("net_revenue", DecimalType(24, 2), True),
    StructField("is_q4", IntegerType(), False),
])

# Raw and staging as the warehouse stores them: with the line's id, its month
# (yyyyMM, 0 without a date) and the batch it came in.
RAW_TABLE_SCHEMA = StructType([StructField("id", LongType(), False), *CSV_SCHEMA.fields,
                               StructField("load_batch", StringType(), False),
                               StructField("invoice_month", IntegerType(), False)])
STAGING_TABLE_SCHEMA = StructType([*STAGING_SCHEMA.fields, StructField("load_batch", StringType(), False)])

# Change-gate state: {data_signature: {max_date, n_rows}, version, last_run_utc}
STATE_SCHEMA = StructType([
    StructField("data_signature", StructType([
        StructField("max_date", StringType(), True),
        StructField("n_rows", LongType(), True),
        StructField("net_revenue", StringType(), True),
    ]), True),
    StructField("version", LongType(), True),
    StructField("last_run_utc", StringType(), True),
])
