"""The retail invoice-line view over the generated test tables.

Maps lineitem / orders / customer / nation / part onto the eight source
columns with fixed rules (see FIXTURES.md section 2), so every job can run
on the shared test data. ``ret`` marks a cancellation line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.joins import checked_broadcast
from tillroll.schemas import PRICE, RAW_COLUMNS

# Fixed values of the mapping rules (moduli and remainders on part/order keys).
MANUAL_PART = (50, 7)          # p_partkey % 50 = 7   -> stockcode 'M'
NULL_DESC_PART = (40, 3)       # p_partkey % 40 = 3   -> description NULL
BANK_PART = (50, 11)           # p_partkey % 50 = 11  -> 'BANK CHARGES'
AMAZON_PART = (50, 13)         # p_partkey % 50 = 13  -> 'AMAZONFEE'
PADDED_PART = (9, 0)           # p_partkey % 9 = 0    -> '  ' + name + ' '
NULL_QTY_LINE, NULL_QTY_PART = 7, (3, 0)  # linenumber 7 and l_partkey % 3 = 0
NEG_PRICE_PART = (60, 17)      # p_partkey % 60 = 17  -> negative price
NULL_CUST = (5, 0)             # o_custkey % 5 = 0    -> customer NULL
HOURS_MOD = 24                 # invoicedate = orderdate + (orderkey % 24) hours

NATION_MAX_ROWS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod_is(c, rule) -> F.Column:
    m, r = rule
    return (c % m) == r


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight raw columns, one row per lineitem."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")

    # Order-level attributes first (orders ~ 1/4 of lineitem), nation is
    # a bounded lookup: broadcast after a size check.
    order_attrs = (orders
                   .join(cust, orders.o_custkey == cust.c_custkey)
                   .join(checked_broadcast(nation, NATION_MAX_ROWS, materialize=False),
                         F.col("c_nationkey") == F.col("n_nationkey"))
                   .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))

    lines = (li.join(part, li.l_partkey == part.p_partkey)
             .join(order_attrs, F.col("l_orderkey") == F.col("o_orderkey")))

    pk = F.col("p_partkey")
    ret = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    okey = F.col("o_orderkey").cast("string")
    qty = F.col("l_quantity").cast("int")
    price = F.col("p_retailprice").cast(PRICE)

    return lines.select(
        F.when(ret, F.concat(F.lit("C"), okey)).otherwise(okey).alias("invoice"),
        F.when(_mod_is(pk, MANUAL_PART), F.lit("M")).otherwise(pk.cast("string")).alias("stockcode"),
        (F.when(_mod_is(pk, NULL_DESC_PART), F.lit(None).cast("string"))
         .when(_mod_is(pk, BANK_PART), F.lit("BANK CHARGES"))
         .when(_mod_is(pk, AMAZON_PART), F.lit("AMAZONFEE"))
         .when(_mod_is(pk, PADDED_PART), F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
         .otherwise(F.col("p_name"))).alias("description"),
        (F.when((F.col("l_linenumber") == NULL_QTY_LINE) & _mod_is(F.col("l_partkey"), NULL_QTY_PART),
                F.lit(None).cast("int"))
         .when(ret, -qty).otherwise(qty)).alias("quantity"),
        (F.col("o_orderdate").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % HOURS_MOD).cast("int"))).alias("invoicedate"),
        F.when(_mod_is(pk, NEG_PRICE_PART), -price).otherwise(price).cast(PRICE).alias("price"),
        F.when(_mod_is(F.col("o_custkey"), NULL_CUST), F.lit(None).cast("int"))
         .otherwise(F.col("o_custkey").cast("int")).alias("customer_id"),
        F.col("n_name").alias("country"),
    ).select(*RAW_COLUMNS)


# Splits used to exercise the multi-file and incremental paths on one view.
YEARLY_SPLIT = "1998-01-01 00:00:00"
EXISTING_BEFORE = "1999-01-01 00:00:00"
