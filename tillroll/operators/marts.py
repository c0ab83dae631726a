"""Business questions, KPI export and figure feeds over the star schema.

Plan shape: every query aggregates the fact by the dimension key it needs
(hash aggregate with map-side partial combine) and joins the dimension
*after* that, so the join sees one row per date / product / customer /
country instead of one row per invoice line. The reference groups by the
dimension attributes after the join; those attributes are functions of
the key, so the result is the same. A hot key (a date or product with a
third of all lines) is reduced to one partial row per task before any
shuffle. Top-k uses ``orderBy().limit()`` -> TakeOrderedAndProject.

Marts that only sum ``total_price`` by day and/or country also accept the
day x country rollup (``daily_country_rollup``) in place of the fact: sums
are associative, so the result is the same, and the batch scans the fact
once for all of them.

NULL order follows the warehouse: NULLS FIRST on DESC, NULLS LAST on ASC.
Ties in top-k are broken by the remaining output columns, so results are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import calendar_columns, date_key
from tillroll.functions.text import product_label
from tillroll.operators.star import fact_eligible
from tillroll.schemas import DIM_DATE_SCHEMA, TOTAL

TOP_K = 10
CALENDAR = DIM_DATE_SCHEMA.fieldNames()[2:]
# Placeholder for a product without a usable name; labels of
# the revenue breakdown rows.
NO_DESCRIPTION = "[No Description]"
BREAKDOWN_TYPES = ("Gross Sales", "Returns", "Net Revenue")


def _r2(c):
    return F.round(c, 2)


def _sum_when(cond, value="total_price"):
    return F.sum(F.when(cond, F.col(value)).otherwise(F.lit(0).cast(TOTAL)))


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(F.sum("total_price").alias("_rev"))


# ---------------------------------------------------------------- business


def total_revenue(fact: DataFrame) -> DataFrame:
    return fact.agg(_r2(F.sum("total_price")).alias("total_revenue"))


def revenue_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = _per_key(fact, "date_key")
    return (per_day.join(dim_date, "date_key")
            .groupBy("year", "month", "month_name")
            .agg(_r2(F.sum("_rev")).alias("monthly_revenue"))
            .orderBy("year", "month"))


def top_products(fact: DataFrame, dim_product: DataFrame, k: int = TOP_K) -> DataFrame:
    # both sides end hash-partitioned on stockcode: the join adds no exchange
    per = _per_key(fact, "stockcode")
    return (per.join(dim_product, "stockcode")
            .select("stockcode", "product_name", _r2(F.col("_rev")).alias("product_revenue"))
            .orderBy(F.desc_nulls_first("product_revenue"), F.asc_nulls_last("stockcode"))
            .limit(k))


def top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = TOP_K) -> DataFrame:
    per = _per_key(fact.where(F.col("customer_id").isNotNull()), "customer_id")
    return (per.join(dim_customer, "customer_id")
            .select("customer_id", _r2(F.col("_rev")).alias("customer_revenue"))
            .orderBy(F.desc_nulls_first("customer_revenue"), F.asc_nulls_last("customer_id"))
            .limit(k))


def revenue_by_country(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    per = _per_key(fact, "country_id")
    return (per.join(dim_country, "country_id")
            .groupBy("country")
            .agg(_r2(F.sum("_rev")).alias("country_revenue"))
            .orderBy(F.desc_nulls_first("country_revenue"), F.asc_nulls_last("country")))


def avg_order_value(fact: DataFrame) -> DataFrame:
    """SUM(total_price) / COUNT(DISTINCT invoice), exact decimal division;
    NULL instead of a division error when there is no invoice. Runs on the
    fact or on ``invoice_rollup``."""
    return fact.agg(
        _r2(F.try_divide(F.sum("total_price"), F.count_distinct("invoice"))).alias("avg_order_value"))


def return_impact(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("quantity") < 0)
            .agg(_r2(F.sum("total_price")).alias("return_revenue_impact")))


def revenue_by_week(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Calendar year paired with ISO week, as in the source query."""
    per_day = _per_key(fact, "date_key")
    return (per_day.join(dim_date, "date_key")
            .groupBy("year", "week_of_year")
            .agg(_r2(F.sum("_rev")).alias("weekly_revenue"))
            .orderBy("year", "week_of_year"))


# ---------------------------------------------------------------- KPI export


def _split_sums() -> list:
    tp, q = F.col("total_price"), F.col("quantity")
    return [F.sum("total_price").alias("total_price"), F.count(F.lit(1)).cast("long").alias("n_lines"),
            _sum_when(tp > 0).alias("gross_revenue"), _sum_when(tp < 0).alias("returns_revenue"),
            _sum_when(q > 0).alias("gross_sales_by_qty"), _sum_when(q < 0).alias("returns_by_qty")]


def invoice_rollup(fact: DataFrame, by: tuple[str, ...] = ("date_key", "country_id")) -> DataFrame:
    """One row per (day, country, invoice): net revenue under the fact's column
    name, line count, and the sign splits of the rollup.

    Whatever needs distinct invoices (orders by day and country, orders by
    day, order value) counts rows or names here instead of shuffling lines
    again. Lines reach the shuffle as partial sums, so a hot day is spread
    over its invoices and a hot invoice is one row per task.
    """
    return fact.groupBy(*by, "invoice").agg(*_split_sums())


def daily_country_rollup(fact: DataFrame, by: tuple[str, ...] = ("date_key", "country_id")) -> DataFrame:
    """One row per (date_key, country_id): net revenue under the fact's own
    column name ``total_price`` (so every mart that only sums total_price by
    day and/or country runs unchanged on this table instead of the fact),
    line count, distinct invoices, and the sign splits the KPI export and
    the revenue breakdown need. Runs on the fact or on ``invoice_rollup``;
    a NULL invoice is no order.
    """
    if "n_lines" not in fact.columns:
        fact = invoice_rollup(fact, by)
    sums = [F.sum(c).cast(fact.schema[c].dataType).alias(c)
            for c in ("total_price", "n_lines", "gross_revenue", "returns_revenue", "gross_sales_by_qty", "returns_by_qty")]
    return fact.groupBy(*by).agg(*sums[:2], F.count("invoice").alias("daily_orders"), *sums[2:])


def kpis_from_rollup(rollup: DataFrame, dim_date: DataFrame, dim_country: DataFrame) -> DataFrame:
    return (rollup.join(dim_date, "date_key")
            .join(dim_country, "country_id")
            .select("full_date", "year", "month", "month_name", "country",
                    "daily_orders", "gross_revenue", "returns_revenue",
                    F.col("total_price").alias("net_revenue"),
                    F.when(F.col("quarter") == 4, 1).otherwise(0).cast("int").alias("is_q4"))
            .orderBy("full_date", "country"))


def daily_kpis(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Per day and country: distinct invoices, gross (total_price > 0),
    returns (total_price < 0) and net revenue, Q4 flag."""
    return kpis_from_rollup(daily_country_rollup(fact), dim_date, dim_country)


def daily_kpis_of_lines(staging: DataFrame) -> DataFrame:
    """The daily KPIs straight from staged lines, with ``date_key`` first.

    The rows of a day follow from that day's lines alone (no numbered
    country, no dimension over all of staging), so single days can be made
    anew (``Warehouse.refresh_daily_kpis``).
    """
    lines = fact_eligible(staging).select(
        date_key(F.col("invoicedate")).alias("date_key"), F.trim("country").alias("country"),
        "invoice", "quantity", "total_price")
    key = F.col("date_key")
    days = daily_country_rollup(lines, ("date_key", "country")).withColumn(
        "full_date", F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100))
    calendar = {c: col for c, col in zip(CALENDAR, calendar_columns(F.col("full_date")))}
    return days.select("date_key", "full_date", *[calendar[c] for c in ("year", "month", "month_name")], "country",
                       "daily_orders", "gross_revenue", "returns_revenue", F.col("total_price").alias("net_revenue"),
                       F.when(calendar["quarter"] == 4, 1).otherwise(0).cast("int").alias("is_q4"))


# ---------------------------------------------------------------- figure feeds


def data_signature(fact: DataFrame, dim_date: DataFrame, with_revenue: bool = False) -> DataFrame:
    """(max date, row count) of fact joined to dim_date; per-day counts are
    joined, not lines (the daily rollup can stand in for the fact). A
    same-count edit is not seen by this signature; ``with_revenue`` adds the
    net revenue so such edits also count."""
    lines = F.sum("n_lines") if "n_lines" in fact.columns else F.count(F.lit(1))
    per_day = fact.groupBy("date_key").agg(lines.alias("_n"), F.sum("total_price").alias("_rev"))
    aggs = [F.max("full_date").alias("max_date"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows")]
    if with_revenue:
        aggs.append(F.sum("_rev").cast("string").alias("net_revenue"))
    return per_day.join(dim_date, "date_key").agg(*aggs)


def fig_daily_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = _per_key(fact, "date_key")
    return (per_day.join(dim_date, "date_key")
            .select(F.col("full_date").alias("date"), _r2(F.col("_rev")).alias("revenue"))
            .orderBy("date"))


def fig_monthly_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = _per_key(fact, "date_key")
    return (per_day.join(dim_date, "date_key")
            .groupBy(F.trunc("full_date", "month").alias("month"))
            .agg(_r2(F.sum("_rev")).alias("revenue"))
            .orderBy("month"))


def fig_top_countries(fact: DataFrame, dim_country: DataFrame, k: int = TOP_K) -> DataFrame:
    return (revenue_by_country(fact, dim_country)
            .select("country", F.col("country_revenue").alias("revenue"))
            .orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("country"))
            .limit(k))


def fig_top_products(fact: DataFrame, dim_product: DataFrame, k: int = TOP_K) -> DataFrame:
    per = _per_key(fact, "stockcode")
    name = F.coalesce(F.nullif(F.trim("product_name"), F.lit("")), F.lit(NO_DESCRIPTION))
    return (per.join(dim_product, "stockcode")
            .select("stockcode", name.alias("product_name"), _r2(F.col("_rev")).alias("revenue"))
            .orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("stockcode"))
            .limit(k)
            .withColumn("label", product_label(F.col("stockcode"), F.col("product_name"))))


def fig_revenue_breakdown(fact: DataFrame) -> DataFrame:
    """Gross sales (quantity > 0), returns (quantity < 0), net: one
    aggregate, then wide -> long with ``stack``."""
    if "gross_sales_by_qty" in fact.columns:          # the daily rollup
        gross, ret = F.sum("gross_sales_by_qty"), F.sum("returns_by_qty")
    else:
        q = F.col("quantity")
        gross, ret = _sum_when(q > 0), _sum_when(q < 0)
    wide = fact.agg(
        _r2(gross).alias("gross_sales"),
        _r2(ret).alias("returns"),
        _r2(F.sum("total_price")).alias("net_revenue"),
    )
    g, r, n = BREAKDOWN_TYPES
    return wide.select(F.expr(
        f"stack(3, '{g}', gross_sales, '{r}', returns, '{n}', net_revenue) AS (type, amount)"))
