"""Data-quality jobs: raw profiling, staging validation, star checks.

Each check is its own small DataFrame (one key per statement), and the
one-row checks are also offered fused into a single scan
(``profile_raw`` / ``validate_staging``): one aggregate with many columns
instead of many passes over a large table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import MANUAL_STOCKCODE, NON_PRODUCT_DESCRIPTIONS, has_edge_space
from tillroll.operators.combine import side_by_side
from tillroll.operators.staging import expected_staging_filter
from tillroll.operators.star import fact_eligible
from tillroll.schemas import PRICE

DUP_KEY_LIMIT = 50
TOP_ROWS = 10
NEG_PRICE_LIMIT = 50

_ROW_COLS = ["invoice", "stockcode", "quantity", "price"]


def _count():
    return F.count(F.lit(1)).cast("long")


def _count_if(cond):
    return F.count(F.when(cond, F.lit(1))).cast("long")


# ---------------------------------------------------------------- raw profiling

def prof_total_rows(raw: DataFrame) -> DataFrame:
    return raw.agg(_count().alias("total_rows"))


NULL_PROFILE_COLUMNS = ["invoice", "stockcode", "description", "quantity", "price", "customer_id"]


def prof_nulls(raw: DataFrame) -> DataFrame:
    return raw.agg(*[(_count() - F.count(c)).cast("long").alias(f"null_{c}")
                     for c in NULL_PROFILE_COLUMNS])


def prof_spacing(raw: DataFrame) -> DataFrame:
    return raw.agg(_count_if(has_edge_space(F.col("description"))).alias("rows_with_spacing_issues"))


def prof_signs(raw: DataFrame) -> DataFrame:
    q, p = F.col("quantity"), F.col("price")
    return raw.agg(_count_if(q < 0).alias("negative_quantity"),
                   _count_if(q == 0).alias("zero_quantity"),
                   _count_if(p < 0).alias("negative_price"),
                   _count_if(p == 0).alias("zero_price"))


def prof_cancelled(raw: DataFrame) -> DataFrame:
    """Counts cancelled *lines* (invoice LIKE 'C%')."""
    return raw.agg(_count_if(F.col("invoice").startswith("C")).alias("cancelled_invoices"))


def prof_date_range(raw: DataFrame) -> DataFrame:
    return raw.agg(F.min("invoicedate").alias("min_invoicedate"),
                   F.max("invoicedate").alias("max_invoicedate"))


def prof_country_dist(raw: DataFrame) -> DataFrame:
    return (raw.groupBy("country").agg(_count().alias("cnt"))
            .orderBy(F.desc_nulls_first("cnt"), F.asc_nulls_last("country")))


def prof_dup_keys(raw: DataFrame, limit: int = DUP_KEY_LIMIT) -> DataFrame:
    keys = ["invoice", "stockcode", "invoicedate"]
    return (raw.groupBy(*keys).agg(_count().alias("cnt"))
            .where(F.col("cnt") > 1)
            .orderBy(F.desc_nulls_first("cnt"), *[F.asc_nulls_last(k) for k in keys])
            .limit(limit))


def prof_price_range(raw: DataFrame) -> DataFrame:
    return raw.agg(F.min("price").alias("min_price"), F.max("price").alias("max_price"))


def prof_qty_range(raw: DataFrame) -> DataFrame:
    return raw.agg(F.min("quantity").alias("min_quantity"), F.max("quantity").alias("max_quantity"))


def _tie_break():
    return [F.asc_nulls_last(c) for c in _ROW_COLS]


def prof_top_abs_qty(raw: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    """ORDER BY ABS(quantity) DESC: NULL quantities lead (NULLS FIRST)."""
    return (raw.select(*_ROW_COLS)
            .orderBy(F.desc_nulls_first(F.abs("quantity")), *_tie_break())
            .limit(k))


def prof_top_price(raw: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    return (raw.select(*_ROW_COLS)
            .orderBy(F.desc_nulls_first("price"), *_tie_break())
            .limit(k))


def prof_negative_price(raw: DataFrame, limit: int = NEG_PRICE_LIMIT) -> DataFrame:
    return (raw.where(F.col("price") < 0).select(*_ROW_COLS)
            .orderBy(F.asc_nulls_last("price"), *_tie_break())
            .limit(limit))


def prof_non_product(raw: DataFrame) -> DataFrame:
    cond = (F.col("stockcode") == MANUAL_STOCKCODE) | F.col("description").isin(NON_PRODUCT_DESCRIPTIONS)
    return (raw.where(cond).groupBy("stockcode", "description").agg(_count().alias("cnt"))
            .orderBy(F.desc_nulls_first("cnt"), F.asc_nulls_last("stockcode"),
                     F.asc_nulls_last("description")))


def profile_raw(raw: DataFrame) -> DataFrame:
    """All one-row profiling figures in one scan."""
    q, p, d = F.col("quantity"), F.col("price"), F.col("description")
    return raw.agg(
        _count().alias("total_rows"),
        *[(_count() - F.count(c)).cast("long").alias(f"null_{c}") for c in NULL_PROFILE_COLUMNS],
        _count_if(has_edge_space(d)).alias("rows_with_spacing_issues"),
        _count_if(q < 0).alias("negative_quantity"), _count_if(q == 0).alias("zero_quantity"),
        _count_if(p < 0).alias("negative_price"), _count_if(p == 0).alias("zero_price"),
        _count_if(F.col("invoice").startswith("C")).alias("cancelled_invoices"),
        F.min("invoicedate").alias("min_invoicedate"), F.max("invoicedate").alias("max_invoicedate"),
        F.min(p).alias("min_price"), F.max(p).alias("max_price"),
        F.min(q).alias("min_quantity"), F.max(q).alias("max_quantity"),
    )


# ---------------------------------------------------------------- staging validation

def _is_non_product():
    return (F.col("stockcode") == MANUAL_STOCKCODE) | F.col("description").isin(NON_PRODUCT_DESCRIPTIONS)


def _total_mismatch():
    recomputed = F.round(F.col("quantity").cast(PRICE) * F.col("price"), 2)
    return F.round(F.col("total_price"), 2) != recomputed


def val_row_count(staging: DataFrame) -> DataFrame:
    return staging.agg(_count().alias("staging_row_count"))


def val_negative_price(staging: DataFrame) -> DataFrame:
    return staging.agg(_count_if(F.col("price") < 0).alias("negative_price_rows"))


def val_non_product(staging: DataFrame) -> DataFrame:
    return staging.agg(_count_if(_is_non_product()).alias("non_product_rows"))


def val_spacing(staging: DataFrame) -> DataFrame:
    d = F.col("description")
    return staging.agg(_count_if(d != F.trim(d)).alias("spacing_issues_remaining"))


def val_total_price(staging: DataFrame) -> DataFrame:
    return staging.agg(_count_if(_total_mismatch()).alias("incorrect_total_price_rows"))


def val_expected_rows(raw: DataFrame) -> DataFrame:
    return expected_staging_filter(raw).agg(_count().alias("expected_staging_rows"))


def val_returns_kept(staging: DataFrame) -> DataFrame:
    return staging.agg(_count_if(F.col("quantity") < 0).alias("negative_quantity_rows"))


def val_cancelled_kept(staging: DataFrame) -> DataFrame:
    return staging.agg(_count_if(F.col("invoice").startswith("C")).alias("cancelled_invoice_rows"))


def val_reconcile(staging: DataFrame, raw: DataFrame) -> DataFrame:
    """Two one-row aggregates side by side (the scalar subqueries)."""
    return side_by_side(staging.agg(_count().alias("staging_rows")),
                        expected_staging_filter(raw).agg(_count().alias("expected_rows")))


def validate_staging(staging: DataFrame) -> DataFrame:
    """All staging-side checks in one scan."""
    d = F.col("description")
    return staging.agg(
        _count().alias("staging_row_count"),
        _count_if(F.col("price") < 0).alias("negative_price_rows"),
        _count_if(_is_non_product()).alias("non_product_rows"),
        _count_if(d != F.trim(d)).alias("spacing_issues_remaining"),
        _count_if(_total_mismatch()).alias("incorrect_total_price_rows"),
        _count_if(F.col("quantity") < 0).alias("negative_quantity_rows"),
        _count_if(F.col("invoice").startswith("C")).alias("cancelled_invoice_rows"),
        _count_if(F.col("total_price").isNull()).alias("null_total_price_rows"),
    )


# ---------------------------------------------------------------- star checks

def star_rows_check(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """staging rows vs fact rows; they differ by design (the fact also
    drops lines without invoice / stock code / date / country)."""
    return side_by_side(staging.agg(_count().alias("staging_rows")), fact.agg(_count().alias("fact_rows")))


def star_fact_reconcile(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Staging lines that pass the fact's own filters vs fact rows: equal
    when every eligible line found its country (the check the plain row
    comparison above cannot make)."""
    return side_by_side(fact_eligible(staging).agg(_count().alias("eligible_rows")),
                        fact.agg(_count().alias("fact_rows")))


def star_dim_counts(dim_date: DataFrame, dim_country: DataFrame, dim_product: DataFrame,
                    dim_customer: DataFrame) -> DataFrame:
    parts = [dim_date.agg(_count().alias("dim_date_rows")),
             dim_country.agg(_count().alias("dim_country_rows")),
             dim_product.agg(_count().alias("dim_product_rows")),
             dim_customer.agg(_count().alias("dim_customer_rows"))]
    return side_by_side(*parts)


def star_net_revenue(fact: DataFrame) -> DataFrame:
    return fact.agg(F.round(F.sum("total_price"), 2).alias("net_revenue"))


def dq_fk_orphans(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame,
                  dim_product: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Fact rows whose key has no dimension row (declared, unenforced FKs);
    NULL customers are not orphans. Each check anti-joins the *distinct*
    fact keys (partially aggregated) against the dimension, so the fact is
    never shuffled line by line."""
    def orphans(key, dim, alias):
        keys = fact.where(F.col(key).isNotNull()).groupBy(key).agg(_count().alias("_n"))
        return keys.join(dim.select(key), key, "left_anti").agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias(alias))
    parts = [orphans("date_key", dim_date, "orphan_date_rows"),
             orphans("country_id", dim_country, "orphan_country_rows"),
             orphans("stockcode", dim_product, "orphan_product_rows"),
             orphans("customer_id", dim_customer, "orphan_customer_rows")]
    return side_by_side(*parts)
