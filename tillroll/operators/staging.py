"""Cleaned staging layer, rebuilt from raw under fixed quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import MANUAL_STOCKCODE, NON_PRODUCT_DESCRIPTIONS
from tillroll.schemas import RAW_COLUMNS, STAGING_COLUMNS, TOTAL


# number of the rules below: a change of theirs makes what was staged before out of date
RULES = 1


def rule_name(keep_null_description: bool = False) -> str:
    """What the staged lines were made by, as staging's ledger records it."""
    return f"v{RULES}" + ("+null-description" if keep_null_description else "")


def total_price(quantity, price):
    """quantity * price as DECIMAL(14,2); NULL on overflow (try_cast), where
    ANSI mode would otherwise fail the job."""
    return (quantity * price).try_cast(TOTAL)


def staging_clean(raw: DataFrame, keep_null_description: bool = False,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Rules, in order: quantity and price present, price >= 0, stockcode is
    not 'M' (NULL stockcode also drops), description not a non-product label
    (a NULL description drops too, unless ``keep_null_description``), then
    trim the description (after the filter, so ' BANK CHARGES' survives) and
    add total_price. Returns and cancellations are kept. Columns of ``carry``
    are passed on.

    Narrow transformations only: Catalyst pushes the comparisons into the
    scan and the whole step runs in one codegen stage, no shuffle.
    """
    desc = F.col("description")
    desc_ok = ~desc.isin(NON_PRODUCT_DESCRIPTIONS)
    if keep_null_description:
        desc_ok = ~F.coalesce(desc, F.lit("")).isin(NON_PRODUCT_DESCRIPTIONS)
    return (raw.select(*RAW_COLUMNS, *carry)
            .where(F.col("quantity").isNotNull()
                   & F.col("price").isNotNull()
                   & (F.col("price") >= 0)
                   & (F.col("stockcode") != MANUAL_STOCKCODE)
                   & desc_ok)
            .withColumn("description", F.trim(desc))
            .withColumn("total_price", total_price(F.col("quantity"), F.col("price")))
            .select(*STAGING_COLUMNS, *carry))


def expected_staging_filter(raw: DataFrame) -> DataFrame:
    """The validation's own rule on raw: like ``staging_clean`` but a NULL
    description is kept (COALESCE(description, '') NOT IN ...)."""
    return raw.where(F.col("quantity").isNotNull()
                     & F.col("price").isNotNull()
                     & (F.col("price") >= 0)
                     & (F.col("stockcode") != MANUAL_STOCKCODE)
                     & ~F.coalesce(F.col("description"), F.lit("")).isin(NON_PRODUCT_DESCRIPTIONS))
