"""Star schema: four dimensions and the sales fact, built from staging.

Every dimension is an aggregate over staging (partial aggregation on the
map side, so a hot date / product / customer is one row per task before
the shuffle). The fact is a narrow projection of staging joined to the
country dimension, which is broadcast after a size check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import calendar_columns, date_key
from tillroll.functions.text import is_non_blank
from tillroll.operators.joins import checked_broadcast
from tillroll.operators.keys import dense_number

# Countries are a bounded domain; the bound is re-checked at run time.
COUNTRY_MAX_ROWS = 100_000


def dim_date(staging: DataFrame) -> DataFrame:
    """One row per calendar date that has at least one dated staging line.
    Distinct dates first (tiny), calendar attributes after."""
    days = (staging.where(F.col("invoicedate").isNotNull())
            .select(F.to_date("invoicedate").alias("full_date"))
            .distinct())
    fd = F.col("full_date")
    return days.select(date_key(fd).alias("date_key"), fd, *calendar_columns(fd))


def dim_country(staging: DataFrame) -> DataFrame:
    """Distinct trimmed non-blank countries; ``country_id`` numbers them 1..N
    in name order, computed distributed (``dense_number``), not in one task."""
    names = (staging.where(is_non_blank(F.col("country")))
             .select(F.trim("country").alias("country"))
             .distinct())
    return dense_number(names, "country", "country_id").select("country_id", "country")


def dim_product(staging: DataFrame) -> DataFrame:
    """One row per trimmed stock code; product name is the lexically largest
    non-empty description (code semantics, not 'most recent').

    A maximum over strings sorts its input, so lines are first hash-reduced to
    distinct (code, description) pairs and only those are sorted."""
    pairs = (staging.where(is_non_blank(F.col("stockcode")))
             .select(F.trim("stockcode").alias("stockcode"),
                     F.nullif(F.col("description"), F.lit("")).alias("description"))
             .distinct())
    return pairs.groupBy("stockcode").agg(F.max("description").alias("product_name"))


def dim_customer(staging: DataFrame) -> DataFrame:
    d = F.to_date("invoicedate")
    return (staging.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.min(d).alias("first_seen_date"), F.max(d).alias("last_seen_date")))


def fact_eligible(staging: DataFrame) -> DataFrame:
    """Staging lines that can enter the fact: invoice, stock code, date and
    country present (blank stock code / country count as absent)."""
    return staging.where(F.col("invoice").isNotNull()
                         & is_non_blank(F.col("stockcode"))
                         & F.col("invoicedate").isNotNull()
                         & is_non_blank(F.col("country")))


def fact_sales(staging: DataFrame, countries: DataFrame, with_id: bool = True,
               countries_materialized: bool = False) -> DataFrame:
    """Fact lines joined to dim_country on ``country = TRIM(staging.country)``.

    ``countries`` is broadcast only after its row count is checked
    (``checked_broadcast``); a written dimension table is counted directly,
    a computed one is checkpointed first. ``fact_id`` is unique, not dense.
    """
    c = checked_broadcast(countries.select("country_id", "country"), COUNTRY_MAX_ROWS,
                          materialize=not countries_materialized)
    s = fact_eligible(staging)
    j = s.join(c, F.trim(s["country"]) == c["country"], "inner")
    cols = [
        s["invoice"],
        F.trim(s["stockcode"]).alias("stockcode"),
        s["customer_id"],
        c["country_id"],
        date_key(s["invoicedate"]).alias("date_key"),
        s["quantity"],
        s["price"],
        s["total_price"],
        s["invoicedate"].alias("invoice_ts"),
    ]
    out = j.select(*cols)
    if with_id:
        out = out.select(F.monotonically_increasing_id().alias("fact_id"), *out.columns)
    return out


@dataclass
class Star:
    fact: DataFrame
    dim_date: DataFrame
    dim_country: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    # day x country rollup of the fact (see marts.daily_country_rollup);
    # written by the pipeline, None when the star is computed on the fly
    daily: DataFrame | None = None
    # day x country x invoice rollup (see marts.invoice_rollup), likewise
    invoices: DataFrame | None = None

    def order_source(self) -> DataFrame:
        """What a mart with distinct invoices should scan."""
        return self.invoices if self.invoices is not None else self.fact

    def revenue_source(self) -> DataFrame:
        """What a revenue-by-day/country mart should scan: the rollup when
        it exists, else the fact."""
        return self.daily if self.daily is not None else self.fact


def build_star(staging: DataFrame, with_id: bool = True) -> Star:
    # dim_country is already materialized by its numbering (checkpointed),
    # so the size check before the broadcast reads it directly
    countries = dim_country(staging)
    return Star(
        fact=fact_sales(staging, countries, with_id=with_id, countries_materialized=True),
        dim_date=dim_date(staging),
        dim_country=countries,
        dim_product=dim_product(staging),
        dim_customer=dim_customer(staging),
    )
