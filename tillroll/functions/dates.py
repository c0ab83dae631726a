"""Calendar attributes of the date dimension."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quarter-four months.
Q4_MONTHS = [10, 11, 12]


def date_key(ts: Column) -> Column:
    """YYYYMMDD as an integer, computed arithmetically (no string round trip)."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def date_key_month(date_key_col: Column) -> Column:
    """YYYYMM of a date key, used to partition the fact table."""
    return (date_key_col / 100).cast("int")


def calendar_columns(full_date: Column) -> list[Column]:
    """Attributes derived from one calendar date, in dim_date column order
    after date_key/full_date. Sunday is day 1; week is the ISO week, paired
    with the calendar year (so 2010-01-01 is (2010, 53)) as in the source."""
    return [
        F.dayofmonth(full_date).cast("int").alias("day"),
        F.dayofweek(full_date).cast("int").alias("day_of_week"),
        F.date_format(full_date, "EEEE").alias("day_name"),
        F.weekofyear(full_date).cast("int").alias("week_of_year"),
        F.quarter(full_date).cast("int").alias("quarter"),
        F.month(full_date).cast("int").alias("month"),
        F.date_format(full_date, "MMMM").alias("month_name"),
        F.year(full_date).cast("int").alias("year"),
    ]


def is_q4(month_col: Column) -> Column:
    return F.when(month_col.isin(Q4_MONTHS), F.lit(1)).otherwise(F.lit(0)).cast("int")
