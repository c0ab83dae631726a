"""String rules used by the cleaning and star-building steps."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Descriptions that mark non-product lines, and the manual
# stock code. Comparison is exact and case-sensitive.
NON_PRODUCT_DESCRIPTIONS = ["BANK CHARGES", "AMAZONFEE"]
MANUAL_STOCKCODE = "M"


def blank_to_null(c: Column) -> Column:
    """NULLIF(TRIM(c), '') as a NULL test helper: NULL when c is NULL or only spaces."""
    return F.nullif(F.trim(c), F.lit(""))


def is_non_blank(c: Column) -> Column:
    return blank_to_null(c).isNotNull()


def blank_as_null(c: Column) -> Column:
    """Bulk-load rule (empty or blank cell -> NULL), value otherwise untouched."""
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def has_edge_space(c: Column) -> Column:
    """description LIKE ' %' OR description LIKE '% '."""
    return c.startswith(" ") | c.endswith(" ")


def product_label(stockcode: Column, name: Column) -> Column:
    return F.concat_ws(" - ", stockcode, name)
