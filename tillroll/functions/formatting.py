"""Number formatting matching the report's format specs, as columns.

``{:,.Nf}`` -> ``format_number``; ``{:.4f}`` -> ``format_number`` without grouping;
``{:.6g}`` needs Python's general format (strip trailing zeros, scientific
below 1e-4 or from 1e6), built from ``%.5e`` to find the rounded exponent.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _nan_guard(x: Column, formatted: Column) -> Column:
    return (F.when(x.isNull(), F.lit("None"))
            .when(F.isnan(x), F.lit("nan"))
            .when(x == float("inf"), F.lit("inf"))
            .when(x == float("-inf"), F.lit("-inf"))
            .otherwise(formatted))


def fmt_grouped(x: Column, decimals: int) -> Column:
    """Python ``{:,.Nf}``."""
    return _nan_guard(x, F.format_number(x, decimals))


def _fixed(x: Column, decimals: int) -> Column:
    # format_number rounds on the exact binary value (half-even), as Python
    # does; java.util.Formatter's %f rounds the shortest decimal string
    # half-up and differs on ties such as 2.675
    return F.regexp_replace(F.format_number(x, decimals), ",", "")


def fmt_fixed(x: Column, decimals: int) -> Column:
    """Python ``{:.Nf}``."""
    return _nan_guard(x, _fixed(x, decimals))


def _strip_zeros(s: Column) -> Column:
    s = F.regexp_replace(s, r"(\.[0-9]*?)0+$", "$1")
    return F.regexp_replace(s, r"\.$", "")


def fmt_general6(x: Column) -> Column:
    """Python ``{:.6g}``."""
    sci = F.format_string("%.5e", x)
    exp = F.split(sci, "e").getItem(1).cast("int")
    fixed = None
    for e in range(-4, 6):
        branch = _strip_zeros(_fixed(x, 5 - e))
        fixed = F.when(exp == e, branch) if fixed is None else fixed.when(exp == e, branch)
    mant = _strip_zeros(F.split(sci, "e").getItem(0))
    sci_py = F.concat(mant, F.lit("e"), F.split(sci, "e").getItem(1))
    out = fixed.otherwise(sci_py)
    return _nan_guard(x, F.when(x == 0, F.lit("0")).otherwise(out))
