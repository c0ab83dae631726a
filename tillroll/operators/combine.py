"""Put one-row aggregates side by side without a join.

Each input is a one-row DataFrame with its own column names. Every input
is projected onto the union of all columns (NULL where it has no value),
the projections are unioned, and one global aggregate keeps the single
non-NULL value per column. Two tiny inputs, one tiny aggregate, no join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*parts: DataFrame) -> DataFrame:
    fields = [f for p in parts for f in p.schema.fields]
    names = [f.name for f in fields]
    if len(set(names)) != len(names):
        raise ValueError(f"column names must be distinct across parts: {names}")
    projected = []
    for p in parts:
        own = set(p.columns)
        projected.append(p.select(*[
            F.col(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name)
            for f in fields]))
    u = reduce(lambda a, b: a.unionByName(b), projected)
    return u.agg(*[F.max(n).alias(n) for n in names])
