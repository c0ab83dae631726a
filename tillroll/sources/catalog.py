"""Namespaces and tables in the session catalog, so the layers can be queried
with plain SQL (``spark.sql("SELECT ... FROM analytics.fact_sales")``).

Databases ``raw``, ``staging`` and ``analytics`` are created if missing. What
users name is a view over a table that belongs to one committed state of one
warehouse and is never changed (its name ends in a digest of the folders it
reads, and its partitions are the committed ones). Registering again makes the
table of the new state, then replaces the view in one step: a query sees the
state before or the one after, never a missing table, and another warehouse
takes the names over whole. The table of the state before stays for queries
that began with it; the one before that is dropped (tables are external, so no
data goes).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tillroll.schemas import (DIM_COUNTRY_SCHEMA, DIM_CUSTOMER_SCHEMA, DIM_DATE_SCHEMA, DIM_PRODUCT_SCHEMA,
                              FACT_TABLE_SCHEMA, RAW_TABLE_SCHEMA, STAGING_TABLE_SCHEMA)
from tillroll.sources import storage

NAMESPACES = ("raw", "staging", "analytics")
#: A view's property that names the table behind it and the one behind its predecessor.
BEHIND = "tillroll.tables"
#: Partitions added by one statement.
PARTS_AT_ONCE = 1000


def create_namespaces(spark: SparkSession, location_root: str | None = None) -> None:
    """Create the three databases; with ``location_root`` their folders live
    under it (shared storage), not in the session's local working folder."""
    for ns in NAMESPACES:
        loc = f" LOCATION '{location_root.rstrip('/')}/{ns}.db'" if location_root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}{loc}")


def register_layers(spark: SparkSession, wh) -> None:
    """Point the names at the committed state of a ``Warehouse``: raw batches
    and staged steps in their logs, the star's latest build."""
    from tillroll.plans.pipeline import RAW_TABLE, STAGING_TABLE
    create_namespaces(spark, wh.path("_catalog"))

    def parts(layer: str, folder: str) -> list[str]:
        base = wh.path(f"{layer}/{folder}")
        return [f"{base}/{name}" for name in storage.names(spark, base) if "=" in name]

    raw = [({"load_batch": c["batch"], "invoice_month": int(at.rsplit("=", 1)[1])}, at)
           for c in wh.raw_commits() if c["rows"] for at in parts(RAW_TABLE, c["folder"])]
    publish_view(spark, "raw.online_retail", RAW_TABLE_SCHEMA, ["load_batch", "invoice_month"], wh.path(RAW_TABLE), raw)
    staged = [({"load_batch": at.rsplit("=", 1)[1]}, at)
              for e in wh.staged() if e["rows"] for at in parts(STAGING_TABLE, e["folder"])]
    publish_view(spark, "staging.online_retail_clean", STAGING_TABLE_SCHEMA, ["load_batch"], wh.path(STAGING_TABLE), staged)
    if wh.latest_version() == 0:
        return
    base = wh.star_folder()
    for name, schema in (("dim_date", DIM_DATE_SCHEMA), ("dim_country", DIM_COUNTRY_SCHEMA), ("dim_product", DIM_PRODUCT_SCHEMA),
                         ("dim_customer", DIM_CUSTOMER_SCHEMA), *[(agg, spark.read.parquet(f"{base}/{agg}").schema) for agg in ("agg_daily_country", "agg_invoice")
                           if storage.names(spark, f"{base}/{agg}")]):
        publish_view(spark, f"analytics.{name}", schema, [], f"{base}/{name}", [])
    at = f"{base}/fact_sales"
    months = [({"date_month": int(n.rsplit("=", 1)[1])}, f"{at}/{n}") for n in storage.names(spark, at) if "=" in n]
    publish_view(spark, "analytics.fact_sales", FACT_TABLE_SCHEMA, ["date_month"], at, months)


def publish_view(spark: SparkSession, view: str, schema: StructType, by: list[str], location: str,
                 parts: list[tuple[dict, str]]) -> None:
    """Make ``view`` show a table at ``location``, or those partitions of it (values, folder) and no others."""
    digest = hashlib.sha256("\n".join([location, *(folder for _, folder in parts)]).encode()).hexdigest()[:16]
    table = f"{view}__{digest}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    by_sql = f" PARTITIONED BY ({', '.join(by)})" if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{by_sql} LOCATION '{location}'")
    for k in range(0, len(parts), PARTS_AT_ONCE):
        added = " ".join("PARTITION ({}) LOCATION '{}'".format(", ".join(f"{c} = {v!r}" for c, v in values.items()), folder)
                         for values, folder in parts[k:k + PARTS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    before, older = _behind(spark, view)
    if table == before:
        return
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{BEHIND}' = '{table};{before}') "
              f"AS SELECT {', '.join(schema.fieldNames())} FROM {table}")
    if older and older not in (before, table):
        spark.sql(f"DROP TABLE IF EXISTS {older}")


def _behind(spark: SparkSession, view: str) -> tuple[str, str]:
    """The table behind a view, and the one behind the view that it replaced ('' if there is none)."""
    if not spark.catalog.tableExists(view):
        return "", ""
    listed = spark.sql(f"SHOW TBLPROPERTIES {view}").where(f"key = '{BEHIND}'").collect()
    now, before = listed[0]["value"].split(";") if listed else ("", "")
    return now, before
