"""Publishing sinks: versioned + latest datasets, CSV exports, text report.

Figures are published as their *data* (chart-ready datasets), not PNGs.
Datasets are written to ``versioned/<name>/v=<N>-<run>``; which of them is the
latest is said by the last entry of the log next to them. Its number is the
version, so one version is published once, and a write that is killed or comes
second leaves the former one in place. Readers ask ``latest``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import marts
from tillroll.schemas import STATE_SCHEMA
from tillroll.sources import storage
from tillroll.sources.storage import CommitConflict, CommitLog

# Names of the five figure datasets.
FIGURE_FEEDS = {
    "daily_revenue_over_time": lambda s: marts.fig_daily_revenue(s.revenue_source(), s.dim_date),
    "monthly_revenue_over_time": lambda s: marts.fig_monthly_revenue(s.revenue_source(), s.dim_date),
    "top_countries_by_revenue": lambda s: marts.fig_top_countries(s.revenue_source(), s.dim_country),
    "top_products_by_revenue": lambda s: marts.fig_top_products(s.fact, s.dim_product),
    "revenue_breakdown_gross_returns_net": lambda s: marts.fig_revenue_breakdown(s.revenue_source()),
}


def publish_datasets(spark: SparkSession, datasets: dict[str, DataFrame], root: str, version: int,
                     state: dict | None = None) -> dict[str, str]:
    """Write ``datasets`` and make them, all at once, version ``version`` of ``root``.

    The version must follow the last one published there; if it doesn't (any
    more), nothing is switched or left behind and ``CommitConflict`` is raised.
    Returns the folder of each."""
    log, run = CommitLog(spark, root), uuid.uuid4().hex[:12]
    folders = {name: f"versioned/{name}/v={version}-{run}" for name in datasets}
    try:
        if log.version() != version - 1:
            raise CommitConflict(f"{root}: version {version} doesn't follow {log.version()}")
        for name, df in datasets.items():
            df.write.parquet(f"{root}/{folders[name]}")
        log.commit({"datasets": folders, "state": state}, after=version - 1)
    except CommitConflict:
        for folder in folders.values():
            storage.remove(spark, f"{root}/{folder}")
        raise
    return {name: f"{root}/{folder}" for name, folder in folders.items()}


def latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The dataset as last published."""
    for entry in reversed(CommitLog(spark, root).entries()):
        if name in entry["datasets"]:
            return spark.read.parquet(f"{root}/{entry['datasets'][name]}")
    raise FileNotFoundError(f"{root}: nothing published as {name}")


def publish_dataset(spark: SparkSession, df: DataFrame, root: str, name: str, version: int) -> str:
    """One dataset with a log of its own, ``root/<name>``; its folder."""
    return publish_datasets(spark, {name: df}, f"{root}/{name}", version)[name]


def published_state(spark: SparkSession, root: str) -> DataFrame:
    """The change gate's state as of the last publication (no row before the first)."""
    entries = CommitLog(spark, root).entries()
    last = entries[-1] if entries else {}
    if not last.get("state"):
        return spark.createDataFrame([], STATE_SCHEMA)
    sig = last["state"]
    return spark.createDataFrame([((sig["max_date"], sig["n_rows"], sig.get("net_revenue")), last["version"], sig["at"])], STATE_SCHEMA)


def publish_figure_feeds(spark: SparkSession, star, root: str, version: int, signature: dict | None = None) -> DataFrame:
    """Publish the five figure datasets as one version, with the signature they
    were made for; a manifest of what readers find now (name, version, rows)."""
    state = signature and {k: signature.get(k) for k in ("max_date", "n_rows", "net_revenue")} | {
        "at": _dt.datetime.now(_dt.timezone.utc).isoformat()}
    publish_datasets(spark, {name: build(star) for name, build in FIGURE_FEEDS.items()}, root, version, state)
    parts = [latest(spark, root, name)
             .agg(F.count(F.lit(1)).cast("long").alias("rows"))
             .select(F.lit(name).alias("name"), F.lit(version).cast("long").alias("version"), "rows")
             for name in FIGURE_FEEDS]
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy("name")


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV, rows in the DataFrame's order. Multi-part by default;
    ``single_file`` (one task) only for small results and one-file readers."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_report(lines: DataFrame, path: str) -> None:
    """Text report (a few dozen lines) as one file, in line order."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)
