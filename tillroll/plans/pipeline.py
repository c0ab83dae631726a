"""Batch pipeline over a warehouse folder: load -> profile -> stage ->
validate -> star -> KPI export -> figure feeds -> statistics.

Storage layout under ``root`` (Parquet). Every layer has a log of commits
(``sources/storage.py``), and readers see what its entries name, nothing else:

* ``raw/online_retail``: append-only. A batch is written to
  ``load_batch=<id>/attempt=<n>``, by invoice month (yyyyMM of invoicedate;
  ``0`` for a NULL date), and is there once its entry is: whole or not at all,
  and once for each batch id. The entry has the folder, rows, months, schema
  and line ids of the batch. Two runs at a time can't both append to what they
  read: the second one compares its lines with the first one's batch anew.
* ``staging/online_retail_clean``: the rule on raw, kept in generations. Each
  step of a generation stages some raw batches; its entry is the ledger of
  staged batches. What is missing is always the set difference of raw's log
  and the ledger, whichever way batches came and wherever a run died. A change
  of rule starts a new generation, and the old one is read until it is whole.
* ``analytics``: star schema builds, each in a folder of its own; the fact is
  partitioned by ``date_month`` and sorted by (date_key, invoice_ts) inside
  partitions. With the star come ``agg_invoice`` (day x country x invoice) and
  ``agg_daily_country`` (day x country), rolled up from it.
  A build's entry comes after all its tables, so readers never see half a model.
* ``serving/daily_kpis``: the KPIs kept up to staging by day. A step holds the
  days that new batches have lines of, made anew from all their lines; readers
  take each day from the last step that has it.
* ``outputs/figures``: the five feeds of one version and the change gate's
  state, switched by one entry.

Row counts come from ``Observation`` metrics on the write itself, never
from a second pass over the data.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import date_key_month
from tillroll.operators import marts, quality, stats, sync
from tillroll.operators.joins import checked_broadcast
from tillroll.operators.keys import file_offsets, place_rows, slices
from tillroll.operators.staging import rule_name, staging_clean
from tillroll.operators.star import (Star, dim_country, dim_customer, dim_date, dim_product,
                                     fact_sales)
from tillroll.schemas import (CSV_SCHEMA, FACT_TABLE_SCHEMA, KPI_SCHEMA, RAW_COLUMNS, RAW_TABLE_SCHEMA, STAGING_COLUMNS,
                              STAGING_TABLE_SCHEMA)
from tillroll.session import scratch_root
from tillroll.sources import publish, state, storage
from tillroll.sources.storage import CommitConflict, CommitLog

RAW_TABLE = "raw/online_retail"
STAGING_TABLE = "staging/online_retail_clean"
STAR_TABLES = "analytics"
KPI_TABLE = "serving/daily_kpis"
# so many refreshed steps, and all days are made anew
KPI_STEPS = 64
# a sync that finds another batch committed meanwhile starts over so often
SYNC_TRIES = 5
# lines of a batch that one slice of its days holds, at most and (to use all
# cores for smaller batches) at least; most days told apart
SLICE_ROWS, LEAST_ROWS, MAX_DAYS = 250_000, 5_000, 4_000_000


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    last_batch_id: str | None = None

    def path(self, rel: str) -> str:
        return f"{self.root.rstrip('/')}/{rel}"

    def log(self, rel: str) -> CommitLog:
        return CommitLog(self.spark, self.path(rel))

    # ------------------------------------------------------------ raw

    def raw_commits(self) -> list[dict]:
        """Entries of the committed batches, oldest first."""
        return self.log(RAW_TABLE).entries()

    def raw(self) -> DataFrame:
        return self._raw_of(self.raw_commits())

    def _raw_of(self, commits: list[dict], months: list[int] | None = None) -> DataFrame:
        """The lines of some batches, and of some months only."""
        folders = [c["folder"] for c in commits
                   if c["rows"] and (months is None or not set(months).isdisjoint(c["months"]))]
        df = storage.read_folders(self.spark, self.path(RAW_TABLE), folders, RAW_TABLE_SCHEMA)
        return df if months is None else df.where(F.col("invoice_month").isin(months))

    def sync_raw(self, incoming: DataFrame, null_safe: bool = False,
                 batch_id: str | None = None, landed: bool = False) -> int:
        """Append the unseen lines of ``incoming``; returns the count,
        measured on the write (the plan runs once).

        The batch is there from the moment its log entry is. With ``batch_id``
        the call may be repeated: a batch in the log is skipped (a replayed
        stream epoch does not append its NULL-key lines twice), one that died
        on the way is written anew, and its leavings are removed.

        ``landed``: ``incoming`` is a scan of Parquet files that stay as they
        are until the call returns, with a filter or none, so the batch is
        read there and not copied first."""
        batch = batch_id or (_dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
                             + "-" + uuid.uuid4().hex[:8])
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch):
            raise ValueError(f"a batch id is made of letters, digits, '_', '.' and '-': {batch!r}")
        self.last_batch_id = batch
        if any(c["batch"] == batch for c in self.raw_commits()):
            return 0
        # The batch is read several times below (days, file offsets, keyed
        # lines, NULL-key lines): land it once as Parquet in the shared scratch
        # folder, so the source (CSV) is parsed once and the later reads are
        # columnar scans. Line ids are places in the landed files.
        landing = None if landed else f"{scratch_root(self.spark)}/landing/{uuid.uuid4().hex}"
        try:
            if landing:
                incoming.select(*RAW_COLUMNS).write.parquet(landing)
            for _ in range(SYNC_TRIES):
                commits = self.raw_commits()
                if any(c["batch"] == batch for c in commits):
                    return 0
                entry = self._write_batch(landing or incoming, batch, commits, null_safe)
                try:
                    self.log(RAW_TABLE).commit(entry, after=commits[-1]["version"] if commits else 0)
                except CommitConflict:
                    storage.remove(self.spark, self.path(f"{RAW_TABLE}/{entry['folder']}"))
                    continue
                self._remove_attempts(batch, entry["folder"])
                return entry["rows"]
            raise CommitConflict(f"{batch}: raw changed {SYNC_TRIES} times while the batch was compared with it")
        finally:
            if landing:
                storage.remove(self.spark, landing)

    def _write_batch(self, landing: str | DataFrame, batch: str, commits: list[dict], null_safe: bool) -> dict:
        """Write the landed lines that none of ``commits`` has, to a new folder; the batch's log entry."""
        landed = self.spark.read.schema(CSV_SCHEMA).parquet(landing) if isinstance(landing, str) else landing
        # Only raw months present in the batch can hold a matching key (the key
        # contains invoicedate; a NULL date is month 0). The month list is
        # bounded by the calendar, so it comes to the driver, where it chooses
        # the batches to read, and goes into the scan as a partition filter.
        days = checked_broadcast(landed.groupBy(F.to_date("invoicedate").alias("_day")).agg(F.count(F.lit(1)).alias("n")),
                                 MAX_DAYS)
        found = days.groupBy(sync.month_number("_day").alias("m")).agg(F.sum("n").alias("count")).collect()
        months = sorted(r["m"] for r in found)
        first = commits[-1]["next_id"] if commits else 1
        offsets = file_offsets(landed)
        numbers = offsets.agg(F.sum("_n")).first()[0] or 0
        new = place_rows(landed, offsets, "id", first)
        sharing = [c for c in commits if c["rows"] and not set(months).isdisjoint(c["months"])]
        if sharing:  # else no key of the batch can be in raw
            new = sync.new_rows(new, self._raw_of(sharing, months), null_safe=null_safe, carry=("id",))
        folder = f"load_batch={batch}/attempt={uuid.uuid4().hex[:12]}"
        rows = self._append(new, days, sum(r["count"] for r in found), f"{RAW_TABLE}/{folder}") if found else 0
        return {"batch": batch, "folder": folder, "rows": rows, "months": months,
                "first_id": first, "next_id": first + numbers,
                "schema": RAW_TABLE_SCHEMA.simpleString(),
                "committed_at": _dt.datetime.now(_dt.timezone.utc).isoformat()}

    def _append(self, new: DataFrame, days: DataFrame, batch_rows: int, rel: str) -> int:
        """Write numbered lines to a new raw folder; how many there were.

        ``days``: lines of the whole batch by day."""
        obs = Observation("sync_raw")
        # clustered by slices of the batch's days before the partitioned write:
        # a slice goes to one task and holds a contiguous stretch of days, so
        # there are few, large, time-sorted files per month folder (good min/max
        # skipping). No slice has more lines than its share of the batch: a day
        # with more has several, and its lines (those that share one timestamp
        # or are exact copies too) are dealt to them by line id, the same way
        # whenever a stage has to run again. The days are counted on the landed
        # batch, so the comparison with raw above runs once: a range exchange
        # would run it once more for its sample of the new lines.
        number = max(-(-batch_rows // SLICE_ROWS),
                     min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-batch_rows // LEAST_ROWS)))
        out = (new.select("id", *RAW_COLUMNS, sync.month_number().alias("invoice_month"), F.to_date("invoicedate").alias("_line_day"))
               .join(F.broadcast(slices(days, "_day", number)), F.col("_line_day").eqNullSafe(F.col("_day")))
               .withColumn("_slice", (F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_slices"))).cast("int"))
               .repartitionById(number, "_slice")
               .sortWithinPartitions("invoice_month", "invoicedate")
               .select("id", *RAW_COLUMNS, "invoice_month")
               .observe(obs, F.count(F.lit(1)).alias("rows")))
        out.write.partitionBy("invoice_month").parquet(self.path(rel))
        return int(obs.get.get("rows", 0))

    def _remove_attempts(self, batch: str, committed: str) -> None:
        """Folders that earlier, broken attempts at a committed batch left."""
        base = self.path(f"{RAW_TABLE}/load_batch={batch}")
        for name in storage.names(self.spark, base):
            if f"load_batch={batch}/{name}" != committed:
                storage.remove(self.spark, f"{base}/{name}")

    # ------------------------------------------------------------ staging

    def staged(self) -> list[dict]:
        """The ledger: entries of the current generation, oldest first."""
        entries = self.log(STAGING_TABLE).entries()
        return [e for e in entries if e["generation"] == entries[-1]["generation"]]

    def staging(self) -> DataFrame:
        return self._staging_of(self.staged()).select(*STAGING_COLUMNS)

    def _staging_of(self, ledger: list[dict]) -> DataFrame:
        folders = [e["folder"] for e in ledger if e["rows"]]
        return storage.read_folders(self.spark, self.path(STAGING_TABLE), folders, STAGING_TABLE_SCHEMA)

    def stage_missing(self, keep_null_description: bool = False) -> int:
        """Stage the raw batches that staging doesn't have; returns the lines added.

        The staging rules are row-local (filters + projection), so
        staging(raw + batch) = staging(raw) + staging(batch): appending the
        missing batches gives exactly what a full rebuild gives, reading only
        their folders. Staging made by another rule is rebuilt."""
        ledger = self.staged()
        if not ledger or ledger[-1]["rule"] != rule_name(keep_null_description):
            return self.rebuild_staging(keep_null_description)
        done = {b for e in ledger for b in e["batches"]}
        missing = [c for c in self.raw_commits() if c["batch"] not in done]
        return self._stage(missing, ledger[-1]["generation"], keep_null_description,
                           after=ledger[-1]["version"]) if missing else 0

    def stage_batch(self, batch_id: str, keep_null_description: bool = False) -> int:
        """Stage one raw batch; 0 if it isn't in raw, or staged already."""
        ledger = self.staged()
        if not ledger or ledger[-1]["rule"] != rule_name(keep_null_description):
            return self.stage_missing(keep_null_description)
        if any(batch_id in e["batches"] for e in ledger):
            return 0
        batch = [c for c in self.raw_commits() if c["batch"] == batch_id]
        return self._stage(batch, ledger[-1]["generation"], keep_null_description,
                           after=ledger[-1]["version"]) if batch else 0

    def rebuild_staging(self, keep_null_description: bool = False) -> int:
        """A new generation from all of raw; the one before stays readable
        until this one's entry is there (and for readers that began with it),
        those before that are removed."""
        entries = self.log(STAGING_TABLE).entries()
        generation = uuid.uuid4().hex[:12]
        rows = self._stage(self.raw_commits(), generation, keep_null_description,
                           after=entries[-1]["version"] if entries else 0)
        kept = {generation, *([entries[-1]["generation"]] if entries else [])}
        for old in sorted({e["generation"] for e in entries} - kept):
            storage.remove(self.spark, self.path(f"{STAGING_TABLE}/generation={old}"))
        return rows

    def _stage(self, commits: list[dict], generation: str, keep_null_description: bool, after: int) -> int:
        """Write the staged lines of some batches as one step and enter it in the ledger."""
        folder = f"generation={generation}/step={uuid.uuid4().hex[:12]}"
        rows = 0
        if any(c["rows"] for c in commits):
            obs = Observation("staging")
            # narrow filter/project over raw's time-clustered files, no shuffle
            (staging_clean(self._raw_of(commits), keep_null_description=keep_null_description, carry=("load_batch",))
             .observe(obs, F.count(F.lit(1)).alias("rows"))
             .write.partitionBy("load_batch").parquet(self.path(f"{STAGING_TABLE}/{folder}")))
            rows = int(obs.get.get("rows", 0))
        entry = {"generation": generation, "folder": folder, "rule": rule_name(keep_null_description),
                 "batches": [c["batch"] for c in commits], "rows": rows}
        try:
            self.log(STAGING_TABLE).commit(entry, after=after)
        except CommitConflict:
            storage.remove(self.spark, self.path(f"{STAGING_TABLE}/{folder}"))
            raise
        return rows

    # ------------------------------------------------------------ star

    def latest_version(self) -> int:
        return self.log(STAR_TABLES).version()

    def star_folder(self, version: int | None = None) -> str:
        """Folder of a committed build (the latest one by default)."""
        for e in reversed(self.log(STAR_TABLES).entries()):
            if version in (None, e["version"]):
                return self.path(f"{STAR_TABLES}/{e['folder']}")
        raise FileNotFoundError("no committed star schema build" + (f" {version}" if version else ""))

    def build_star(self) -> int:
        """Build a new star version from staging: dimensions first, then the
        fact against the *written* country dimension (cheap size check
        before the broadcast). Returns the committed version; of two builds
        that run at once the second one fails with ``CommitConflict``."""
        after = self.latest_version()
        folder = f"build={uuid.uuid4().hex[:12]}"
        try:
            self._write_star(self.path(f"{STAR_TABLES}/{folder}"))
            return self.log(STAR_TABLES).commit({"folder": folder}, after=after)
        except CommitConflict:
            storage.remove(self.spark, self.path(f"{STAR_TABLES}/{folder}"))
            raise

    def _write_star(self, base: str) -> None:
        stg = self.staging()
        dim_date(stg).write.mode("overwrite").parquet(f"{base}/dim_date")
        dim_country(stg).write.mode("overwrite").parquet(f"{base}/dim_country")
        dim_product(stg).write.mode("overwrite").parquet(f"{base}/dim_product")
        dim_customer(stg).write.mode("overwrite").parquet(f"{base}/dim_customer")
        countries = self.spark.read.parquet(f"{base}/dim_country")
        fact = fact_sales(stg, countries, with_id=True, countries_materialized=True)
        # no shuffle: raw is time-clustered when appended and staging is a
        # row-local transform of it, so each task's input is (mostly) one
        # time slice; a local sort gives few, time-sorted files per month
        # folder (min/max skipping on date_key / invoice_ts), and a hot month
        # is spread over as many writers as it has input splits
        (fact.withColumn("date_month", date_key_month(F.col("date_key")))
         .sortWithinPartitions("date_month", "date_key", "invoice_ts")
         .write.mode("overwrite").partitionBy("date_month").parquet(f"{base}/fact_sales"))
        # the rollups: one more scan and one shuffle of the written fact to
        # (day, country, invoice), and from that table to (day, country);
        # revenue marts, the KPI export, order value and the regression
        # dataset never touch the fact
        (marts.invoice_rollup(self.spark.read.schema(FACT_TABLE_SCHEMA).parquet(f"{base}/fact_sales"))
         .write.mode("overwrite").parquet(f"{base}/agg_invoice"))
        (marts.daily_country_rollup(self.spark.read.parquet(f"{base}/agg_invoice"))
         .write.mode("overwrite").parquet(f"{base}/agg_daily_country"))

    def star(self, version: int | None = None) -> Star:
        base = self.star_folder(version)
        r = self.spark.read.parquet
        fact = self.spark.read.schema(FACT_TABLE_SCHEMA).parquet(f"{base}/fact_sales")
        return Star(fact=fact, dim_date=r(f"{base}/dim_date"),
                    dim_country=r(f"{base}/dim_country"), dim_product=r(f"{base}/dim_product"),
                    dim_customer=r(f"{base}/dim_customer"), daily=r(f"{base}/agg_daily_country"),
                    # builds made before this table existed don't have it
                    invoices=r(f"{base}/agg_invoice") if storage.names(self.spark, f"{base}/agg_invoice") else None)

    # ------------------------------------------------------------ daily KPIs by day

    def kpi_steps(self) -> list[dict]:
        """Entries since the last refresh of all days, oldest first."""
        entries = self.log(KPI_TABLE).entries()
        whole = max((i for i, e in enumerate(entries) if e["days"] is None), default=0)
        return entries[whole:]

    def daily_kpis(self) -> DataFrame:
        """The refreshed KPIs: each day as the last step that made it has it."""
        steps, seen, parts = self.kpi_steps(), set(), []
        for e in reversed(steps):
            own = None if e["days"] is None else sorted(set(e["days"]) - seen)
            if own == []:  # a step without days has no folder
                continue
            step = storage.read_folders(self.spark, self.path(KPI_TABLE), [e["folder"]], KPI_SCHEMA)
            if own:
                parts.append(step.where(F.col("date_key").isin(own)))
                seen.update(own)
            else:
                parts.append(step.where(~F.col("date_key").isin(sorted(seen))) if seen else step)
        out = reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], KPI_SCHEMA)
        return out.drop("date_key")

    def refresh_daily_kpis(self) -> int:
        """Make the KPIs of the days anew that the staged batches since the
        last refresh have lines of; how many days (-1: all of them).

        The entry names the batches, so a run that died, or batches staged by
        another route, are caught up with by the next call. A new generation of
        staging, or ``KPI_STEPS`` steps, make all days anew."""
        ledger, steps = self.staged(), self.kpi_steps()
        if not ledger:
            return 0
        after = self.log(KPI_TABLE).version()
        if steps and steps[-1]["version"] != after:
            raise CommitConflict(f"{KPI_TABLE}: version {after} was committed by another run")
        generation, batches = ledger[-1]["generation"], {b for e in ledger for b in e["batches"]}
        staging = self._staging_of(ledger)
        days = None
        if steps and steps[0]["generation"] == generation and len(steps) < KPI_STEPS:
            new = batches - {b for e in steps for b in e["batches"]}
            if not new:
                return 0
            # the days of the new lines: bounded by the calendar
            found = (self._staging_of([e for e in ledger if new & set(e["batches"])]).where(F.col("load_batch").isin(sorted(new)))
                     .select(F.to_date("invoicedate").alias("day")).distinct().dropna().collect())
            dates = sorted(r["day"] for r in found)
            days = [d.year * 10000 + d.month * 100 + d.day for d in dates]
            if days:  # a range the scan can skip files and row groups by, then the days
                staging = staging.where(
                    (F.col("invoicedate") >= F.lit(dates[0]).cast("timestamp_ntz"))
                    & (F.col("invoicedate") < F.lit(dates[-1] + _dt.timedelta(days=1)).cast("timestamp_ntz"))
                    & F.to_date("invoicedate").isin(dates))
            batches = new
        folder = f"step={uuid.uuid4().hex[:12]}"
        if days is None or days:
            marts.daily_kpis_of_lines(staging).select(*KPI_SCHEMA.fieldNames()).write.parquet(self.path(f"{KPI_TABLE}/{folder}"))
        entry = {"generation": generation, "folder": folder, "batches": sorted(batches), "days": days}
        try:
            self.log(KPI_TABLE).commit(entry, after=after)
        except CommitConflict:
            storage.remove(self.spark, self.path(f"{KPI_TABLE}/{folder}"))
            raise
        if days is None:  # readers may still be in the steps up to now, but in none before
            kept = {e["folder"] for e in [*steps, entry]}
            for old in storage.names(self.spark, self.path(KPI_TABLE)):
                if old.startswith("step=") and old not in kept:
                    storage.remove(self.spark, self.path(f"{KPI_TABLE}/{old}"))
        return -1 if days is None else len(days)


def run_visuals(wh: Warehouse, star: Star, out_root: str) -> dict:
    """Change gate: publish the figure feeds only when the signature moved.

    Feeds and state are switched together by one entry, whose number is the
    version. Of two runs that decide on the same state one publishes; the
    other finds the version taken and refuses (``published`` false,
    ``conflict`` true), leaving nothing behind."""
    spark = wh.spark
    sig = marts.data_signature(star.revenue_source(), star.dim_date)
    gate = state.change_gate(sig, publish.published_state(spark, out_root)).first().asDict()
    if not gate["changed"]:
        return {**gate, "published": False}
    try:
        publish.publish_figure_feeds(spark, star, out_root, version=int(gate["next_version"]), signature=gate)
    except CommitConflict:
        return {**gate, "published": False, "conflict": True}
    return {**gate, "published": True}


def run_batch(spark: SparkSession, incoming: DataFrame, root: str,
              incremental_staging: bool = False, null_safe_sync: bool = False,
              keep_null_description: bool = False) -> dict:
    """The whole daily run. Returns the one-row checks as plain values.

    ``incremental_staging`` stages the raw batches that staging doesn't have,
    however they came, instead of rebuilding it from all of raw (same result,
    see ``stage_missing``); after a change of rule it rebuilds by itself.
    ``null_safe_sync`` compares sync keys with null-safe equality (NULL-key
    lines are then not re-inserted on every run); ``keep_null_description``
    keeps lines without a description in staging (the validation's rule)."""
    wh = Warehouse(spark, root)
    out = {"new_raw_rows": wh.sync_raw(incoming, null_safe=null_safe_sync)}
    out["profile"] = quality.profile_raw(wh.raw()).first().asDict()
    if incremental_staging:
        wh.stage_missing(keep_null_description=keep_null_description)
        out["staging_rows"] = sum(e["rows"] for e in wh.staged())
    else:
        out["staging_rows"] = wh.rebuild_staging(keep_null_description=keep_null_description)
    out["validation"] = quality.validate_staging(wh.staging()).first().asDict()
    out["star_version"] = wh.build_star()
    star = wh.star()
    out["star_counts"] = quality.star_dim_counts(star.dim_date, star.dim_country, star.dim_product,
                                                 star.dim_customer).first().asDict()
    out["fk_orphans"] = quality.dq_fk_orphans(star.fact, star.dim_date, star.dim_country,
                                              star.dim_product, star.dim_customer).first().asDict()
    exports = wh.path("outputs")
    kpis = (marts.kpis_from_rollup(star.daily, star.dim_date, star.dim_country) if star.daily is not None
            else marts.daily_kpis(star.fact, star.dim_date, star.dim_country))
    publish.export_csv(kpis, f"{exports}/bi/daily_kpis")
    out["visuals"] = run_visuals(wh, star, f"{exports}/figures")
    # statistics last, as in the source's step order: their guards (fewer
    # than 2 days in a group, too few days for the regression) fail the run
    # only after the layers, exports and figure feeds are published
    # the daily dataset (one row per trading day) needs per-day distinct
    # invoices, so it comes from the invoice rollup: computed once, written,
    # and the CSV export and both regression outputs read the written copy
    ds_path = f"{exports}/modeling/q4_regression_dataset_daily_parquet"
    stats.q4_daily_dataset(star.order_source(), star.dim_date).write.mode("overwrite").parquet(ds_path)
    ds = spark.read.parquet(ds_path).orderBy("order_date")
    publish.export_csv(ds, f"{exports}/modeling/q4_regression_dataset_daily")
    report = stats.q4_report(stats.daily_revenue(star.revenue_source(), star.dim_date),
                             stats.daily_return_rate(star.revenue_source(), star.dim_date))
    publish.write_report(report, f"{exports}/modeling/q4_stats_tests_report")
    coefs = stats.ols_q4(ds)
    publish.export_csv(coefs, f"{exports}/modeling/q4_regression_coefficients")
    out["ols"] = [r.asDict() for r in coefs.collect()]            # 3 rows
    out["ols_fit"] = stats.ols_q4_fit(ds).first().asDict()
    return out
