"""New source files -> raw, with Structured Streaming.

The source folder is watched as a CSV stream (same fixed schema and
timestamp layout as the batch reader). Every micro-batch runs the batch
sync (left-anti on the six-column key, NULL-key bypass) through
``foreachBatch``; the batch id is the stream's epoch, so a replayed epoch
after a failure is skipped instead of appended twice. Progress lives in
the checkpoint folder, which must be shared storage on a cluster. An epoch
then stages what staging doesn't have (``stage=True``): its own lines, and
those of an epoch that died after its commit. With ``kpis=True`` it then makes
the KPIs of the days anew that got lines.

``available_now=True`` processes everything present and stops (a daily
scheduled run); otherwise it polls every ``interval``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.plans.pipeline import Warehouse
from tillroll.schemas import CSV_SCHEMA
from tillroll.sources.csv import SOURCE_TS_FORMAT


def source_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream
         .schema(CSV_SCHEMA)
         .option("header", "true")
         .option("mode", "PERMISSIVE")
         .option("timestampFormat", SOURCE_TS_FORMAT)
         .option("timestampNTZFormat", SOURCE_TS_FORMAT))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(source_dir)


def start_ingest(spark: SparkSession, source_dir: str, warehouse_root: str,
                 checkpoint: str | None = None, available_now: bool = True,
                 interval: str = "1 minute", query_name: str = "raw_ingest",
                 max_files_per_trigger: int | None = None, stage: bool = False,
                 kpis: bool = False) -> StreamingQuery:
    """``max_files_per_trigger`` bounds the size of one micro-batch; with
    ``stage`` every epoch brings staging up to raw, with ``kpis`` the daily
    KPIs up to staging as well, only the days that got lines made anew."""
    wh = Warehouse(spark, warehouse_root)
    ckpt = checkpoint or wh.path(f"_streaming/{query_name}/checkpoint")

    def sync_batch(batch: DataFrame, epoch_id: int) -> None:
        # sync_raw lands the micro-batch once as Parquet before reading it
        # several times, so the source files are parsed once per epoch
        wh.sync_raw(batch, batch_id=f"{query_name}-epoch-{epoch_id}")
        if stage or kpis:
            wh.stage_missing()
        if kpis:
            wh.refresh_daily_kpis()

    w = (source_stream(spark, source_dir, max_files_per_trigger).writeStream
         .foreachBatch(sync_batch)
         .option("checkpointLocation", ckpt)
         .queryName(query_name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
