"""Source CSV files: fixed schema, bound by position, header skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.functions.text import blank_as_null
from tillroll.schemas import CSV_SCHEMA

# Fixed value: source timestamp layout.
SOURCE_TS_FORMAT = "M/d/yyyy H:mm"


UNPARSED_COLUMN = "_unparsed"


def read_retail_csv(spark: SparkSession, paths, keep_unparsed: bool = False) -> DataFrame:
    """Read one path, a glob or a list of them. PERMISSIVE: a cell that does
    not parse (e.g. ``13085.0`` in an integer column) becomes NULL.
    Splittable, so large files are read in parallel splits.

    ``keep_unparsed`` adds ``_unparsed``: the raw text of every line that
    had at least one such cell (NULL otherwise), for ``parse_quality``."""
    schema = CSV_SCHEMA
    r = (spark.read
         .option("header", "true")
         .option("mode", "PERMISSIVE")
         .option("timestampFormat", SOURCE_TS_FORMAT)
         .option("timestampNTZFormat", SOURCE_TS_FORMAT)
         .option("enforceSchema", "true"))
    if keep_unparsed:
        schema = StructType(CSV_SCHEMA.fields + [StructField(UNPARSED_COLUMN, StringType(), True)])
        r = r.option("columnNameOfCorruptRecord", UNPARSED_COLUMN)
    return r.schema(schema).csv(paths)


def parse_quality(lines: DataFrame) -> DataFrame:
    """One row: lines read and lines with a cell that did not parse (which
    the PERMISSIVE read turned into NULL). Input from
    ``read_retail_csv(..., keep_unparsed=True)``."""
    # every source column is referenced (through a hash that the optimizer
    # cannot fold away) so the CSV reader parses all cells; with column
    # pruning it would parse only the referenced ones and miss bad cells
    every = F.xxhash64(*[F.col(f.name) for f in CSV_SCHEMA.fields])
    return lines.agg(
        F.count(every).cast("long").alias("lines_read"),
        F.count(F.when(F.col(UNPARSED_COLUMN).isNotNull(), every))
        .cast("long").alias("lines_with_unparsed_cells"))


def read_retail_csv_blank_as_null(spark: SparkSession, paths) -> DataFrame:
    """Bulk-load variant: empty and blank string cells load as NULL."""
    return load_blank_as_null(read_retail_csv(spark, paths))


def load_blank_as_null(df: DataFrame) -> DataFrame:
    return df.select(*[
        blank_as_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def write_retail_csv(df: DataFrame, path: str) -> None:
    """Write lines in the source layout (header, ``M/d/yyyy H:mm``), keeping
    leading / trailing spaces inside cells."""
    (df.write.mode("overwrite")
     .option("header", "true")
     .option("timestampFormat", SOURCE_TS_FORMAT)
     .option("timestampNTZFormat", SOURCE_TS_FORMAT)
     .option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
