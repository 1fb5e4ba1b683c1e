"""CSV sources with declared schemas, and the report sinks.

The ticket and segment files are wide CSVs whose fields are identified by
position. The schemas below name the positions the library reads and keep the
others as ``_c<i>``; CSV column pruning then parses only the named fields that
a query uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 0-based field positions in the source files.
TICKET_FIELDS = {0: "ticket_id", 4: "issue_date", 21: "county", 23: "house_number", 24: "street_name"}
TICKET_WIDTH = 25
SEGMENT_FIELDS = {
    0: "segment_id", 2: "l_low", 3: "l_high", 4: "r_low", 5: "r_high",
    10: "street_label", 13: "boro_code", 28: "full_street", 29: "alt_label",
}
SEGMENT_WIDTH = 30

TICKET_COLUMNS = list(TICKET_FIELDS.values())
SEGMENT_COLUMNS = list(SEGMENT_FIELDS.values())


def positional_schema(fields: dict[int, str], width: int) -> T.StructType:
    return T.StructType(
        [T.StructField(fields.get(i, f"_c{i}"), T.StringType(), True) for i in range(width)]
    )


TICKET_SCHEMA = positional_schema(TICKET_FIELDS, TICKET_WIDTH)
SEGMENT_SCHEMA = positional_schema(SEGMENT_FIELDS, SEGMENT_WIDTH)


def _reader(spark: SparkSession, schema: T.StructType, multiline: bool):
    # escape='"' decodes doubled quotes inside quoted fields; each file's own
    # header line is skipped; rows with extra fields keep the first `width`.
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("multiLine", multiline)
    )


def read_tickets_csv(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool = False,
    year_from_file_name: bool = False,
) -> DataFrame:
    """Ticket rows with the named columns (all text).

    ``year_from_file_name`` keeps only rows whose issue year equals the year in
    the file name, the last stand-alone number 1900-2099 in it (one-file-per-year
    layouts that must not count a row filed under another year). A file without
    such a number stops the job rather than losing its rows.
    """
    df = _reader(spark, TICKET_SCHEMA, multiline).csv(path)
    if year_from_file_name:
        name = F.col("_metadata.file_name")
        found = F.regexp_extract(name, r"^.*(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])", 1)
        file_year = F.when(found != "", found).otherwise(
            F.raise_error(F.concat(F.lit("no year in file name "), name)))
        df = df.where(F.substring("issue_date", -4, 4) == file_year)
    return df.select(*TICKET_COLUMNS)


def read_segments_csv(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    return _reader(spark, SEGMENT_SCHEMA, multiline).csv(path).select(*SEGMENT_COLUMNS)


def read_tickets_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Curated tickets written by ``write_curated_tickets`` (partitioned by year)."""
    return spark.read.parquet(path)


# --------------------------------------------------------------------- sinks


def write_report_csv(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Comma-separated part files, no header."""
    report.write.mode(mode).option("header", False).csv(path)


def write_report_sorted(report: DataFrame, path: str, key: str = "segment_id", mode: str = "errorifexists") -> None:
    """Comma-separated part files in the order of ``key``: rows are dealt by ranges of it (sampled by Spark) and sorted
    in each range, so that the files read one after the other by name are sorted as a whole."""
    report.orderBy(key).write.mode(mode).option("header", False).csv(path)


def sorted_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """What ``write_report_sorted`` wrote, with ``position``: the row's place (from 1) over all part files by name. Each
    file's rows are numbered by themselves; only the files' row counts are added up."""
    rows = spark.read.schema(schema).option("header", False).csv(path)
    columns = rows.columns
    placed = rows.select(*columns, F.col("_metadata.file_name").alias("_file"),
                         F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    in_file = Window.partitionBy("_file").orderBy("_block", "_at")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).select(
        "_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return (placed.withColumn("_in_file", F.row_number().over(in_file)).join(F.broadcast(files), "_file")
            .select(*columns, (F.col("_before") + F.col("_in_file")).cast("bigint").alias("position")))


def write_tickets_csv(tickets: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Ticket columns at their positions in wide CSV files, each with a header."""
    _write_wide(tickets, TICKET_FIELDS, TICKET_WIDTH, path, mode)


def write_segments_csv(segments: DataFrame, path: str, mode: str = "errorifexists") -> None:
    _write_wide(segments, SEGMENT_FIELDS, SEGMENT_WIDTH, path, mode)


def _write_wide(df: DataFrame, fields: dict[int, str], width: int, path: str, mode: str) -> None:
    columns = [F.col(fields[i]) if i in fields else F.lit(None).cast("string").alias(f"_c{i}") for i in range(width)]
    df.select(*columns).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_report_text(report: DataFrame, path: str, separator: str = ", ", mode: str = "errorifexists") -> None:
    """One text line per row, fields joined by ``separator``."""
    line = F.concat_ws(separator, *[F.col(c).cast("string") for c in report.columns])
    report.select(line.alias("value")).write.mode(mode).text(path)


def write_report_parquet(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    report.write.mode(mode).parquet(path)


def count_sink(report: DataFrame) -> int:
    """The report's row count as the only output (an action)."""
    return report.count()


def write_curated_tickets(tickets: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Raw ticket columns as Parquet partitioned by an integer ``year``
    (the issue-date suffix; NULL when it is not a 4-digit number).

    Later reports over a subset of years then read only those partitions
    (partition pruning), and column pruning replaces re-parsing the CSV.
    There is deliberately no repartition by year: that would put a whole year
    into one task. Each task writes at most one file per year it holds, and
    ``maxRecordsPerFile`` bounds the file size.
    """
    suffix = F.substring(F.col("issue_date"), -4, 4)
    year = F.when(suffix.rlike(r"^[0-9]{4}\z"), suffix.cast("int")).alias("year")
    (tickets.select(*TICKET_COLUMNS, year).write.mode(mode).option("maxRecordsPerFile", 5_000_000)
     .partitionBy("year").parquet(path))
