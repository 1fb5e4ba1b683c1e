"""Counts that are kept per input file, so that a new or replaced file costs only its own rows.

Tickets come in files (one per year, month, ...). Each file's matches are counted once and stored as a small table of
(range, year, n) in a folder whose name tells everything the counts depend on: the file's path, length and time of
change, the policy, and a digest of the segment table. A run lists the files, counts those that have no finished folder
yet, and adds up the folders of the files that are there now. So a replaced file is counted anew, a removed one no longer
counts, other files are not read, and a run that was broken off goes on where it stopped (a folder counts only once Spark
has committed it, or it was moved there from a committed one). Files whose policy or segments changed are counted anew
as a whole.

A range is all that a match asks of a segment's side (borough, street, side, numbers). Sides of many segments may share
one, and then have the same matches: a file's tickets, summed per address, meet each range once, and its table has a row
for each range and year that matched. Only the sum over all files is handed out to the segments, by one join for each
report. So neither the matching nor the tables grow with the number of files times that of the segments on a range.

Deduplication by ticket looks across files and is refused. New files are counted together, up to ``TOGETHER`` in one Spark
job, since each job meets all segments; the sweep, which has no place for the file, takes them one by one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.operators.counting import explode_per_year, yearly_vector
from curbline.operators.matching import match_pairs
from curbline.operators.segments import range_name, segment_sides, segment_spine, side_ranges
from curbline.operators.tickets import normalize_tickets
from curbline.plans.report import side_counts, with_slope
from curbline.policy import MatchPolicy
from curbline.sources.csv_io import read_tickets_csv

#: New files counted by one job at most.
TOGETHER = 32

#: What is kept of a file.
KEPT = "range string, year int, n bigint"

# Bytes of a broadcast row besides its text (header and three fields), and the hash table's overhead.
_ROW_BYTES = 40
_HASH_FACTOR = 2


@dataclass(frozen=True)
class InputFile:
    path: str
    length: int
    changed: int

    def key(self, more: str) -> str:
        return hashlib.sha256(f"{self.path}\n{self.length}\n{self.changed}\n{more}".encode()).hexdigest()


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def input_files(spark: SparkSession, paths: str | Sequence[str]) -> list[InputFile]:
    """The files that the globs name, by path; hidden ones (``_``, ``.``) aside."""
    found = {}
    for pattern in [paths] if isinstance(paths, str) else paths:
        where, system = _file_system(spark, pattern)
        for status in system.globStatus(where) or []:
            name = status.getPath().getName()
            if status.isFile() and not name.startswith(("_", ".")):
                path = status.getPath().toString()
                found[path] = InputFile(path, status.getLen(), status.getModificationTime())
    return [found[p] for p in sorted(found)]


def table_digest(table: DataFrame) -> str:
    """A digest of a table's rows whatever their order; one row comes to the driver."""
    row = F.xxhash64(*[F.col(c) for c in sorted(table.columns)])
    r = table.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x")).first()
    return f"{r['n']}:{r['s']}:{r['x']}"


def _summed(policy: MatchPolicy) -> MatchPolicy:
    """The policy with the tickets summed per address before they meet the ranges, unless it forbids that."""
    return policy.with_(preaggregate="always") if policy.preaggregate == "auto" else policy


def _kept(counts: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    return (counts.groupBy(*more, F.col("segment_id").alias("range"), "year")
            .agg(F.sum("n").cast("bigint").alias("n")))


def _count_together(spark: SparkSession, files: Sequence[tuple[str, str]], ranges: DataFrame, policy: MatchPolicy,
                    state: str, read: Callable[[SparkSession, str], DataFrame]) -> None:
    """Counts several files (path, folder) in one job, each into its folder."""
    parts = [normalize_tickets(read(spark, path).withColumn("file", F.lit(k)), policy, more=["file"])
             for k, (path, _) in enumerate(files)]
    counts = _kept(match_pairs(reduce(DataFrame.unionByName, parts), ranges, _summed(policy), more=["file"]), ["file"])
    new, system = _file_system(spark, f"{state.rstrip('/')}/_new-{uuid.uuid4().hex}")
    counts.write.partitionBy("file").parquet(new.toString())
    for k, (_, folder) in enumerate(files):
        done, _ = _file_system(spark, folder)
        made, _ = _file_system(spark, f"{new.toString()}/file={k}")
        system.delete(done, True)
        # a file without matches has no counts
        moved = system.rename(made, done) if system.exists(made) else system.mkdirs(done)
        if not moved:
            raise RuntimeError(f"can't put the counts of {files[k][0]} into {folder}")
        system.create(_file_system(spark, f"{folder}/_SUCCESS")[0]).close()
    system.delete(new, True)


def _to_segments(kept: DataFrame, segments: DataFrame, policy: MatchPolicy) -> DataFrame:
    """(range, year, n) of all files -> (segment_id, year, n), rows to be summed: each side has its range's counts."""
    totals = kept.groupBy("range", "year").agg(F.sum("n").cast("bigint").alias("n"))
    row_bytes = (F.octet_length("range") + F.lit(_ROW_BYTES)) * F.lit(_HASH_FACTOR)
    size = totals.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("b")).first()["b"]
    totals = F.broadcast(totals) if size <= policy.broadcast_max_bytes else totals.hint("merge")
    sides = segment_sides(segments, policy).select("segment_id", range_name().alias("range"))
    return sides.join(totals, "range").select("segment_id", "year", "n")


@dataclass(frozen=True)
class Ledger:
    """What ``refresh`` found: what is kept of all present files, and the paths it had to read."""

    kept: DataFrame
    segments: DataFrame
    policy: MatchPolicy
    read: list[str]

    @cached_property
    def counts(self) -> DataFrame:
        """(segment_id, year, n), rows to be summed: the counts of all present files."""
        return _to_segments(self.kept, self.segments, self.policy)


def refresh(spark: SparkSession, paths: str | Sequence[str], segments: DataFrame, policy: MatchPolicy, state: str,
            read: Callable[[SparkSession, str], DataFrame] = read_tickets_csv) -> Ledger:
    """Counts what is new under ``paths`` into the folder ``state`` and returns the counts of everything there."""
    if policy.dedup != "none":
        raise ValueError("counts per file can't deduplicate tickets across files")
    basis = f"{policy!r}\n{table_digest(segments)}\n{KEPT}"
    folders, fresh = [], []
    for file in input_files(spark, paths):
        folder = f"{state.rstrip('/')}/{file.key(basis)}"
        folders.append(folder)
        done, system = _file_system(spark, f"{folder}/_SUCCESS")
        if not system.exists(done):
            fresh.append((file.path, folder))
    if fresh:
        # read several times by each job, so made once
        made, system = _file_system(spark, f"{state.rstrip('/')}/_ranges-{uuid.uuid4().hex}")
        side_ranges(segment_sides(segments, policy)).write.parquet(made.toString())
        ranges = spark.read.parquet(made.toString())
        together = 1 if policy.range_join == "sweep" else TOGETHER
        for k in range(0, len(fresh), together):
            if len(some := fresh[k:k + together]) == 1:
                path, folder = some[0]
                _kept(side_counts(read(spark, path), ranges, _summed(policy))).write.mode("overwrite").parquet(folder)
            else:
                _count_together(spark, some, ranges, policy, state, read)
        system.delete(made, True)
    fresh = [path for path, _ in fresh]
    kept = spark.read.schema(KEPT).parquet(*folders) if folders else spark.createDataFrame([], KEPT)
    return Ledger(kept, segments, policy, fresh)


def ledger_report(ledger: Ledger, segments: DataFrame, policy: MatchPolicy) -> DataFrame:
    """The segment report from the kept counts."""
    wide = yearly_vector(ledger.counts, segment_spine(segments, policy), policy.years)
    if policy.group == "per_id_year":
        wide = explode_per_year(wide, policy.years)
    report = with_slope(wide, policy)
    return report.orderBy("segment_id") if policy.order_by_id else report
