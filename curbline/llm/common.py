"""Shared helpers of the corpus operators: table reading, scratch tables, stable folds and bounded driver reads."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    Where the setting is absent a private folder is made for a local session; on a cluster that is an error,
    because a machine-local folder would be invisible to the other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="curbline-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's setting that deletes what a query has shuffled when the query ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return the table: later reads don't depend on the
    executors that made it, and its lineage ends there. ``tidy``: what the write shuffled is deleted when it ends (no
    other query may share its exchanges)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(TIDY)
    spark.conf.set(TIDY, "true" if tidy else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discarded(table: DataFrame) -> None:
    """Deletes what ``stored`` has written for ``table``, when nothing reads it any more."""
    spark = table.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold that no model may learn from: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def salt_of(column: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


_shipped: set[str] = set()  # applications whose workers have this package


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that they needn't have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="curbline-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def arrow_map(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts in ``column`` have about ``most_bytes`` together; a longer text is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
