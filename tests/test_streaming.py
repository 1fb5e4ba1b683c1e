"""Incremental counts over ticket files that arrive in several micro-batches."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from curbline.plans.queries import fixture_policy
from curbline.plans.report import segment_counts, segment_report
from curbline.sources.fixtures import fixture_segments, fixture_tickets
from curbline.streaming.incremental import (
    read_tickets_stream_parquet,
    report_from_counts,
    latest_counts,
    start_segment_counts,
)


def test_stream_equals_batch(spark):
    pol = fixture_policy()
    tickets, segments = fixture_tickets(spark, SF_SMALL), fixture_segments(spark, SF_SMALL)
    # three arrival files in one folder: the tickets split by a hash of their id
    folder = os.path.join(tempfile.mkdtemp(prefix="curbline-stream-in-"), "tickets")
    bucket = F.abs(F.hash("ticket_id")) % 3
    for b in range(3):
        tickets.where(bucket == b).coalesce(1).write.mode("append").parquet(folder)

    stream = read_tickets_stream_parquet(spark, folder, tickets.schema, max_files_per_trigger=1)
    q = start_segment_counts(stream, segments, pol, query_name="counts_test", in_memory=True,
                             checkpoint=tempfile.mkdtemp(prefix="curbline-ckpt-"))
    try:
        q.processAllAvailable()
        assert len(q.recentProgress) >= 3  # one micro-batch per arrival file
        got = spark.table("counts_test")
        want = segment_counts(tickets, segments, pol).groupBy("segment_id", "year").agg(
            F.sum("n").cast("bigint").alias("n"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        rep = report_from_counts(got, segments, pol)
        assert sorted(map(tuple, rep.collect())) == sorted(map(tuple, segment_report(tickets, segments, pol).collect()))
    finally:
        q.stop()


def test_stream_snapshot_sink(spark):
    pol = fixture_policy()
    tickets, segments = fixture_tickets(spark, SF_SMALL), fixture_segments(spark, SF_SMALL)
    folder = tempfile.mkdtemp(prefix="curbline-stream-in-")
    tickets.write.mode("overwrite").parquet(os.path.join(folder, "day1"))
    stream = read_tickets_stream_parquet(spark, os.path.join(folder, "day1"), tickets.schema)
    out = tempfile.mkdtemp(prefix="curbline-stream-out-")
    q = start_segment_counts(stream, segments, pol, output_path=os.path.join(out, "counts"),
                             query_name="snapshot_test", checkpoint=tempfile.mkdtemp(prefix="curbline-ckpt-"),
                             trigger_once=True)
    q.awaitTermination(300)
    snap = latest_counts(spark, os.path.join(out, "counts"))
    assert snap.agg(F.sum("n")).first()[0] == segment_counts(tickets, segments, pol).agg(F.sum("n")).first()[0]


def test_stream_resumes_from_checkpoint(spark):
    """A stopped query restarted on the same checkpoint continues its counts
    (offsets and aggregation state survive the restart)."""
    pol = fixture_policy()
    tickets, segments = fixture_tickets(spark, SF_SMALL), fixture_segments(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="curbline-stream-resume-")
    folder, ckpt = os.path.join(base, "in"), os.path.join(base, "ckpt")
    half = F.abs(F.hash("ticket_id")) % 2
    tickets.where(half == 0).coalesce(1).write.mode("append").parquet(folder)

    q = start_segment_counts(read_tickets_stream_parquet(spark, folder, tickets.schema), segments, pol,
                             query_name="resume_a", in_memory=True, checkpoint=ckpt)
    q.processAllAvailable()
    q.stop()

    tickets.where(half == 1).coalesce(1).write.mode("append").parquet(folder)
    q = start_segment_counts(read_tickets_stream_parquet(spark, folder, tickets.schema), segments, pol,
                             query_name="resume_b", in_memory=True, checkpoint=ckpt)
    try:
        q.processAllAvailable()
        got = spark.table("resume_b").agg(F.sum("n")).first()[0]
        want = segment_counts(tickets, segments, pol).agg(F.sum("n")).first()[0]
        assert got == want  # both halves, each counted once
    finally:
        q.stop()


def test_stream_from_csv_files(spark):
    """CSV ticket files with headers arriving in a folder, counted incrementally."""
    from curbline.sources.csv_io import TICKET_WIDTH
    from curbline.streaming.incremental import read_tickets_stream_csv
    from test_csv import ticket, write_csv
    from conftest import segments_df
    from curbline.policy import preset

    folder = os.path.join(tempfile.mkdtemp(prefix="curbline-stream-csv-"), "in")
    os.makedirs(folder)
    header = [f"h{i}" for i in range(TICKET_WIDTH)]
    write_csv(os.path.join(folder, "day1.csv"), header, [ticket("1", "06/14/2015", "NY", "125", "MAIN ST"),
                                                         ticket("2", "06/15/2015", "NY", "126", "MAIN ST")])
    write_csv(os.path.join(folder, "day2.csv"), header, [ticket("3", "01/02/2016", "MN", "125", "Main St"),
                                                         ticket("4", "01/02/2016", "ZZ", "125", "MAIN ST")])
    segments = segments_df(spark, [("S1", "101", "199", "100", "198", "MAIN ST", "1", "MAIN ST", "")])
    q = start_segment_counts(read_tickets_stream_csv(spark, folder, max_files_per_trigger=1), segments,
                             preset("canonical"), query_name="csv_stream", in_memory=True,
                             checkpoint=tempfile.mkdtemp(prefix="curbline-ckpt-"))
    try:
        q.processAllAvailable()
        assert sorted(map(tuple, spark.table("csv_stream").collect())) == [("S1", 2015, 2), ("S1", 2016, 1)]
    finally:
        q.stop()


def test_checkpoint_folder_follows_the_session(spark):
    """The shared folder named by spark.checkpoint.dir is used as is (a core
    setting: it cannot be changed on a running session, and is not)."""
    from curbline.session import checkpoint_path, ensure_checkpoint_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    if configured:
        assert got == configured
    else:
        assert got and spark.sparkContext.getCheckpointDir()
    assert checkpoint_path(spark, "stream-x") == os.path.join(got, "stream-x")


def test_stream_refuses_ticket_dedup(spark):
    """Dedup by ticket id would need state that grows with every ticket."""
    import pytest as _pytest
    from curbline.streaming.incremental import stream_segment_counts
    pol = fixture_policy("row_predicate")
    tickets, segments = fixture_tickets(spark, SF_SMALL), fixture_segments(spark, SF_SMALL)
    stream = read_tickets_stream_parquet(spark, tempfile.mkdtemp(prefix="curbline-empty-"), tickets.schema)
    with _pytest.raises(ValueError, match="dedup"):
        stream_segment_counts(stream, segments, pol)
