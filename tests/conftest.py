import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from curbline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="curbline-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def tickets_df(spark, rows):
    """rows: (ticket_id, issue_date, county, house_number, street_name)"""
    return spark.createDataFrame(
        rows, "ticket_id string, issue_date string, county string, house_number string, street_name string")


def segments_df(spark, rows):
    """rows: (segment_id, l_low, l_high, r_low, r_high, street_label, boro_code, full_street, alt_label)"""
    return spark.createDataFrame(
        rows, "segment_id string, l_low string, l_high string, r_low string, r_high string, "
              "street_label string, boro_code string, full_street string, alt_label string")
