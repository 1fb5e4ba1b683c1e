"""CSV sources and sinks over files written by the test itself."""

import os
import tempfile

from curbline.plans.report import segment_report
from curbline.policy import preset
from curbline.sources.csv_io import (
    SEGMENT_FIELDS,
    SEGMENT_WIDTH,
    TICKET_FIELDS,
    TICKET_WIDTH,
    read_segments_csv,
    read_tickets_csv,
    write_report_csv,
    write_report_text,
)


def positional_line(fields: dict, width: int, values: dict) -> list:
    by_name = {v: k for k, v in fields.items()}
    row = [""] * width
    for name, value in values.items():
        row[by_name[name]] = value
    return row


def write_csv(path, header, rows, newline="\n"):
    def cell(v):
        if any(ch in v for ch in ',"\n'):
            return '"' + v.replace('"', '""') + '"'
        return v
    with open(path, "w") as f:
        f.write(",".join(header) + newline)
        for r in rows:
            f.write(",".join(cell(v) for v in r) + newline)


def ticket(tid, date, county, house, street):
    return positional_line(TICKET_FIELDS, TICKET_WIDTH, dict(ticket_id=tid, issue_date=date, county=county,
                                                             house_number=house, street_name=street))


def test_quoted_fields_and_headers_per_file(spark):
    d = tempfile.mkdtemp(prefix="curbline-csv-")
    header = [f"h{i}" for i in range(TICKET_WIDTH)]
    write_csv(os.path.join(d, "2015.csv"), header, [
        ticket("1", "06/14/2015", "NY", "125", 'BROADWAY, "THE"'),
        ticket("2", "06/14/2016", "NY", "127", "BROADWAY"),
    ])
    write_csv(os.path.join(d, "2016.csv"), header, [ticket("3", "01/02/2016", "K", "70-23", "MAIN")])
    df = read_tickets_csv(spark, d)
    rows = sorted(tuple(r) for r in df.collect())
    assert len(rows) == 3  # the second file's header is skipped too
    assert rows[0][4] == 'BROADWAY, "THE"'
    by_file = read_tickets_csv(spark, d, year_from_file_name=True).collect()
    assert sorted(r["ticket_id"] for r in by_file) == ["1", "3"]  # the 2016 row filed in 2015.csv is dropped


def test_multiline_field(spark):
    d = tempfile.mkdtemp(prefix="curbline-csv-")
    header = [f"h{i}" for i in range(TICKET_WIDTH)]
    write_csv(os.path.join(d, "t.csv"), header, [ticket("1", "06/14/2015", "NY", "125", "LINE\nBREAK")])
    rows = read_tickets_csv(spark, d, multiline=True).collect()
    assert len(rows) == 1 and rows[0]["street_name"] == "LINE\nBREAK"


def test_report_from_csv_and_sinks(spark):
    d = tempfile.mkdtemp(prefix="curbline-csv-")
    header = [f"h{i}" for i in range(TICKET_WIDTH)]
    write_csv(os.path.join(d, "t.csv"), header, [
        ticket("1", "06/14/2015", "NY", "125", "Broadway"),
        ticket("2", "06/14/2019", "MAN", "126", "broadway"),
        ticket("3", "06/14/2019", "ZZ", "126", "broadway"),
    ])
    seg = positional_line(SEGMENT_FIELDS, SEGMENT_WIDTH, dict(
        segment_id="10", l_low="101", l_high="199", r_low="100", r_high="198", street_label="BROADWAY",
        boro_code="1", full_street="BROADWAY", alt_label=""))
    seg2 = positional_line(SEGMENT_FIELDS, SEGMENT_WIDTH, dict(segment_id="11", boro_code="1"))
    sd = tempfile.mkdtemp(prefix="curbline-seg-")
    write_csv(os.path.join(sd, "s.csv"), [f"h{i}" for i in range(SEGMENT_WIDTH)], [seg, seg2])
    report = segment_report(read_tickets_csv(spark, d), read_segments_csv(spark, sd),
                            preset("canonical", order_by_id=True))
    rows = [tuple(r) for r in report.collect()]
    assert rows == [("10", 1, 0, 0, 0, 1, 0.0), ("11", 0, 0, 0, 0, 0, 0.0)]
    out = tempfile.mkdtemp(prefix="curbline-out-")
    write_report_text(report, os.path.join(out, "txt"))
    write_report_csv(report, os.path.join(out, "csv"))
    lines = sorted(spark.read.text(os.path.join(out, "txt")).collect())
    assert [r[0] for r in lines] == ["10, 1, 0, 0, 0, 1, 0.0", "11, 0, 0, 0, 0, 0, 0.0"]
    assert spark.read.csv(os.path.join(out, "csv")).count() == 2


def test_command_line(spark, capsys):
    from curbline.__main__ import main

    d = tempfile.mkdtemp(prefix="curbline-cli-")
    header = [f"h{i}" for i in range(TICKET_WIDTH)]
    write_csv(os.path.join(d, "t.csv"), header, [ticket("1", "06/14/2017", "BX", "41", "Elm St"),
                                                 ticket("2", "06/14/2018", "BX", "43", "ELM ST")])
    seg = positional_line(SEGMENT_FIELDS, SEGMENT_WIDTH, dict(
        segment_id="7", l_low="1", l_high="99", r_low="2", r_high="98", street_label="ELM ST",
        boro_code="2", full_street="ELM ST", alt_label=""))
    write_csv(os.path.join(d, "s.csv"), [f"h{i}" for i in range(SEGMENT_WIDTH)], [seg])
    tickets, segments = os.path.join(d, "t.csv"), os.path.join(d, "s.csv")
    assert main(["--tickets", tickets, "--segments", segments, "--format", "count"]) == 0
    assert capsys.readouterr().out.strip() == "1"
    out = os.path.join(d, "out")
    assert main(["--tickets", tickets, "--segments", segments, "--out", out, "--format", "text",
                 "--preset", "side_unpivot"]) == 0
    assert [r[0] for r in spark.read.text(out).collect()] == ["7, 0, 0, 1, 1, 0, 0.1"]  # (0*-2 + 0*-1 + 1*0 + 1*1 + 0*2) / 10


def test_curated_parquet_prunes_years(spark):
    from conftest import SF_SMALL
    from curbline.plans.queries import fixture_policy
    from curbline.sources.csv_io import read_tickets_parquet, write_curated_tickets
    from curbline.sources.fixtures import fixture_segments, fixture_tickets

    raw, segments = fixture_tickets(spark, SF_SMALL), fixture_segments(spark, SF_SMALL)
    path = os.path.join(tempfile.mkdtemp(prefix="curbline-curated-"), "tickets")
    write_curated_tickets(raw, path)
    curated = read_tickets_parquet(spark, path)
    pol = fixture_policy(years=(1996, 1997))
    report = segment_report(curated, segments, pol)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "IN (1996,1997)]" in plan.split("PartitionFilters: [", 1)[1].split("PushedFilters")[0]  # 2 folders read
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, segment_report(raw, segments, pol).collect()))


def test_command_line_years_and_file_year(spark, capsys):
    from curbline.__main__ import main

    d = tempfile.mkdtemp(prefix="curbline-cli-")
    header = [f"h{i}" for i in range(TICKET_WIDTH)]
    # 2016.csv holds a 2016 ticket and a stray 2015 one
    write_csv(os.path.join(d, "2016.csv"), header, [ticket("1", "03/01/2016", "Q", "12", "OAK AVE"),
                                                    ticket("2", "03/01/2015", "Q", "14", "OAK AVE")])
    seg = positional_line(SEGMENT_FIELDS, SEGMENT_WIDTH, dict(
        segment_id="9", l_low="1", l_high="99", r_low="2", r_high="98", street_label="OAK AVE",
        boro_code="4", full_street="OAK AVE", alt_label=""))
    write_csv(os.path.join(d, "s.csv"), [f"h{i}" for i in range(SEGMENT_WIDTH)], [seg])
    args = ["--tickets", os.path.join(d, "2016.csv"), "--segments", os.path.join(d, "s.csv")]
    out = os.path.join(d, "a")
    main(args + ["--years", "2015,2016", "--format", "text", "--out", out])
    assert [r[0] for r in spark.read.text(out).collect()] == ["9, 1, 1, 0.0"]  # equal counts: flat trend
    out = os.path.join(d, "b")
    main(args + ["--years", "2015,2016", "--year-from-file-name", "--format", "text", "--out", out])
    assert [r[0] for r in spark.read.text(out).collect()] == ["9, 0, 1, 1.0"]


def test_command_line_policy_overrides():
    import pytest as _pytest
    from curbline.__main__ import policy_overrides
    got = policy_overrides(["bin_width=50", "fold_case=false", "dedup=id_ticket", "skew_salt=4"])
    assert got == {"bin_width": 50, "fold_case": False, "dedup": "id_ticket", "skew_salt": 4}
    assert policy_overrides(["bin_width=none"]) == {"bin_width": None}
    with _pytest.raises(SystemExit):
        policy_overrides(["no_such_field=1"])
