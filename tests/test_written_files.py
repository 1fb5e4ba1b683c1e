"""Files that a query writes grow in number with the tickets, not in size."""

from conftest import SF_SMALL
from curbline.plans import queries


def test_ticket_files_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_TICKETS", 500)
    written = []
    plain = queries.write_tickets_csv
    monkeypatch.setattr(queries, "write_tickets_csv", lambda t, path: written.append(path) or plain(t, path))
    queries.QUERIES["report_from_files"](spark, SF_SMALL)
    sizes = [len(f[1].splitlines()) - 1 for f in spark.sparkContext.wholeTextFiles(f"{written[0]}/*.csv").collect()]
    assert len(sizes) >= 12 and max(sizes) < 1_000
