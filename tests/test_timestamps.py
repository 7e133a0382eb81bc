from datetime import datetime

import pytest

from archivolt.operators.timestamps import normalise_timestamps

CASES = [
    ("Sat, Aug 17, 2013 at 3:37 AM", "NY", "2013-08-17T07:37:00Z"),
    ("Sun, 04 Dec 2011 18:25:37 -0500 (EST)", "PAR", "2011-12-04T23:25:37Z"),
    ("D:20120614093332+03'00'", "NY", "2012-06-14T06:33:32Z"),
    ("1415176395", "NY", "2014-11-05T08:33:15Z"),
    ("1417941167965", "PAR", "2014-12-07T08:32:47Z"),
    ("20120211T215006Z", "NY", "2012-02-11T21:50:06Z"),
    ("2011-10-21T00:57:12.660548+02:00", "NY", "2011-10-20T22:57:12Z"),
    ("25/10/2015 03:08", "PAR", "2015-10-25T02:08:00Z"),
    ("6/14/2012 4:29 PM", "NY", "2012-06-14T20:29:00Z"),
    ("13-Nov-13 13.46", "PAR", "2013-11-13T12:46:00Z"),
    ("2015-12-01 02:55:48 Europe/London", "NY", "2015-12-01T02:55:48Z"),
    ("October I7, 2013 5:54 PM", "NY", "2013-10-17T21:54:00Z"),
    ("May 1, 2O11 6:54 AM", "NY", "2011-05-01T10:54:00Z"),
    ("December 18, 2013 5:lO AM", "NY", "2013-12-18T10:10:00Z"),
    ("March 20, 2014 2;02 PM", "NY", "2014-03-20T18:02:00Z"),
    ("27 décembre 2012 10:21", "PAR", "2012-12-27T09:21:00Z"),
    ("Mittwoch, 13. Februar 2008 10:52", "PAR", "2008-02-13T09:52:00Z"),
    ("30 Oct 2016 00:06 GMT+01:00", "NY", "2016-10-29T23:06:00Z"),
    ("Apr 13, 2009 6:27:14 PM BST", "NY", "2009-04-13T17:27:14Z"),
    ("2014-11-02 01:30:00", "NY", "2014-11-02T05:30:00Z"),  # repeated hour: the earlier instant
    ("2014-03-09 02:30:00", "NY", "2014-03-09T07:30:00Z"),  # skipped hour: the offset before the change
    ("2010-03-24", "NY", None), ("Friday", "NY", None), ("", "NY", None), (None, "NY", None), ("Sent from my handheld", "NY", None), ("x" * 100_000, "NY", None),
]


@pytest.fixture(scope="module")
def folders(spark):
    return spark.createDataFrame([("NY", "America/New_York", False), ("PAR", "Europe/Paris", True), ("UNK", None, True)], "folder string, home_zone string, day_first boolean")


def messages(spark, rows):
    return spark.createDataFrame(rows, "msg_id bigint, date_str string, folder string, subject string, ingested_at timestamp")


def test_notations(spark, folders):
    late = datetime(2019, 1, 1)
    rows = [(i, t, f, "s", late) for i, (t, f, _) in enumerate(CASES)]
    got = {r.msg_id: r.instant_utc for r in normalise_timestamps(messages(spark, rows + rows[:3]), folders).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(CASES)}


def test_zone_is_estimated_where_none_is_declared(spark, folders):
    # the answer must follow its question at 12:00 UTC: only New York's wall clock does
    rows = [(1, "Mon, 06 Jan 2014 12:00:00 +0000", "UNK", "boats", datetime(2014, 2, 1)), (2, "2014-01-06 08:30:00", "UNK", "Re: boats", datetime(2014, 1, 6, 13, 40))]
    got = {r.msg_id: r.instant_utc for r in normalise_timestamps(messages(spark, rows), folders).collect()}
    assert got[2] == "2014-01-06T13:30:00Z"


def test_empty(spark, folders):
    assert normalise_timestamps(messages(spark, []), folders).count() == 0


def test_written_zones_of_a_folder_decide_where_order_does_not(spark, folders):
    late = datetime(2019, 1, 1)
    rows = [(1, "Mon, 06 Jan 2014 12:00:00 -0500", "UNK", "a", late), (2, "Tue, 01 Jul 2014 12:00:00 -0400", "UNK", "b", late), (3, "Tue, 01 Jul 2014 12:00:00 +0200", "UNK", "c", late), (4, "2014-07-02 08:30:00", "UNK", "d", late)]
    got = {r.msg_id: (r.instant_utc, r.basis) for r in normalise_timestamps(messages(spark, rows), folders).collect()}
    assert got[4] == ("2014-07-02T12:30:00Z", "estimated") and got[1][1] == "offset"


def test_declared_zone_is_kept_and_its_violations_shown(spark, folders):
    from archivolt.operators.timestamps import zone_report

    rows = [(1, "Mon, 06 Jan 2014 12:00:00 +0000", "PAR", "boats", datetime(2014, 2, 1)), (2, "2014-01-06 08:30:00", "PAR", "Re: boats", datetime(2014, 1, 6, 13, 40))]
    got = next(r for r in zone_report(messages(spark, rows), folders).collect() if r.folder == "PAR")
    assert (got.zone, got.violations, got.best, got.best_violations, got.estimated) == ("Europe/Paris", 1, "America/New_York", 0, False)
