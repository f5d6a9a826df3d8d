import random
import zoneinfo
from datetime import datetime, timezone

import pytest
from siltworks.operators.instants import parse_instants, to_instants


def one(v, tz="UTC", day_first=False):
    return parse_instants([v], [tz], [day_first])[0]


@pytest.mark.parametrize(
    "value, want",
    [
        ("2015-03-01T04:05:06Z", "2015-03-01T04:05:06.000000Z"),
        ("2015-03-01t04:05:06.1234567z", "2015-03-01T04:05:06.123456Z"),
        ("2015-03-01T04:05:06,5+05:45", "2015-02-28T22:20:06.500000Z"),
        ("2015-03-01T04:05:06-0330", "2015-03-01T07:35:06.000000Z"),
        ("2015-03-01T04:05:06+01", "2015-03-01T03:05:06.000000Z"),
        ("20150301T040506Z", "2015-03-01T04:05:06.000000Z"),
        ("2015-060T00:00:00Z", "2015-03-01T00:00:00.000000Z"),
        ("Fri, 01 Aug 2014 15:03:36 +0530", "2014-08-01T09:33:36.000000Z"),
        ("Fri, 1 Aug 2014 15:03:36 EST", "2014-08-01T20:03:36.000000Z"),
        ("April 10, 2010 3:24 PM", "2010-04-10T15:24:00.000000Z"),
        ("01/02/2010 12:05 AM", "2010-01-02T00:05:00.000000Z"),
        ("18.12.2019 20:07", "2019-12-18T20:07:00.000000Z"),
        ("2009-01-08 10:22:59 Europe/Berlin", "2009-01-08T09:22:59.000000Z"),
        ("01-AUG-2012", "2012-08-01T00:00:00.000000Z"),
        ("1 Dec 2013", "2013-12-01T00:00:00.000000Z"),
        ("2012", "2012-01-01T00:00:00.000000Z"),
        ("201203", "2012-03-01T00:00:00.000000Z"),
        ("20120304", "2012-03-04T00:00:00.000000Z"),
        ("2012-03", "2012-03-01T00:00:00.000000Z"),
        ("1233308289", "2009-01-30T09:38:09.000000Z"),
        ("1231845762978", "2009-01-13T11:22:42.978000Z"),
        ("2018-02-12T24:00:00Z", "2018-02-13T00:00:00.000000Z"),
        (" \t2012-03-04\xa0", "2012-03-04T00:00:00.000000Z"),
        ("2013-13-01", None), ("2014-02-30", None), ("20110631", None), ("00000000", None), ("2012-10-05T25:10:00Z", None), ("199", None), ("ongoing", None), ("n/a", None), ("-", None), ("", None), (None, None), ("9" * 5000, None), ("May be later", None), ("13/13/2013", None),
    ],
)
def test_forms(value, want):
    assert one(value) == want


def test_order_of_days():
    assert one("03/04/2015", day_first=True) == "2015-04-03T00:00:00.000000Z"
    assert one("03/04/2015") == "2015-03-04T00:00:00.000000Z"
    assert one("25/12/2015") is None


def test_repeated_and_skipped_times():
    assert one("2015-11-01 01:30:00", "America/New_York") == "2015-11-01T05:30:00.000000Z"
    assert one("2015-03-08 02:30:00", "America/New_York") == "2015-03-08T07:30:00.000000Z"


def test_like_zoneinfo():
    rng = random.Random(4)
    for z in ("Europe/Berlin", "America/St_Johns", "Asia/Kathmandu", "Africa/Casablanca", "Australia/Sydney", "UTC"):
        zone = zoneinfo.ZoneInfo(z)
        for _ in range(300):
            d = datetime(rng.randint(1950, 2100), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23), rng.randint(0, 59))
            assert one(d.isoformat(), z) == d.replace(tzinfo=zone).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000000Z")


def test_rows(spark):
    df = spark.createDataFrame([("f", 1, "2015-01-01", None, None, "x"), ("f", 2, None, "UTC", True, "x"), ("g", 1, "2015-01-01", "Asia/Tokyo", False, "x")], "field_name string, row_id bigint, value string, tz string, day_first boolean, utc string")
    got = {(r.field_name, r.row_id): r.utc for r in to_instants(df).collect()}
    assert got == {("f", 1): "2015-01-01T00:00:00.000000Z", ("f", 2): None, ("g", 1): "2014-12-31T15:00:00.000000Z"}
    assert to_instants(df.limit(0)).count() == 0


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/New_York", "Africa/Casablanca", "Australia/Sydney", "Asia/Gaza", "Asia/Kolkata"])
def test_rules_hold_for_ever(zone):
    """Like the zone database itself, in years that no table lists."""
    at = zoneinfo.ZoneInfo(zone)
    for year in (2119, 2125, 2200, 2399, 2400, 9998):
        for month, day in ((1, 1), (3, 28), (3, 31), (7, 1), (10, 30), (11, 2), (12, 31)):
            want = datetime(year, month, day, 12, tzinfo=at).astimezone(timezone.utc)
            assert one(f"{year}-{month:02d}-{day:02d}T12:00:00", zone) == want.strftime("%Y-%m-%dT%H:%M:%S.000000Z")


def test_last_year():
    assert one("9999-07-01T12:00:00", "Europe/Berlin") == "9999-07-01T10:00:00.000000Z"
    assert one("9999-12-31T23:00:00", "America/New_York") is None
