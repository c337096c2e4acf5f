from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import cleaning as c
from millrace.plans.incidents import PERSONAL, clean_incidents, closed_case_report
from tests.conftest import rows


def column(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", build("x").alias("y")).orderBy("i").collect()]


def test_dates_are_read_month_first_and_strictly(spark):
    got = column(
        spark,
        ["2024-03-04 10:11:12", "03-04-2024", "25-12-2023", "03/04/2024 10:00", "3/4/20 10:00", "13-13-2024", "02-30-2024", "N/A", "", None],
        "string",
        c.parse_timestamp,
    )
    assert got == [
        dt.datetime(2024, 3, 4, 10, 11, 12), dt.datetime(2024, 3, 4), dt.datetime(2023, 12, 25), dt.datetime(2024, 3, 4, 10),
        None, None, None, None, None, None,
    ]


def test_the_shape_check_never_hides_a_date(spark):
    """Guarded and plain parsing agree on every pair of two-digit fields and on odd years."""
    texts = [f"{a:02d}-{b:02d}-{y}" for a in range(0, 33) for b in range(0, 33) for y in ("2024", "0001", "+12024")]
    texts += [f"2024-02-{d:02d} {h:02d}:59:{s:02d}" for d in range(27, 33) for h in (0, 23, 24) for s in (0, 59, 60)]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    plain = F.coalesce(*[F.try_to_timestamp("x", F.lit(f)) for f in c.DATE_FORMATS])
    assert df.filter(~plain.eqNullSafe(c.parse_timestamp("x"))).count() == 0
    assert c.shape_of("yyyy-MM-dd'T'HH:mm") == ".*"


def test_numbers(spark):
    assert column(spark, ["46792.6.0", "46792.6", "-5.0", "12", "abc", "", None], "string", c.repair_number) == [46792.6, 46792.6, -5.0, 12.0, None, None, None]
    assert column(spark, [-1, 0, 5, None], "int", lambda x: c.non_negative(x, 0)) == [None, 0, 5, 0]
    assert column(spark, [-1, 0, None], "int", c.review_flag) == ["NEEDS_REVIEW", None, None]
    assert column(spark, [-1, 0, 120, 121, None], "int", lambda x: c.in_range(x, 0, 120)) == [None, 0, 120, None, None]
    assert column(spark, [17, 18, 29, 30, 59, 60, None], "int", c.band) == ["Minor", "Young Adult", "Young Adult", "Adult", "Adult", "Senior", "Unknown"]
    assert column(spark, [1, 5, 9], "int", lambda x: c.optional_range(x, None, 5)) == [True, True, False]


def test_words(spark):
    assert column(spark, [" TRUE ", "yes", "1", "No", "0", "maybe", None], "string", c.parse_boolean) == [True, True, True, False, False, None, None]
    status = column(spark, ["pendng", " CLOSED", "investgation", "reopened", None], "string", lambda x: c.standardise(x, c.CASE_STATUS, "Unknown"))
    assert status == ["Pending", "Closed", "Under Investigation", "Unknown", "Unknown"]
    resolution = column(spark, ["arres made", "dismissed", "warning", "N/A"], "string", lambda x: c.standardise(x, c.RESOLUTION, "Unknown"))
    assert resolution == ["Arrest Made", "Case Dismissed", "Warning Issued", "Unknown"]
    assert column(spark, ["m", "Female ", "other", "N/A", None], "string", c.standardise_gender) == ["Male", "Female", "Other", None, None]


def test_whole_record(spark):
    names = "incident_id incident_datetime reported_online num_arrests property_loss_usd case_status resolution suspect_age victim_age suspect_gender victim_gender officer_id notes".split()
    data = [
        ("i1", "03-04-2024", "yes", 2, "46792.6.0", "closed", "arres made", 17, 130, "f", "m", "o", "n"),
        ("i1", "03-04-2024", "yes", 2, "46792.6.0", "closed", "arres made", 17, 130, "f", "m", "o", "n"),
        ("i2", "bad", "?", -1, "-3.5", "CLOSED", None, -4, 61, "x", None, "o", "n"),
        ("i3", None, None, 1, None, "Closed", "arrest made", None, None, "F", None, "o", "n"),
    ]
    kinds = ["string", "string", "string", "int", "string", "string", "string", "int", "int", "string", "string", "string", "string"]
    raw = spark.createDataFrame(data, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    clean = clean_incidents(raw)
    assert clean.count() == 3
    assert not set(PERSONAL) & set(clean.columns)
    bad = clean.filter("incident_id = 'i2'").first()
    assert (bad.num_arrests, bad.num_arrests_flag, bad.property_loss_usd, bad.property_loss_usd_flag) == (None, "NEEDS_REVIEW", None, "NEEDS_REVIEW")
    assert (bad.suspect_age_group, bad.victim_age_group, bad.resolution) == ("Unknown", "Senior", "Unknown")
    report = [(r.suspect_gender, r.resolution, r.incident_count, float(r.avg_property_loss_usd)) for r in closed_case_report(clean).collect()]
    assert report == [("Female", "Arrest Made", 2, 46792.6)]
