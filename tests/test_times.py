import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import parse_any
from tidemark.spec import TIME_FORMATS


def one_by_one(text, formats):
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def texts():
    rng = random.Random(7)
    fixed = [
        "2026-05-12T10:00:00Z", "2026-05-12T10:00:00.1Z", "2026-05-12T10:00:00.123Z",
        "2026-05-12T10:00:00.1234Z", "2026-05-12T10:00:00.123", "2026-05-12T10:00:00",
        "2026-05-12 10:00:00", "2026-05-12", "2026-05-12t10:00:00z", "2026-05-12T10:00:00+07",
        "2026-05-12T10:00:00+0730", "2026-05-12T10:00:00+07:00", "2026-05-12T10:00:00.5-03",
        "2026-05-12 10:00:00Z", "2026-05-12 10:00:00.123", "2026-02-30", "2026-02-29", "2024-02-29",
        "2026-13-01", "2026-00-10", "0000-01-01", "0001-01-01", "9999-12-31T23:59:59.999Z",
        "+12026-01-01", "12026-01-01", "-0005-01-01", "1582-10-10", "2026-05-12T24:00:00Z",
        "2026-05-12T23:60:00Z", "2026-05-12T23:59:60Z", "2026-5-1", "2026-05-12T", " 2026-05-12",
        "2026-05-12\n", "2026-05-12T10:00:00Z\n", "2026-05-12T1:00:00Z", "2026/05/12", "", "T", "now",
        "epoch", "today", "2026", "2026-05", "not-a-date", "10:00:00", "2026-05-12T10:00",
        "1970-01-01T00:00:00.000Z", "1900-01-01T00:00:00Z", "٢٠٢٦-٠٥-١٢",
    ]
    made = []
    for _ in range(4000):
        text = f"{rng.randint(0, 9999):04d}-{rng.randint(0, 14):02d}-{rng.randint(0, 33):02d}"
        if rng.random() < 0.8:
            text += rng.choice("T Tt") + ":".join(f"{rng.randint(0, 62):02d}" if rng.random() < 0.05
                                                  else f"{rng.randint(0, 24):02d}" for _ in range(3))
            if rng.random() < 0.4:
                text += "." + "".join(rng.choice("0123456789") for _ in range(rng.randint(0, 5)))
            text += rng.choice(["Z", "z", "", "+07", "-0330", "+07:00", "+7", "UTC"])
        if rng.random() < 0.1:
            spot = rng.randrange(len(text))
            text = text[:spot] + rng.choice("0T:-. x+") + text[spot + 1:]
        made.append(text)
    return fixed + made


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh", "America/New_York"])
def test_shortcuts_never_change_what_a_format_reads(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts()], "text string").repartition(8)
        text = F.col("text")
        got, want = parse_any(text, TIME_FORMATS), one_by_one(text, TIME_FORMATS)
        seen = df.select("text", got.cast("string").alias("got"), want.cast("string").alias("want"))
        assert seen.filter(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
        assert seen.filter("want IS NOT NULL").count() > 500
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_formats_with_unusual_parts_still_work(spark):
    df = spark.createDataFrame([("12 May 2026",), ("2026-05-12",), ("x",)], "text string")
    got = df.select(parse_any(F.col("text"), ("dd MMM yyyy", "yyyy-MM-dd")).cast("string")).collect()
    assert [r[0] for r in got] == ["2026-05-12 00:00:00", "2026-05-12 00:00:00", None]
