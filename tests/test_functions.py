import uuid
from datetime import datetime

from pyspark.sql import functions as F

from shelflog import functions as fn
from shelflog.plans import marts

NAMESPACE = uuid.UUID("6f8f2c2e-9b1d-4b1a-9b3a-1f7d9e6a0c11")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_event_id_is_a_name_based_uuid(spark):
    rows = [
        ("TARGET", "89345261", datetime(2026, 1, 1, 12)),
        ("WALMART", "ünï", datetime(2026, 1, 1, 12, 0, 0, 120)),
        ("GAMESTOP", "7", datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ]
    df = spark.createDataFrame(rows, "s string, p string, t timestamp_ntz")
    got = [r[0] for r in df.select(fn.event_id(F.col("s"), F.col("p"), F.col("t"))).collect()]
    want = [str(uuid.uuid5(NAMESPACE, f"{s}:{p}:{t.isoformat()}+00:00")) for s, p, t in rows]
    assert got == want
    assert len(set(got)) == 3


def test_differences_count_boundaries(spark):
    early, late = ntz("2024-01-01 00:59:59.9"), ntz("2024-01-01 01:01:00")
    assert one(spark, fn.hours_between(early, late)) == 1
    assert one(spark, fn.seconds_between(early, ntz("2024-01-01 01:00:00.1"))) == 1
    assert one(spark, fn.hours_between(late, early)) == -1


def test_offsets_are_applied(spark):
    def read(text):
        return one(spark, fn.utc_text(fn.read_utc(F.lit(text))))

    assert read("2026-08-06T05:00:00-07:00") == "2026-08-06 12:00:00.000000"
    assert read("2026-01-01 12:00:00") == "2026-01-01 12:00:00.000000"
    assert read("2026-01-01T12:00:00.25Z") == "2026-01-01 12:00:00.250000"
    assert read("soon") is None


def test_codes(spark):
    assert one(spark, fn.code_or_default(F.lit("  "), "USD")) == "USD"
    assert one(spark, fn.code_or_default(F.lit(None).cast("string"), "USD")) == "USD"
    assert one(spark, fn.code_or_default(F.lit(" eur "), "USD")) == "EUR"
    assert one(spark, fn.one_of(F.lit(" backorder"), ["BACKORDER"])) == "BACKORDER"
    assert one(spark, fn.one_of(F.lit(None).cast("string"), ["BACKORDER"])) == "UNKNOWN"


def test_surrogate_key_names_nulls(spark):
    nothing = F.lit(None).cast("string")
    keys = [
        one(spark, fn.surrogate_key(a, b))
        for a, b in [(F.lit("a"), nothing), (nothing, F.lit("a")), (F.lit("a"), F.lit(""))]
    ]
    assert len(set(keys)) == 3
    assert one(spark, fn.surrogate_key(F.lit("a"), F.lit("b"))) == one(spark, F.md5(F.lit("a-b")))


def test_payload_hash_ignores_key_order(spark):
    texts = ['{"a": 1, "b": {"c": 2, "d": [1, 2]}}', '{"b":{"d":[1,2],"c":2},"a":1}']
    a, b = (one(spark, fn.payload_hash(F.parse_json(F.lit(t)))) for t in texts)
    assert a == b
    assert a != one(spark, fn.payload_hash(F.parse_json(F.lit('{"a": 2}'))))


def test_calendar(spark):
    days = {r["date_day"].isoformat(): r for r in marts.dim_date(spark, datetime(2024, 2, 1)).collect()}
    assert len(days) == 397 and max(days) == "2025-01-31" and min(days) == "2024-01-01"
    sunday = days["2024-01-07"]
    assert (sunday["day_of_week"], sunday["is_weekend"], sunday["day_name"]) == (0, True, "Sun")
    late = days["2024-12-30"]
    assert (late["year"], late["week_of_year"], late["date_key"]) == (2024, 1, 20241230)


def test_leap_day_clock(spark):
    days = marts.dim_date(spark, datetime(2024, 2, 29))
    assert days.agg(F.max("date_day")).first()[0].isoformat() == "2025-02-27"
