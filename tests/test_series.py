import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelflog.operators.dedup import latest_per_key
from shelflog.operators.series import with_neighbour
from shelflog.plans import intermediate, reports

KEYS = ["source", "retailer_product_id"]
SCHEMA = (
    "event_id string, source string, retailer_product_id string, "
    "observed_at timestamp_ntz, inventory_status string, price decimal(12,2)"
)


def history(spark, seed, rows=400):
    """One product holds most rows; times repeat, some are missing."""
    pick = random.Random(seed)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(rows):
        product = pick.choice(["hot", "hot", "hot", "b", "c", None])
        moment = start + timedelta(seconds=pick.choice([0, 30, 59, 60, 61, 3600, 86400 * 3]) * pick.randint(0, 4))
        data.append(
            (
                f"{i:05d}",
                "TARGET",
                product,
                None if pick.random() < 0.05 else moment,
                pick.choice(["IN_STOCK", "OUT_OF_STOCK", "UNKNOWN"]),
                None,
            )
        )
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_sliced_lookup_equals_plain_window(spark, seed, following):
    df = history(spark, seed)
    order = (
        [F.col("observed_at").desc_nulls_first(), F.col("event_id").desc()]
        if following
        else [F.col("observed_at").asc_nulls_last(), F.col("event_id").asc()]
    )
    plain = df.withColumns(
        {
            "other": F.lag("inventory_status").over(Window.partitionBy(*KEYS).orderBy(*order)),
            "when": F.lag("observed_at").over(Window.partitionBy(*KEYS).orderBy(*order)),
        }
    )
    for hot_rows in (0, 50, 10**6):
        sliced = with_neighbour(
            df, KEYS, "observed_at", "event_id",
            {"other": "inventory_status", "when": "observed_at"},
            following=following, hot_rows=hot_rows,
        ).select(plain.columns)
        assert sliced.exceptAll(plain).count() == 0
        assert sliced.count() == plain.count()


def test_hot_series_is_cut_into_slices(spark):
    df = history(spark, 3)
    plan = with_neighbour(
        df, KEYS, "observed_at", "event_id", {"other": "inventory_status"}, hot_rows=10
    )._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(source" in plan and "_slice" in plan


def test_three_valued_stock_out(spark):
    rows = [
        ("1", "TARGET", "a", datetime(2024, 1, 1), "OUT_OF_STOCK", None),
        ("2", "TARGET", "b", datetime(2024, 1, 1), "IN_STOCK", None),
        ("3", "TARGET", "b", datetime(2024, 1, 2), "OUT_OF_STOCK", None),
        ("4", "TARGET", "b", datetime(2024, 1, 3), "IN_STOCK", None),
    ]
    got = {r["event_id"]: r for r in intermediate.state_changes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["1"]["went_out_of_stock"] is None and got["1"]["status_changed"] is False
    assert got["2"]["went_out_of_stock"] is False
    assert got["3"]["went_out_of_stock"] is True and got["3"]["hours_since_previous_observation"] == 24
    assert got["4"]["restocked"] is True


def test_price_changes_skip_unpriced_rows(spark):
    from decimal import Decimal as D

    rows = [
        ("1", "T", "a", datetime(2024, 1, 1), "IN_STOCK", D("0.00")),
        ("2", "T", "a", datetime(2024, 1, 2), "IN_STOCK", None),
        ("3", "T", "a", datetime(2024, 1, 3), "IN_STOCK", D("8.00")),
        ("4", "T", "a", datetime(2024, 1, 4), "IN_STOCK", D("8.01")),
        ("5", "T", "a", datetime(2024, 1, 5), "IN_STOCK", D("8.01")),
    ]
    got = {r["event_id"]: r for r in intermediate.price_changes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert "2" not in got
    assert got["3"]["previous_price"] == D("0.00") and got["3"]["pct_change"] is None
    assert got["4"]["pct_change"] == 0.13 and got["4"]["price_changed"]
    assert got["5"]["price_changed"] is False and got["5"]["pct_change"] == 0.0


def test_latest_copy_wins_with_tie_breaks(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 9, "m")]
    df = spark.createDataFrame(rows, "id string, loaded int, run string")
    got = {r["id"]: r["run"] for r in latest_per_key(df, "id", ["loaded", "run"]).collect()}
    assert got == {"a": "z", "b": "n"}


def test_copies_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as id", "id as loaded")
    plan = latest_per_key(df, "id", ["loaded"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_daily_rollup_equals_the_two_step_form(spark):
    df = history(spark, 5).where("observed_at is not null").withColumn(
        "price", F.expr("cast(cast(event_id as int) % 7 as decimal(12,2))")
    )
    day = F.to_date("observed_at").alias("observation_date")
    place = F.array_position(F.array(*[F.lit(s or "") for s in intermediate.STATUS_ORDER]), F.col("inventory_status"))
    rank = F.row_number().over(
        Window.partitionBy(*KEYS, F.to_date("observed_at")).orderBy(F.col("observed_at").desc(), place.desc())
    )
    last = df.withColumn("n", rank).where("n = 1").select(*KEYS, day, F.col("inventory_status").alias("last_status"))
    twin = df.groupBy(*KEYS, day).agg(F.count("*").alias("observation_count"))
    cond = [F.col(f"t.{c}").eqNullSafe(F.col(f"l.{c}")) for c in (*KEYS, "observation_date")]
    want = twin.alias("t").join(last.alias("l"), cond).select("t.*", "l.last_status")
    got = intermediate.daily_inventory(df).select(want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    assert "SortAggregate" not in intermediate.daily_inventory(df)._jdf.queryExecution().executedPlan().toString()


def test_outage_runs_to_the_next_restock(spark):
    def at(hour):
        return datetime(2024, 1, 1, hour)

    moves = [
        ("1", "k", "T", "a", at(1), "OUT_OF_STOCK"),
        ("2", "k", "T", "a", at(2), "PREORDER"),
        ("3", "k", "T", "a", at(3), "OUT_OF_STOCK"),
        ("4", "k", "T", "a", at(5), "IN_STOCK"),
        ("5", "k", "T", "a", at(7), "OUT_OF_STOCK"),
    ]
    df = spark.createDataFrame(
        moves,
        "state_change_event_id string, product_key string, source string, "
        "retailer_product_id string, observed_at timestamp_ntz, current_status string",
    )
    for hot_rows in (0, 10**6):
        got = sorted(tuple(r) for r in reports.outages(df, hot_rows=hot_rows).select(
            "outage_start", "outage_end", "outage_seconds").collect())
        assert got == [(at(1), at(5), 4 * 3600), (at(7), None, None)]
