"""The incremental refresh against a full build, over random late batches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelflog.operators import staging
from shelflog.operators.merge import only_days
from shelflog.plans import intermediate, marts
from shelflog.plans.incremental import LAST, TOUCHED, Warehouse, next_or_previous, touched_days
from shelflog.plans.load import DAY, OBSERVATIONS
from shelflog.schemas import INGESTION_RUNS, INVENTORY_EVENTS, PRODUCT_SEED, RETAILER_SEED

AS_OF = datetime(2024, 3, 1)


def rows_of(spark, rows):
    """rows: (event_id, product, observed_at, loaded_at, price, status)."""
    base = spark.createDataFrame(
        rows, "event_id string, retailer_product_id string, observed_at timestamp_ntz, loaded_at timestamp_ntz, amount int, inventory_status string"
    ).withColumns(
        {"price": F.col("amount").cast("decimal(12,2)"), "source": F.lit("target"), "extracted_at": F.col("observed_at"), "ingestion_run_id": F.lit("r")}
    )
    return staging.stage_events(
        base.select(*[F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in INVENTORY_EVENTS])
    )


@pytest.fixture(scope="module")
def seeds(spark):
    products = spark.createDataFrame([(f"id{p}", "TARGET", p, f"name {p}", "u", "c", None) for p in "pq"], PRODUCT_SEED)
    retailers = spark.createDataFrame([("TARGET", "Target", "w", "live")], RETAILER_SEED)
    return staging.stage_runs(spark.createDataFrame([], INGESTION_RUNS)), staging.stage_products(products), staging.stage_retailers(retailers)


def content(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def expected(spark, staged, seeds):
    """All tables by a full build from the deduplicated observations."""
    runs, products, retailers = seeds
    observations = intermediate.deduplicated(staged)
    dims = marts.dim_product(products), marts.dim_retailer(retailers), marts.dim_date(spark, AS_OF)
    changes, prices = intermediate.state_changes(observations), intermediate.price_changes(observations)
    daily = intermediate.daily_inventory(observations)
    return {
        "int_inventory_events_deduplicated": observations,
        "int_inventory_state_changes": changes,
        "int_product_price_changes": prices,
        "fact_inventory_observation": marts.fact_inventory_observation(observations, *dims),
        "fact_inventory_state_change": marts.fact_inventory_state_change(changes, *dims),
        "fact_price_observation": marts.fact_price_observation(prices, *dims),
        "mart_daily_product_availability": marts.mart_daily_product_availability(daily, *dims[:2]),
        "mart_retailer_summary": marts.mart_retailer_summary(dims[1], runs, daily, AS_OF),
    }


def compare(spark, warehouse, staged, seeds):
    for name, want in expected(spark, staged, seeds).items():
        got = spark.read.schema(want.schema).parquet(warehouse.path(name)).select(want.columns)
        assert content(got) == content(want), name


STATUSES = ["IN_STOCK", "OUT_OF_STOCK", "PREORDER", None]


def batch(r, n, loaded):
    """New rows and newer copies of earlier ids, of few products and days, some far apart."""
    out = []
    for _ in range(n):
        hours = r.choice([r.randint(0, 72), r.randint(0, 24 * 80)])
        moment = datetime(2024, 1, 1) + timedelta(hours=hours)
        product = r.choice("pqx")
        price = None if r.random() < 0.3 else r.randint(1, 3)
        out.append((f"{product}{hours}", product, moment, loaded, price, r.choice(STATUSES)))
    return list({row[0]: row for row in out}.values())


def test_random_late_batches_equal_a_full_build(spark, tmp_path, seeds):
    r, all_rows = random.Random(3), []
    warehouse = Warehouse(spark, str(tmp_path))
    for step in range(2):
        more = batch(r, 25 if step else 40, datetime(2024, 4, 1) + timedelta(days=step))
        if step == 1:
            more.append(("undated", "p", None, datetime(2024, 4, 9), 2, "IN_STOCK"))
        all_rows += more
        warehouse.refresh(rows_of(spark, more), *seeds, AS_OF, full=True)
    compare(spark, warehouse, rows_of(spark, all_rows), seeds)


def test_a_row_that_moves_leaves_its_old_neighbours_right(spark, tmp_path, seeds):
    day = lambda n: datetime(2024, 1, n)
    first = [(f"e{n}", "p", day(n), day(20), n % 3, STATUSES[n % 2]) for n in (1, 2, 3, 5)]
    warehouse = Warehouse(spark, str(tmp_path), key_fixes_day=False)
    warehouse.refresh(rows_of(spark, first), *seeds, AS_OF)
    moved = [("e2", "p", day(4), day(21), 7, "IN_STOCK")]
    warehouse.refresh(rows_of(spark, moved), *seeds, AS_OF, full=True)
    compare(spark, warehouse, rows_of(spark, [f for f in first if f[0] != "e2"] + moved), seeds)


def test_a_broken_refresh_is_completed_by_the_next(spark, tmp_path, seeds, monkeypatch):
    day = lambda n: datetime(2024, 1, n)
    first = [(f"e{n}", "p", day(n), day(20), n, STATUSES[n % 2]) for n in (1, 2, 4)]
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.refresh(rows_of(spark, first), *seeds, AS_OF)
    more = [("e3", "p", day(3), day(21), 9, "IN_STOCK")]
    monkeypatch.setattr(Warehouse, "complete", lambda self, dims: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        warehouse.refresh(rows_of(spark, more), *seeds, AS_OF)
    monkeypatch.undo()
    # The same rows change nothing any more; the days noted by the broken refresh are redone.
    warehouse.refresh(rows_of(spark, more), *seeds, AS_OF)
    compare(spark, warehouse, rows_of(spark, first + more), seeds)


def pairs(df):
    return sorted((r["retailer_product_id"], str(r[DAY])) for r in df.collect())


def test_neighbouring_days(spark):
    schema = TOUCHED
    day = lambda text: None if text is None else datetime.fromisoformat(text).date()
    make = lambda rows: spark.createDataFrame([("s", p, day(d)) for p, d in rows], schema)
    states = make([("p", "2024-01-01"), ("p", "2024-01-03"), ("p", "2024-09-01"), ("p", None), ("q", "2024-01-02")])
    wanted = make([("p", "2024-01-02"), ("p", "2024-01-03"), ("q", "2024-01-02"), ("p", "2024-09-01"), ("p", None)])
    after = next_or_previous(wanted, states, forward=True)
    assert pairs(after) == [("p", "2024-01-03"), ("p", "2024-09-01"), ("p", "None")]
    before = next_or_previous(wanted, states, forward=False)
    assert pairs(before) == [("p", "2024-01-01"), ("p", "2024-01-01"), ("p", "2024-01-03"), ("p", "2024-09-01")]
    only_undated = next_or_previous(make([("p", None)]), states, forward=False)
    assert pairs(only_undated) == [("p", "2024-09-01")] and LAST.year == 9999


def test_touched_days_are_those_of_changed_rows_only(spark):
    day = lambda n: datetime(2024, 1, n)
    make = lambda rows: intermediate.deduplicated(rows_of(spark, rows)).withColumn(DAY, F.to_date("observed_at")).select(*OBSERVATIONS.names)
    old = make([("a", "p", day(1), day(9), 1, "IN_STOCK"), ("b", "p", day(2), day(9), 1, "IN_STOCK"), ("c", "q", None, day(9), 1, None)])
    new = make([("a", "p", day(1), day(9), 1, "IN_STOCK"), ("b", "p", day(2), day(9), 2, "IN_STOCK"), ("c", "q", day(3), day(9), 1, None), ("d", "q", day(4), day(9), 1, None)])
    assert pairs(touched_days(new, old)) == [("p", "2024-01-02"), ("q", "2024-01-03"), ("q", "2024-01-04"), ("q", "None")]


def test_only_touched_days_are_read_and_rewritten(spark, tmp_path, seeds):
    rows = [(f"e{n}", "p", datetime(2024, 1, 1) + timedelta(days=n), AS_OF, n, "IN_STOCK") for n in range(20)]
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.refresh(rows_of(spark, rows), *seeds, AS_OF)
    history = tmp_path / "int_inventory_state_changes"
    before = {f.parent.name: f.name for f in history.glob(f"{DAY}=*/*.parquet")}
    late = [("late", "p", datetime(2024, 1, 19, 12), AS_OF, 5, "OUT_OF_STOCK")]
    warehouse.refresh(rows_of(spark, late), *seeds, AS_OF)
    after = {f.parent.name: f.name for f in history.glob(f"{DAY}=*/*.parquet")}
    assert {d for d in after if after[d] != before.get(d)} == {f"{DAY}=2024-01-19", f"{DAY}=2024-01-20"}
    days = spark.createDataFrame([(datetime(2024, 1, 19).date(),)], f"{DAY} date")
    plan = only_days(warehouse.observations, days, DAY)._jdf.queryExecution().toString()
    assert "2024-01-19" in next(line for line in plan.splitlines() if "PartitionFilters: [" in line and DAY in line)
