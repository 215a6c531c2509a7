"""A refresh looks its neighbouring days up in one pass and writes its tables once."""

from datetime import date

from shelflog.operators.merge import overwrite_days, read_table
from shelflog.plans.incremental import LAST, TOUCHED, next_or_previous
from shelflog.schemas import INVENTORY_EVENTS


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_neighbouring_days_need_no_join_of_days(spark):
    def make(rows):
        return spark.createDataFrame([("T", p, d) for p, d in rows], TOUCHED)

    days = [date(2024, 1, 1 + i) for i in range(28)]
    states = make([("p", d) for d in days] + [(None, days[0]), (None, days[9]), ("q", None)])
    wanted = make([("p", d) for d in days] + [(None, days[0]), ("q", days[3])])
    after = next_or_previous(wanted.where("observed_date is not null and retailer_product_id = 'p'"), states, forward=True)
    first = plan(next_or_previous(wanted.where("retailer_product_id = 'p'"), states.where("observed_date is not null"), forward=True))
    assert "Join" not in first
    assert sorted(r[2] for r in after.collect()) == days[1:]
    found = {(r[1], r[2]) for r in next_or_previous(wanted, states, forward=True).collect()}
    assert found == {("p", d) for d in days[1:]} | {(None, days[9]), ("q", None)}
    back = sorted((r[1] or "", r[2] or LAST) for r in next_or_previous(wanted, states, forward=False).collect())
    assert back == [("p", d) for d in days[:-1]]


def test_days_without_rows_are_emptied_and_others_kept(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "id long, observed_date date"
    one, two, three = (date(2024, 1, i) for i in (1, 2, 3))
    spark.createDataFrame([(1, one), (2, two), (3, three)], schema).write.partitionBy("observed_date").parquet(path)
    rows = spark.createDataFrame([(9, one)], schema)
    touched = spark.createDataFrame([(one,), (two,)], "observed_date date")
    overwrite_days(rows, path, "observed_date", touched)
    stored = spark.read.schema(schema).parquet(path)
    assert sorted(map(tuple, stored.collect())) == [(3, three), (9, one)]


def test_a_table_not_begun_vanishes_from_the_plan(spark, tmp_path):
    none = read_table(spark, str(tmp_path / "nothing"), INVENTORY_EVENTS)
    assert none.schema == INVENTORY_EVENTS and none.count() == 0
    rows = spark.range(3).selectExpr("cast(id as string) as event_id")
    assert "Join" not in plan(rows.join(none, "event_id", "left_anti"))
