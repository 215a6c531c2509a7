"""Warehouse tables brought up to date from what changed, day by day.

A refresh upserts the observations, notes which days of which series it touched, and from
there recomputes only what can differ: the touched days of the roll-up, the histories of these
days and of the next day of the same series (its first row gets another predecessor), and the
facts and marts of the days rewritten. The touched days are written down before anything else
changes and removed at the end, and every step recomputes from the tables below it, so a
refresh that broke off is completed by the next one.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.operators.merge import newest_moment, only_days, overwrite_days, read_table, rewrite_days, since_lookback, upsert_written
from shelflog.plans import intermediate, marts
from shelflog.plans.intermediate import SERIES
from shelflog.plans.load import DAY, OBSERVATIONS
from shelflog.session import remove_path, temporary_table

TOUCHED = T.StructType([*[OBSERVATIONS[c] for c in SERIES], OBSERVATIONS[DAY]])
# A neighbouring day is looked for within so many days first, then among all.
NEAR_DAYS = 32
LAST = date(9999, 12, 31)  # where rows without a time stand: behind all others


def _same(left: str, right: str, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _among(rows: DataFrame, wanted: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    return rows.alias("l").join(wanted.alias("r"), _same("l", "r", columns), how)


def touched_days(fresh: DataFrame, target: DataFrame, key_fixes_day: bool = True) -> DataFrame:
    """Series and days of the rows of ``fresh`` that are new to ``target`` or differ from it.

    A row that moved counts on its old day too. With ``key_fixes_day`` the old rows are looked
    for on the days of the new ones and among those without a day.
    """
    if key_fixes_day:
        undated = fresh.sparkSession.createDataFrame([(None,)], T.StructType([OBSERVATIONS[DAY]]))
        target = only_days(target, fresh.select(DAY).unionByName(undated), DAY)
    columns = [c for c in OBSERVATIONS.names if c != "event_id"]
    new = fresh.select("event_id", F.struct(*columns).alias("new"))
    old = target.select("event_id", F.struct(*columns).alias("old"))
    changed = new.join(old, "event_id", "left").where(~F.col("new").eqNullSafe(F.col("old")))
    sides = changed.select(F.explode(F.array("old", "new")).alias("row")).where("row is not null")
    return sides.select(*[F.col(f"row.{c}").alias(c) for c in TOUCHED.names]).distinct()


def _order(day: Column) -> Column:
    return F.coalesce(day, F.lit(LAST))


def next_or_previous(wanted: DataFrame, states: DataFrame, forward: bool) -> DataFrame:
    """The nearest day after (before) each of ``wanted`` on which its series has a row in ``states``.

    The folders near the wanted days are read first; only what has no neighbour there is
    looked up in all.
    """
    low, high, undated = wanted.agg(F.min(DAY), F.max(DAY), F.count_if(F.col(DAY).isNull())).first()
    days = states.select(*SERIES, DAY)

    def nearest(ask: DataFrame, among: DataFrame) -> DataFrame:
        # Both in one order per series: each asked day takes the last state day ahead of it.
        place = F.unix_date(_order(F.col(DAY))).cast("bigint") * (-1 if forward else 1)
        both = ask.select(*SERIES, DAY, F.lit(True).alias("_ask")).unionByName(among.withColumn("_ask", F.lit(False)))
        ahead = Window.partitionBy(*SERIES).orderBy("_place").rangeBetween(Window.unboundedPreceding, -1)
        met = both.withColumn("_place", place).withColumn("_near", F.max(F.when(~F.col("_ask"), F.col("_place"))).over(ahead))
        near = F.date_from_unix_date((F.col("_near") * (-1 if forward else 1)).cast("int"))
        found = met.where(F.col("_ask") & F.col("_near").isNotNull())
        return found.select(*SERIES, F.col(DAY).alias("_asked"), F.nullif(near, F.lit(LAST)).alias(DAY))

    if low is None:
        return nearest(wanted, days).select(*TOUCHED.names)
    span = timedelta(days=NEAR_DAYS)
    close = F.coalesce(F.col(DAY).between(F.lit(low - span), F.lit(high + span)), F.lit(False))
    found = nearest(wanted.where(F.col(DAY).isNotNull()), days.where(close))
    both = found.select(*TOUCHED.names)
    if not undated and days.where(~close).isEmpty():
        return both
    asked = found.select(*SERIES, F.col("_asked").alias(DAY))
    rest = _among(wanted, asked, TOUCHED.names, "left_anti")
    return both if rest.isEmpty() else both.unionByName(nearest(rest, days).select(*TOUCHED.names))


def _of_days(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` on the series' days of ``wanted``; other folders are not read."""
    return _among(only_days(table, wanted.select(DAY), DAY), wanted, TOUCHED.names)


def _with_day(df: DataFrame, moment: str = "observed_at") -> DataFrame:
    return df.withColumn(DAY, F.to_date(moment))


class Warehouse:
    """The tables under ``folder`` and their refresh."""

    def __init__(self, spark: SparkSession, folder: str, key_fixes_day: bool = True):
        self.spark, self.folder, self.key_fixes_day = spark, folder, key_fixes_day

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str, schema: T.StructType) -> DataFrame:
        return read_table(self.spark, self.path(name), schema)

    @property
    def observations(self) -> DataFrame:
        return self.table("int_inventory_events_deduplicated", OBSERVATIONS)

    def _models(self) -> dict[str, DataFrame]:
        """The models over no rows: their columns."""
        none = self.spark.createDataFrame([], OBSERVATIONS)
        return {
            "int_inventory_state_changes": _with_day(intermediate.state_changes(none)),
            "int_product_price_changes": _with_day(intermediate.price_changes(none)),
            "int_product_daily_states": intermediate.daily_states(none).withColumnRenamed("observation_date", DAY),
        }

    def refresh(
        self,
        staged: DataFrame,
        staged_runs: DataFrame,
        products: DataFrame,
        retailers: DataFrame,
        as_of: datetime | None = None,
        *,
        full: bool = False,
    ) -> None:
        """Take in ``staged`` observations under the 48-hour lookback (all, if ``full``).

        The dimensions are small and written anew; the facts carry only keys made from natural
        keys. The daily mart carries names and categories too: days are rewritten with today's
        catalog, older ones keep theirs until ``rebuild_marts``.
        """
        recent = staged
        if not full:
            recent = since_lookback(staged, newest_moment(self.spark, self.path("int_inventory_events_deduplicated"), OBSERVATIONS))
        pending = self.path("pending-days")
        with temporary_table(_with_day(intermediate.deduplicated(recent)).select(*OBSERVATIONS.names), "fresh") as fresh:
            noted = touched_days(fresh, self.observations, self.key_fixes_day).withColumn("refresh", F.lit(uuid.uuid4().hex))
            noted.write.mode("append").parquet(pending)
            upsert_written(fresh, self.path("int_inventory_events_deduplicated"), "event_id", day=DAY, key_fixes_day=self.key_fixes_day)
        dims = self._dimensions(products, retailers, as_of)
        self.complete(dims)
        marts.mart_retailer_summary(
            dims[1], staged_runs, None, as_of, availability=intermediate.availability_of(self.source_days())
        ).write.mode("overwrite").parquet(self.path("mart_retailer_summary"))

    def _dimensions(self, products: DataFrame, retailers: DataFrame, as_of: datetime | None) -> tuple[DataFrame, DataFrame, DataFrame]:
        dims = {
            "dim_product": marts.dim_product(products),
            "dim_retailer": marts.dim_retailer(retailers),
            "dim_date": marts.dim_date(self.spark, as_of),
        }
        for name, dim in dims.items():
            dim.write.mode("overwrite").parquet(self.path(name))
        return tuple(self.table(name, dim.schema) for name, dim in dims.items())

    def complete(self, dims: tuple[DataFrame, DataFrame, DataFrame]) -> None:
        """Bring everything above the observations up to date with the days noted as touched."""
        pending = self.path("pending-days")
        noted = read_table(self.spark, pending, TOUCHED).distinct()
        with temporary_table(noted, "touched") as touched:
            if not touched.isEmpty():
                self._apply(touched, dims)
        remove_path(self.spark, pending)

    def _apply(self, touched: DataFrame, dims: tuple[DataFrame, DataFrame, DataFrame]) -> None:
        empty = self._models()
        observed = self.observations

        # Roll-up of the touched days of each series, and per source.
        states = intermediate.daily_states(_of_days(observed, touched)).withColumnRenamed("observation_date", DAY)
        self._replace("int_product_daily_states", states, touched, empty)
        stored = self.table("int_product_daily_states", empty["int_product_daily_states"].schema)
        days = touched.select(DAY).distinct()
        self._overwrite("source_days", intermediate.source_days(only_days(stored, days, DAY)), days)
        finished = intermediate.finish_daily(only_days(stored, days, DAY).withColumnRenamed(DAY, "observation_date"))
        mart = marts.mart_daily_product_availability(finished, *dims[:2])
        self._overwrite("mart_daily_product_availability", mart, days, "observation_date")
        self._overwrite("fact_inventory_observation", _with_day(marts.fact_inventory_observation(only_days(observed, days, DAY).drop(DAY), *dims)), days)

        # Histories: the touched days, and the next day of the same series.
        for name, build, fact, states_of in (
            ("int_inventory_state_changes", intermediate.state_changes, ("fact_inventory_state_change", marts.fact_inventory_state_change), stored),
            ("int_product_price_changes", intermediate.price_changes, ("fact_price_observation", marts.fact_price_observation), stored.where("priced > 0")),
        ):
            following = next_or_previous(touched, states_of, forward=True)
            with temporary_table(touched.unionByName(following).distinct(), "history-days") as changed:
                before = next_or_previous(changed, states_of, forward=False)
                with temporary_table(changed.unionByName(before).distinct(), "context-days") as context:
                    rows = build(_of_days(observed, context).drop(DAY))
                    self._replace(name, _among(_with_day(rows), changed, TOUCHED.names), changed, empty)
                days = changed.select(DAY).distinct()
                history = only_days(self.table(name, empty[name].schema), days, DAY).drop(DAY)
                self._overwrite(fact[0], _with_day(fact[1](history, *dims)), days)

    def _replace(self, name: str, rows: DataFrame, changed: DataFrame, empty: dict[str, DataFrame]) -> None:
        """Put ``rows`` in the place of the series' days ``changed``."""
        target = self.table(name, empty[name].schema)
        kept = _among(only_days(target, changed.select(DAY), DAY), changed, TOUCHED.names, "left_anti")
        rewrite_days(kept.unionByName(rows.select(*target.columns)), self.path(name), DAY, changed.select(DAY).distinct())

    def _overwrite(self, name: str, rows: DataFrame, days: DataFrame, day: str = DAY) -> None:
        """Let the days hold ``rows``, which come from other tables than ``name``."""
        overwrite_days(rows, self.path(name), day, days.withColumnRenamed(DAY, day))

    def source_days(self) -> DataFrame:
        return self.table("source_days", intermediate.source_days(self._models()["int_product_daily_states"]).schema)

    def rebuild_marts(self, products: DataFrame, retailers: DataFrame, as_of: datetime | None = None) -> None:
        """Write the daily mart anew from the stored states, with today's catalog on all days."""
        dims = self._dimensions(products, retailers, as_of)
        stored = self.table("int_product_daily_states", self._models()["int_product_daily_states"].schema)
        finished = intermediate.finish_daily(stored.withColumnRenamed(DAY, "observation_date"))
        mart = marts.mart_daily_product_availability(finished, *dims[:2])
        self._overwrite("mart_daily_product_availability", mart, stored.select(DAY).distinct(), "observation_date")
