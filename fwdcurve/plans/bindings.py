"""Canonical tables bound to the star-schema tables, once for Spark and once as SQL.

`Tables` gives lazily built DataFrames; `WITH` starts the SQL of a query with the same tables as CTEs.
Times are UTC wall clock (TIMESTAMP_NTZ).
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import day_calendar
from ..functions.timegrid import floor_slot
from ..sources import writers


class Tables:
    """spot: 15-minute series; daily: two markets; hydro: weekly reservoir; outages: revised intervals;
    quotes: forward quotes; commodities: daily closes; raw tables by their own name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._written = spark, path, {}

    def settled(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table that build gives, written to the shared folder the first time: for what a query meets several times."""
        if name not in self._written:
            table = build()
            table.write.parquet(f"{(folder := writers.shared_folder(self.spark, name))}/rows")
            self._written[name] = self.spark.read.schema(table.schema).parquet(f"{folder}/rows")
        return self._written[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def settler(self, name: str) -> Callable[[DataFrame], DataFrame]:
        """A function that writes each table it is given to a new folder and reads it back."""
        folder, count = writers.shared_folder(self.spark, name), itertools.count()

        def settle(table: DataFrame) -> DataFrame:
            path = f"{folder}/{next(count)}"
            table.write.parquet(path)
            return self.spark.read.schema(table.schema).parquet(path)

        return settle

    @cached_property
    def spot(self) -> DataFrame:
        ticks = self.events.select(F.col("event_type").alias("series"), floor_slot(F.col("ts"), 15).alias("ts"), "value")
        return ticks.groupBy("series", "ts").agg(F.avg("value").alias("price"))

    @cached_property
    def daily(self) -> DataFrame:
        ch = self.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg((F.avg("o_totalprice") / 1000).alias("price"))
        de = self.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg((F.avg("l_extendedprice") / 1000).alias("price"))
        return ch.select(F.lit("CH").alias("market"), "d", "price").unionByName(de.select(F.lit("DE").alias("market"), "d", "price"))

    @cached_property
    def hydro(self) -> DataFrame:
        weeks = self.lineitem.groupBy(F.to_date(F.date_trunc("week", "l_shipdate")).alias("week")).agg(F.sum("l_quantity").alias("fill"))
        top = weeks.agg(F.max("fill").alias("top"))
        return weeks.crossJoin(F.broadcast(top)).select("week", (100 * F.col("fill") / F.col("top")).alias("fill_pct"))

    @cached_property
    def outages(self) -> DataFrame:
        start = F.col("l_shipdate").cast("timestamp_ntz")
        return self.lineitem.select(
            F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("revision"), start.alias("start_ts"),
            (start + F.make_dt_interval(F.lit(0), F.col("l_quantity").cast("int"))).alias("end_ts"),
            (F.col("l_extendedprice") / 1000).alias("mw"), F.col("l_returnflag").alias("fuel"), F.col("l_linestatus").alias("status"),
            F.col("l_partkey").alias("tie1"), F.col("l_suppkey").alias("tie2"),
        )

    @cached_property
    def commodities(self) -> DataFrame:
        joined = self.lineitem.join(self.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
        return joined.groupBy(F.to_date("l_shipdate").alias("d"), F.col("p_brand").alias("name")).agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("close"))

    @cached_property
    def quotes(self) -> DataFrame:
        """Yearly, quarterly and monthly means of the daily prices; odd years have the year alone, even years
        lack the third quarter and all months but January."""
        y, q, m = F.year("d"), F.quarter("d"), F.month("d")
        days = self.daily.select("market", y.alias("year"), q.alias("quarter"), m.alias("month"), "price")
        sets = days.groupingSets([["market", "year"], ["market", "year", "quarter"], ["market", "year", "quarter", "month"]], "market", "year", "quarter", "month").agg(F.avg("price").alias("price"))
        even = F.col("year") % 2 == 0
        keep = F.col("quarter").isNull() | (even & F.col("month").isNull() & (F.col("quarter") != 3)) | (even & (F.col("month") == 1))
        return sets.where(keep).select("market", "year", F.when(F.col("month").isNull(), F.col("quarter")).alias("quarter"), "month", "price")

    @cached_property
    def calendar(self) -> DataFrame:
        """Day type and season of each day of the daily prices, for both countries."""
        return day_calendar(self.daily.select("d").distinct())


Q = lambda a, b: f"CAST(floor(({a}) / {b}.0) AS INT)"

BASE = """
spot AS (SELECT event_type AS series, time_bucket(INTERVAL 15 minute, ts) AS ts, avg(value) AS price FROM events GROUP BY ALL),
daily AS (SELECT 'CH' AS market, CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) / 1000 AS price FROM orders GROUP BY ALL
  UNION ALL SELECT 'DE' AS market, CAST(l_shipdate AS DATE) AS d, avg(l_extendedprice) / 1000 AS price FROM lineitem GROUP BY ALL),
hydro_w AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week, sum(l_quantity) AS fill FROM lineitem GROUP BY ALL),
hydro AS (SELECT week, 100 * fill / (SELECT max(fill) FROM hydro_w) AS fill_pct FROM hydro_w),
outages AS (SELECT l_orderkey AS id, l_linenumber AS revision, l_shipdate AS start_ts, l_shipdate + to_hours(CAST(l_quantity AS INT)) AS end_ts,
  l_extendedprice / 1000 AS mw, l_returnflag AS fuel, l_linestatus AS status, l_partkey AS tie1, l_suppkey AS tie2 FROM lineitem),
commodities AS (SELECT CAST(l_shipdate AS DATE) AS d, p_brand AS name, avg(l_extendedprice / l_quantity) AS close FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
quotes AS (SELECT market, y AS year, CASE WHEN m IS NULL THEN q END AS quarter, m AS month, price FROM (
  SELECT market, y, q, m, avg(price) AS price FROM (SELECT market, year(d) AS y, quarter(d) AS q, month(d) AS m, price FROM daily)
  GROUP BY GROUPING SETS ((market, y), (market, y, q), (market, y, q, m))) WHERE q IS NULL OR (y % 2 = 0 AND m IS NULL AND q <> 3) OR (y % 2 = 0 AND m = 1))
"""
WITH = "WITH " + BASE
