"""Joins with an order in time: as-of, contracts and slots, prioritised lookup, last week's value, pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import valid_ranges

# Default weights of day types.
DAY_WEIGHTS = {"Ouvrable": 1.05, "Samedi": 0.92, "Dimanche": 0.78, "Ferie_CH": 0.75, "Ferie_DE": 0.88}


def asof_weekly(left: DataFrame, weeks: DataFrame, time: str, week: str, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """left with the value of the latest week at or before its day, within keys (columns of both sides).

    Each value's validity is cut into the weeks it spans, so the join is an equi-join on the week with no
    range condition left but for the first days; a value carried over missing weeks is repeated in each.
    The last value is carried to the last day of left. Without keys the weeks are one series, a row each."""
    last = left.groupBy(*keys).agg(F.max(time).alias("last_day"))
    one = [*keys] or ["_one"]
    ranges = valid_ranges(weeks.select(*keys, week, value).withColumn("_one", F.lit(1)), week, one)
    ranges = ranges.join(last, [*keys]) if keys else ranges.crossJoin(F.broadcast(last))
    end = F.coalesce(F.date_sub("valid_to", 1), F.greatest(F.col(week), F.col("last_day")))
    filled = ranges.select(*keys, F.explode(F.sequence(F.col(week), end, F.expr("INTERVAL 7 DAYS"))).alias("_week"), value)
    return left.withColumn("_week", F.to_date(F.date_trunc("week", time))).join(filled, [*keys, "_week"], "left").drop("_week")


def contract_slots(quotes: DataFrame, slots: DataFrame) -> DataFrame:
    """Each contract (market, year, quarter, month, price) with the days (market, d, price) that it covers.

    A day is exploded into the three periods it lies in, which makes the interval join an equi-join."""
    period = lambda q, m: F.struct(F.year("d").alias("year"), q.alias("q"), m.alias("m"))
    none = F.lit(0)
    days = slots.select("market", "d", F.col("price").alias("slot_price"), F.inline(F.array(period(none, none), period(F.quarter("d"), none), period(none, F.month("d")))))
    keyed = quotes.withColumns({"q": F.coalesce("quarter", none), "m": F.coalesce("month", none)})
    return keyed.join(days, ["market", "year", "q", "m"]).drop("q", "m")


def base_lookup(slots: DataFrame, quotes: DataFrame) -> DataFrame:
    """slots (market, d, …) with base: the quote of the month, else quarter, year, year before, two before."""
    rows = slots.withColumns({"_y": F.year("d"), "_q": F.quarter("d"), "_m": F.month("d")})
    kinds = {
        "b0": (quotes.where("month IS NOT NULL"), {"year": F.col("_y"), "month": F.col("_m")}),
        "b1": (quotes.where("quarter IS NOT NULL"), {"year": F.col("_y"), "quarter": F.col("_q")}),
        **{f"b{2 + k}": (quotes.where("quarter IS NULL AND month IS NULL"), {"year": F.col("_y") - k}) for k in range(3)},
    }
    for name, (part, on) in kinds.items():
        side = part.select(F.col("market").alias("_market"), *(F.col(c).alias(f"_k_{c}") for c in on), F.col("price").alias(name))
        met = F.col("market") == F.col("_market")
        for c, value in on.items():
            met = met & (F.col(f"_k_{c}") == value)
        rows = rows.join(side, met, "left").drop("_market", *(f"_k_{c}" for c in on))
    return rows.withColumn("base", F.coalesce(*kinds)).drop("_y", "_q", "_m", *kinds)


def last_week(spot: DataFrame, start: str) -> DataFrame:
    """spot from start on, with naive: the mean of the same weekday and slot in the week before start, else
    the series' mean before it."""
    at = F.lit(start).cast("timestamp_ntz")
    key = {"w": F.weekday("ts"), "h": F.hour("ts"), "q": F.minute("ts")}
    before = spot.where(F.col("ts") < at)
    week = before.where(F.col("ts") >= at - F.expr("INTERVAL 7 DAYS")).withColumns(key).groupBy("series", *key).agg(F.avg("price").alias("m"))
    mean = before.groupBy("series").agg(F.avg("price").alias("g"))
    rows = spot.where(F.col("ts") >= at).withColumns(key).join(week, ["series", *key], "left").join(mean, "series")
    return rows.select("series", "ts", "price", F.coalesce("m", "g").alias("naive"))


def pairs(closes: DataFrame) -> DataFrame:
    """(d, name_a, close_a, name_b, close_b) of all pairs of names on a day, name_a < name_b."""
    side = lambda x: closes.select("d", F.col("name").alias(f"name_{x}"), F.col("close").alias(f"close_{x}"))
    return side("a").join(side("b"), "d").where("name_a < name_b")
