"""Time columns: slots, local time, grids, peak flags, horizons. All times are UTC wall clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = {"CH": "Europe/Zurich", "DE": "Europe/Berlin"}


def floor_slot(ts: Column, minutes: int) -> Column:
    """Start of the slot of so many minutes (a divisor of 60) that holds ts."""
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz")
    return hour + F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts) - F.minute(ts) % minutes)


def local_time(ts: Column, zone: str = "Europe/Zurich") -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def to_utc(local: Column, zone: str = "Europe/Zurich") -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def grid(bounds: DataFrame, step: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows ts of [start, end) in steps like '15 minutes' for each row (keys, start, end)."""
    slots = F.sequence("start", F.col("end") - F.expr(f"INTERVAL {step}"), F.expr(f"INTERVAL {step}"))
    return bounds.where(F.col("start") < F.col("end")).select(*keys, F.explode(slots).alias("ts"))


def peak_exchange(local: Column, holiday: Column) -> Column:
    """Monday to Friday, 8 to 20 local time, no holiday."""
    return (F.weekday(local) < 5) & F.hour(local).between(8, 19) & ~holiday


def peak_weekday(local: Column) -> Column:
    """Monday to Friday, 8 to 20 local time."""
    return (F.weekday(local) < 5) & F.hour(local).between(8, 19)


def peak_daily(hour: Column) -> Column:
    """Hours 7 to 19 of every day."""
    return hour.between(7, 19)


def months_between(start: Column, end: Column) -> Column:
    """Calendar months from start to end, not below 0."""
    return F.greatest((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start), F.lit(0))


def months_rounded(days: Column) -> Column:
    """Months of 30 days, rounded half to even, not below 0."""
    return F.greatest(F.bround(days / 30.0, 0), F.lit(0.0)).cast("int")


def step_lookup(x: Column, steps: list[tuple[float, float]], above: float) -> Column:
    """The value of the first step whose limit isn't below x."""
    out = None
    for limit, value in steps:
        out = (F.when if out is None else out.when)(x <= limit, F.lit(value))
    return out.otherwise(F.lit(above))


# Fixed values of the curve tables.
WIDENING = [(6, 2.50), (12, 2.80), (24, 3.50), (36, 4.20)]
CONFIDENCE = [(6, 1.0), (12, 0.85), (24, 0.65)]
SPREAD = [(6, 1.0), (12, 1.5), (24, 2.5), (36, 3.5)]
CAPTURE = [(6, 0.8), (12, 0.6), (24, 0.4), (36, 0.3)]
RISK_BY_HOUR = [0.3, 0.2, 0.2, 0.2, 0.3, 0.4, 1.2, 1.5, 1.8, 1.5, 1.0, 0.8, 0.7, 0.6, 0.6, 0.7, 0.8, 1.5, 2.0, 2.2, 1.8, 1.0, 0.6, 0.4]


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def cyclic(x: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of x over a period."""
    turn = x * (2 * 3.141592653589793 / period)
    return F.sin(turn), F.cos(turn)


def key_of(year: Column, quarter: Column, month: Column) -> Column:
    """Period key: 2026, 2026-Q1 or 2026-03."""
    return F.when(month.isNotNull(), F.format_string("%d-%02d", year, month)).when(quarter.isNotNull(), F.format_string("%d-Q%d", year, quarter)).otherwise(year.cast("string"))


KEY_PATTERN = r"^(\d{4})(?:-(?:Q([1-4])|(0[1-9]|1[0-2])))?(?:-(Peak|Offpeak))?$"


def parse_key(key: Column) -> Column:
    """struct(year, quarter, month, load) of a period key; null if it isn't one."""
    part = lambda k: F.nullif(F.regexp_extract(key, KEY_PATTERN, k), F.lit(""))
    fields = F.struct(part(1).cast("int").alias("year"), part(2).cast("int").alias("quarter"), part(3).cast("int").alias("month"), F.coalesce(part(4), F.lit("Base")).alias("load"))
    return F.when(key.rlike(KEY_PATTERN), fields)
