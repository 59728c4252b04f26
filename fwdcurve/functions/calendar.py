"""Calendar of days: seasons and day types by two countries' holidays, from rules alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Months of the seasons, and public holidays as (month, day) or days after Easter Sunday.
SEASON = {"Hiver": (11, 12, 1, 2, 3), "Printemps": (4, 5), "Ete": (6, 7, 8, 9), "Automne": (10,)}
FIXED = {"CH": [(1, 1), (3, 19), (8, 1), (8, 15), (11, 1), (12, 8), (12, 25)], "DE": [(1, 1), (5, 1), (10, 3), (12, 25), (12, 26)]}
AFTER_EASTER = {"CH": [39, 60], "DE": [-2, 1, 39, 50]}
#: Those of FIXED and AFTER_EASTER that count for the whole country, for peak hours.
NATIONAL_FIXED = {"CH": [(1, 1), (8, 1), (12, 25)], "DE": FIXED["DE"]}
NATIONAL_EASTER = {"CH": [39], "DE": AFTER_EASTER["DE"]}


def season(month: Column) -> Column:
    out = None
    for name, months in SEASON.items():
        out = (F.when if out is None else out.when)(month.isin(*months), F.lit(name))
    return out


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian year, by integer arithmetic."""
    q = lambda a, b: F.floor(a / F.lit(b)).cast("int")
    a, b = year % 19, q(year, 100)
    c = year % 100
    h = (19 * a + b - q(b, 4) - q(b - q(b + 8, 25) + 1, 3) + 15) % 30
    w = (32 + 2 * (b % 4) + 2 * q(c, 4) - h - c % 4) % 7
    m = q(a + 11 * h + 22 * w, 451)
    n = h + w - 7 * m + 114
    return F.make_date(year, q(n, 31), n % 31 + 1)


def is_holiday(d: Column, country: str, national: bool = False) -> Column:
    fixed, moving = (NATIONAL_FIXED, NATIONAL_EASTER) if national else (FIXED, AFTER_EASTER)
    on_date = (F.month(d) * 100 + F.day(d)).isin(*(m * 100 + k for m, k in fixed[country]))
    return on_date | F.datediff(d, easter(F.year(d))).isin(*moving[country])


def day_type(d: Column, primary: str) -> Column:
    """The primary country's holiday, the other's, Sunday, Saturday, working day, in this order."""
    other = "DE" if primary == "CH" else "CH"
    return (
        F.when(is_holiday(d, primary), F.lit(f"Ferie_{primary}")).when(is_holiday(d, other), F.lit(f"Ferie_{other}"))
        .when(F.weekday(d) == 6, F.lit("Dimanche")).when(F.weekday(d) == 5, F.lit("Samedi")).otherwise(F.lit("Ouvrable"))
    )


def day_calendar(days: DataFrame) -> DataFrame:
    """days (d) with season, day types and national holidays of both countries."""
    d = F.col("d")
    return days.select("d", season(F.month(d)).alias("season"), *(day_type(d, c).alias(f"day_type_{c.lower()}") for c in FIXED), *(is_holiday(d, c, True).alias(f"holiday_{c.lower()}") for c in FIXED))


def sql(days: str) -> str:
    """The same as SQL over a relation with a column d."""
    q = lambda a, b: f"CAST(floor(({a}) / {b}.0) AS INT)"
    h = f"((19 * (y % 19) + {q('y', 100)} - {q(q('y', 100), 4)} - {q(q('y', 100) + ' - ' + q(q('y', 100) + ' + 8', 25) + ' + 1', 3)} + 15) % 30)"
    w = f"((32 + 2 * ({q('y', 100)} % 4) + 2 * {q('y % 100', 4)} - h - (y % 100) % 4) % 7)"
    n = f"(h + w - 7 * {q('y % 19 + 11 * h + 22 * w', 451)} + 114)"
    listed = lambda pairs: ", ".join(str(m * 100 + k) for m, k in pairs)
    hol = lambda fixed, moving: f"(month(d) * 100 + day(d) IN ({listed(fixed)}) OR date_diff('day', easter, d) IN ({', '.join(map(str, moving))}))"
    full, nat = ({c: hol(f[c], e[c]) for c in FIXED} for f, e in ((FIXED, AFTER_EASTER), (NATIONAL_FIXED, NATIONAL_EASTER)))
    kind = lambda a, b: f"CASE WHEN {full[a]} THEN 'Ferie_{a}' WHEN {full[b]} THEN 'Ferie_{b}' WHEN isodow(d) = 7 THEN 'Dimanche' WHEN isodow(d) = 6 THEN 'Samedi' ELSE 'Ouvrable' END"
    seasons = " ".join(f"WHEN month(d) IN ({', '.join(map(str, m))}) THEN '{s}'" for s, m in SEASON.items())
    return f"""SELECT d, CASE {seasons} END AS season, {kind('CH', 'DE')} AS day_type_ch, {kind('DE', 'CH')} AS day_type_de, {nat['CH']} AS holiday_ch, {nat['DE']} AS holiday_de
  FROM (SELECT d, make_date(y, {q('n', 31)}, n % 31 + 1) AS easter FROM (SELECT *, {n} AS n FROM (SELECT *, {w} AS w FROM (SELECT d, y, {h} AS h FROM (SELECT DISTINCT d, year(d) AS y FROM {days})))))"""
