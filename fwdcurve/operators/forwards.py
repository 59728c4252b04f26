"""Forward contracts: ratios, cascading of yearly and quarterly quotes, contract tables, proxies.

Quotes are (market, year, quarter, month, price) with null quarter and month for a year's quote; months holds
(year, quarter, month, hours, peak_hours, offpeak_hours)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Seasonal ratios used without history.
DEFAULT_QUARTER = [1.12, 0.92, 0.88, 1.08]
DEFAULT_MONTH = [1.18, 1.14, 1.04, 0.94, 0.90, 0.92, 0.88, 0.86, 0.90, 1.02, 1.10, 1.12]


def seasonal_ratios(days: DataFrame, full_years: DataFrame) -> DataFrame:
    """(market, kind, no, ratio): mean over full years of the period's mean over the year's; kind is quarter or month."""
    rows = days.withColumn("year", F.year("d")).join(full_years.select("market", "year"), ["market", "year"])
    rows = rows.select("market", "year", "price", F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), f("d").alias("no")) for k, f in (("quarter", F.quarter), ("month", F.month))))))
    per = rows.groupBy("market", "year", "kind", "no").agg(F.avg("price").alias("mean"))
    year = days.groupBy("market", F.year("d").alias("year")).agg(F.avg("price").alias("all"))
    return per.join(year, ["market", "year"]).select("market", "year", "kind", "no", (F.col("mean") / F.col("all")).alias("ratio"))


def mean_ratios(ratios: DataFrame) -> DataFrame:
    return ratios.groupBy("market", "kind", "no").agg(F.avg("ratio").alias("ratio"))


def trended_ratio(base: Column, slope: Column, years_ahead: Column, most: float = 0.20) -> Column:
    """Ratio carried along its trend, at most a share `most` of itself away."""
    move = slope * years_ahead
    return base + F.greatest(-most * base, F.least(most * base, move))


def quarter_table(months: DataFrame) -> DataFrame:
    return months.groupBy("year", "quarter").agg(F.sum("hours").alias("hours"))


def cascade_quarters(quotes: DataFrame, months: DataFrame, ratios: DataFrame) -> DataFrame:
    """(market, year, quarter, hours, price, derived): quarters of each year with a yearly quote.

    Quoted quarters stay. The energy of the year that they leave goes to the others by ratio and hours; with
    none quoted this is the year's price by ratio, scaled to its mean."""
    years = quotes.where("quarter IS NULL AND month IS NULL").select("market", "year", F.col("price").alias("year_price"))
    known = quotes.where("quarter IS NOT NULL").select("market", "year", "quarter", F.col("price").alias("quoted"))
    share = ratios.where("kind = 'quarter'").select("market", F.col("no").alias("quarter"), "ratio")
    rows = years.join(quarter_table(months), "year").join(share, ["market", "quarter"], "left").join(known, ["market", "year", "quarter"], "left")
    return _split(rows, ["market", "year"], "year_price").select("market", "year", "quarter", "hours", "price", F.col("quoted").isNull().alias("derived"))


def cascade_months(quarters: DataFrame, quotes: DataFrame, months: DataFrame, ratios: DataFrame) -> DataFrame:
    """(market, year, quarter, month, hours, price, derived): months of each quarter, as cascade_quarters."""
    known = quotes.where("month IS NOT NULL").select("market", "year", "month", F.col("price").alias("quoted"))
    share = ratios.where("kind = 'month'").select("market", F.col("no").alias("month"), "ratio")
    parents = quarters.select("market", "year", "quarter", F.col("price").alias("parent_price"))
    rows = parents.join(months, ["year", "quarter"]).join(share, ["market", "month"], "left").join(known, ["market", "year", "month"], "left")
    return _split(rows, ["market", "year", "quarter"], "parent_price").select("market", "year", "quarter", "month", "hours", "price", F.col("quoted").isNull().alias("derived"))


def _split(rows: DataFrame, parent: list[str], price: str) -> DataFrame:
    w = Window.partitionBy(*parent)
    ratio = F.coalesce("ratio", F.lit(1.0))
    open_ = F.col("quoted").isNull()
    rest = F.col(price) * F.sum("hours").over(w) - F.sum(F.coalesce(F.col("quoted") * F.col("hours"), F.lit(0.0))).over(w)
    shares = F.sum(F.when(open_, ratio * F.col("hours"))).over(w)
    return rows.withColumn("price", F.when(open_, rest * ratio / F.nullif(shares, F.lit(0.0))).otherwise(F.col("quoted")))


def conservation(children: DataFrame, parents: DataFrame, on: list[str], tolerance: float = 0.001) -> DataFrame:
    """Per parent: the hour-weighted mean of its children, and whether it meets the parent's price."""
    mean = children.groupBy(*on).agg((F.sum(F.col("price") * F.col("hours")) / F.sum("hours")).alias("implied"))
    rows = parents.join(mean, on)
    return rows.withColumn("conserved", F.abs(F.col("implied") - F.col("price")) <= tolerance)


def offpeak(base: Column, peak: Column, hours: Column, peak_hours: Column) -> Column:
    """Off-peak price that peak and base imply by their hours."""
    return F.try_divide(base * hours - peak * peak_hours, hours - peak_hours)


def monthly_contracts(quotes: DataFrame, peaks: DataFrame, months: DataFrame) -> DataFrame:
    """Disjoint contracts of each month of a quoted year: peak and off-peak if the month has a peak quote, else base.

    The month's price is its own quote's, else the quarter's, else the year's."""
    years = quotes.select("market", "year").distinct()
    rows = years.join(months, "year")
    for name, keys, part in (("m", ["market", "year", "month"], quotes.where("month IS NOT NULL")), ("q", ["market", "year", "quarter"], quotes.where("quarter IS NOT NULL")), ("y", ["market", "year"], quotes.where("quarter IS NULL AND month IS NULL"))):
        rows = rows.join(part.select(*keys, F.col("price").alias(name)), keys, "left")
    rows = rows.withColumn("base", F.coalesce("m", "q", "y")).join(peaks.select("market", "year", "month", "peak"), ["market", "year", "month"], "left")
    spec = lambda load, price, hours: F.struct(F.lit(load).alias("load"), price.cast("double").alias("price"), hours.alias("hours"))
    pair = F.array(spec("Peak", F.col("peak"), F.col("peak_hours")), spec("Offpeak", offpeak(F.col("base"), F.col("peak"), F.col("hours"), F.col("peak_hours")), F.col("offpeak_hours")))
    one = F.array(spec("Base", F.col("base"), F.col("hours")))
    return rows.where("base IS NOT NULL").select("market", "year", "month", F.inline(F.when(F.col("peak").isNotNull(), pair).otherwise(one)))


# Peak over base price without history, for synthesised quotes and for the proxy; days of the proxy's level and shape.
DEFAULT_PEAK, PROXY_PEAK = 1.05, 1.15
ANCHOR_DAYS, SHAPE_DAYS = 180, 730


def peak_ratios(hours: DataFrame, full_years: DataFrame, least: int = 24) -> DataFrame:
    """(market, month, ratio): mean over full years of a month's mean price in peak hours over that in all hours.

    hours: (market, year, month, price, is_peak) in local time; months with few hours or without a positive base don't count."""
    per = hours.join(full_years.select("market", "year"), ["market", "year"]).groupBy("market", "year", "month")
    per = per.agg(F.avg("price").alias("base"), F.avg(F.when(F.col("is_peak"), F.col("price"))).alias("peak"), F.count(F.lit(1)).alias("n"))
    return per.where((F.col("n") >= least) & (F.col("base") > 0) & F.col("peak").isNotNull()).groupBy("market", "month").agg(F.avg(F.col("peak") / F.col("base")).alias("ratio"))


def period_ratios(ratios: DataFrame, markets: DataFrame) -> DataFrame:
    """(market, quarter, month, ratio) of peak over base for months, quarters (mean of three) and the year (both null)."""
    every = markets.select("market", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")).join(ratios, ["market", "month"], "left")
    every = every.select("market", F.ceil(F.col("month") / 3).cast("int").alias("quarter"), "month", F.coalesce("ratio", F.lit(DEFAULT_PEAK)).alias("ratio"))
    sets = every.groupingSets([["market"], ["market", "quarter"], ["market", "quarter", "month"]], "market", "quarter", "month").agg(F.avg("ratio").alias("ratio"))
    return sets.select("market", F.when(F.col("month").isNull(), F.col("quarter")).alias("quarter"), "month", "ratio")


def with_peaks(quotes: DataFrame, peaks: DataFrame, ratios: DataFrame) -> DataFrame:
    """quotes with peak, the quoted one of peaks (market, year, quarter, month, peak) or else the base price by ratio,
    and whether it is synthetic."""
    same = lambda a, b, *keys: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    rows = quotes.alias("q").join(peaks.alias("p"), same("q", "p", "market", "year", "quarter", "month"), "left").join(ratios.alias("r"), same("q", "r", "market", "quarter", "month"), "left")
    peak = F.coalesce("p.peak", F.col("q.price") * F.coalesce("r.ratio", F.lit(DEFAULT_PEAK)))
    return rows.select("q.*", peak.alias("peak"), F.col("p.peak").isNull().alias("synthetic"))


def load_months(base: DataFrame, peak: DataFrame, months: DataFrame) -> DataFrame:
    """(market, year, quarter, month, hours, peak_hours, base, peak, offpeak) of the months of two cascades, base and peak:
    as both keep their energy, the off-peak price that a period implies is that of its months."""
    keys = ["market", "year", "quarter", "month"]
    rows = base.select(*keys, F.col("price").alias("base")).join(peak.select(*keys, F.col("price").alias("peak")), keys).join(months, ["year", "quarter", "month"])
    return rows.select(*keys, "hours", "peak_hours", "base", "peak", offpeak(F.col("base"), F.col("peak"), F.col("hours"), F.col("peak_hours")).alias("offpeak"))


def level_of(months: DataFrame, periods: DataFrame, name: str) -> DataFrame:
    """months with `name`: the price of its own month in periods (market, year, quarter, month, price), else of its quarter,
    else of its year."""
    rows = months
    parts = (("_m", ["market", "year", "month"], "month IS NOT NULL"), ("_q", ["market", "year", "quarter"], "quarter IS NOT NULL AND month IS NULL"), ("_y", ["market", "year"], "quarter IS NULL AND month IS NULL"))
    for part, keys, of in parts:
        rows = rows.join(periods.where(of).select(*keys, F.col("price").alias(part)), keys, "left")
    return rows.withColumn(name, F.coalesce("_m", "_q", "_y")).drop("_m", "_q", "_y")


def proxy_quotes(days: DataFrame, hours: DataFrame, n_years: int = 4) -> DataFrame:
    """(market, year, quarter, month, base, peak) of the n_years after a market's last price, from prices alone.

    The level is the mean of the last ANCHOR_DAYS, moved each year by the median yearly change within -10 % and 0 (-3 % below
    three years); a month has its share of the last SHAPE_DAYS (of all days, if those hold less than 180); quarters are means of
    months; peaks follow the ratio of the same hours. A year has no peak quote."""
    last = days.groupBy("market").agg(F.max("d").alias("last"))
    shape_from = lambda rows: rows.join(recent, "market").where(F.col("d") > F.col("from"))
    anchor = days.join(last, "market").where(F.col("d") > F.date_sub("last", ANCHOR_DAYS)).groupBy("market").agg(F.avg("price").alias("anchor"))
    recent = days.join(last, "market").groupBy("market").agg(F.max("last").alias("last"), F.count_if(F.col("d") > F.date_sub("last", SHAPE_DAYS)).alias("n"))
    recent = recent.select("market", F.when(F.col("n") >= 180, F.date_sub("last", SHAPE_DAYS)).otherwise(F.lit("0001-01-01").cast("date")).alias("from"))
    yearly = days.groupBy("market", F.year("d").alias("year")).agg(F.avg("price").alias("mean"))
    change = yearly.select("market", (F.col("mean") / F.lag("mean").over(Window.partitionBy("market").orderBy("year")) - 1).alias("change"))
    decay = change.groupBy("market").agg(F.when(F.count("change") >= 2, F.greatest(F.lit(-0.10), F.least(F.lit(0.0), F.median("change")))).otherwise(F.lit(-0.03)).alias("decay"))
    month = shape_from(days).groupBy("market", F.month("d").alias("month")).agg(F.avg("price").alias("mean"))
    mean = F.avg("mean").over(Window.partitionBy("market"))
    month = month.select("market", "month", F.when(F.abs(mean) < 1.0, F.lit(1.0)).otherwise(F.col("mean") / mean).alias("share"))
    peak = shape_from(hours).groupBy("market", "month").agg(F.avg("price").alias("b"), F.avg(F.when(F.col("is_peak"), F.col("price"))).alias("p"))
    peak = peak.where("b > 0 AND p IS NOT NULL").select("market", "month", (F.col("p") / F.col("b")).alias("ratio"))
    years = last.join(anchor, "market").join(decay, "market").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_years - 1))))
    years = years.select("market", (F.year("last") + 1 + F.col("i")).alias("year"), (F.col("anchor") * F.pow(1 + F.col("decay"), F.col("i"))).alias("level"))
    grid = years.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))).join(month, ["market", "month"], "left").join(peak, ["market", "month"], "left")
    base = F.col("level") * F.coalesce("share", F.lit(1.0))
    grid = grid.select("market", "year", F.ceil(F.col("month") / 3).cast("int").alias("quarter"), "month", base.alias("base"), (base * F.coalesce("ratio", F.lit(PROXY_PEAK))).alias("peak"))
    none = F.lit(None).cast("int")
    quarters = grid.groupBy("market", "year", "quarter").agg(none.alias("month"), F.avg("base").alias("base"), F.avg("peak").alias("peak")).select(grid.columns)
    whole = years.select("market", "year", none.alias("quarter"), none.alias("month"), F.col("level").alias("base"), F.lit(None).cast("double").alias("peak"))
    return whole.unionByName(quarters).unionByName(grid.withColumn("quarter", none))
