"""Closed forms, invariants and brute-force checks of the operators."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fwdcurve.functions import calendar as cal
from fwdcurve.functions import timegrid as tg
from fwdcurve.operators import aggregates, curve, forecast, forwards, joins, quantiles, recurrence, shapes, trees, windows
from fwdcurve.sources import readers
from fwdcurve.streaming import jobs


def months_of(spark, year):
    rows = spark.createDataFrame([(dt.datetime(year - 1, 12, 31, 23), dt.datetime(year, 12, 31, 23))], "start timestamp_ntz, end timestamp_ntz")
    hours = tg.grid(rows, "1 HOUR").withColumn("local", tg.local_time(F.col("ts")))
    return {r["m"]: r["n"] for r in hours.groupBy(F.month("local").alias("m")).agg(F.count(F.lit(1)).alias("n")).collect()}


def test_delivery_hours_follow_daylight_saving_and_leap_years(spark):
    h2025, h2024 = months_of(spark, 2025), months_of(spark, 2024)
    assert (h2025[1], h2025[3], h2025[10], sum(h2025.values())) == (744, 743, 745, 8760)
    assert sum(h2024.values()) == 8784 and h2024[2] == 29 * 24


def test_easter_and_day_types(spark):
    years = spark.createDataFrame([(y,) for y in (1999, 2000, 2024, 2025, 2026)], "y int")
    found = [r[0] for r in years.select(cal.easter(F.col("y"))).collect()]
    assert found == [dt.date(1999, 4, 4), dt.date(2000, 4, 23), dt.date(2024, 3, 31), dt.date(2025, 4, 20), dt.date(2026, 4, 5)]
    days = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 10, 3),), (dt.date(2025, 8, 1),), (dt.date(2025, 7, 6),), (dt.date(2025, 7, 5),), (dt.date(2025, 7, 7),)], "d date")
    kinds = [tuple(r) for r in days.select(cal.day_type(F.col("d"), "CH"), cal.day_type(F.col("d"), "DE")).collect()]
    assert kinds == [("Ferie_CH", "Ferie_DE"), ("Ferie_DE", "Ferie_DE"), ("Ferie_CH", "Ferie_CH"), ("Dimanche",) * 2, ("Samedi",) * 2, ("Ouvrable",) * 2]


@pytest.mark.parametrize("key,want", [("2026", (2026, None, None, "Base")), ("2026-Q1", (2026, 1, None, "Base")), ("2026-03-Peak", (2026, None, 3, "Peak")), ("2026-13", None), ("Q1-2026", None), ("", None)])
def test_period_keys(spark, key, want):
    got = spark.createDataFrame([(key,)], "k string").select(tg.parse_key(F.col("k"))).first()[0]
    assert (tuple(got) if got else None) == want


def test_product_codes(spark):
    codes = ["Y01_2026_BASE", "Q04_2026_PEAK", "M12_2027_BASE", "Q05_2026_BASE", "X01_2026_BASE", None]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in codes], "c string").select(readers.product_code(F.col("c"))).collect()]
    assert [tuple(g) if g else None for g in got] == [("2026", "Base"), ("2026-Q4", "Peak"), ("2027-12", "Base"), None, None, None]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    new = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k int, v double")
    once = windows.upsert(old, new, ["k"])
    twice = windows.upsert(once, new, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, 1.0), (2, 20.0), (3, 30.0)]


def test_asof_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    left = [(str(k % 3), int(t)) for k, t in enumerate(rng.integers(0, 500, 200))]
    right = [(str(k % 3), int(t), float(v)) for k, (t, v) in enumerate(zip(rng.choice(500, 90, replace=False), rng.normal(size=90), strict=True))]
    got = windows.asof_backward(spark.createDataFrame(left, "k string, t int"), spark.createDataFrame(right, "k string, t int, v double"), "v", "t", ["k"])
    best = lambda k, t: max(((rt, v) for rk, rt, v in right if rk == k and rt <= t), default=(0, None))[1]
    assert sorted(((r["k"], r["t"], r["v"]) for r in got.collect()), key=str) == sorted(((k, t, best(k, t)) for k, t in left), key=str)


def test_asof_weekly_carries_over_missing_weeks(spark):
    weeks = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 22), 4.0)], "week date, fill double")
    days = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 20),), (dt.date(2024, 3, 1),)], "d date")
    got = {r["d"]: r["fill"] for r in joins.asof_weekly(days, weeks, "d", "week", "fill").collect()}
    assert list(got.values()) == [None, 1.0, 1.0, 4.0] or got == {dt.date(2023, 12, 31): None, dt.date(2024, 1, 1): 1.0, dt.date(2024, 1, 20): 1.0, dt.date(2024, 3, 1): 4.0}


def quotes_and_months(spark):
    months = pd.DataFrame([(2025, (m - 1) // 3 + 1, m, 24 * pd.Period(f"2025-{m:02d}").days_in_month, 200, 24 * pd.Period(f"2025-{m:02d}").days_in_month - 200) for m in range(1, 13)], columns=["year", "quarter", "month", "hours", "peak_hours", "offpeak_hours"])
    ratios = [("CH", "quarter", q, r) for q, r in enumerate(forwards.DEFAULT_QUARTER, 1)] + [("CH", "month", m, r) for m, r in enumerate(forwards.DEFAULT_MONTH, 1)]
    return spark.createDataFrame(months), spark.createDataFrame(ratios, "market string, kind string, no int, ratio double")


@pytest.mark.parametrize("known", [{}, {1: 80.0}, {1: 80.0, 2: 70.0, 3: 65.0}, {1: 80.0, 2: 70.0, 3: 65.0, 4: 90.0}])
def test_cascade_conserves_energy_and_keeps_quotes(spark, known):
    months, ratios = quotes_and_months(spark)
    rows = [("CH", 2025, None, None, 75.0)] + [("CH", 2025, q, None, p) for q, p in known.items()]
    quotes = spark.createDataFrame(rows, "market string, year int, quarter int, month int, price double")
    quarters = forwards.cascade_quarters(quotes, months, ratios)
    got = {r["quarter"]: (r["price"], r["hours"], r["derived"]) for r in quarters.collect()}
    assert all(got[q][0] == p and not got[q][2] for q, p in known.items())
    if len(known) < 4:
        assert abs(sum(p * h for p, h, _ in got.values()) / 8760 - 75.0) < 1e-9
    split = forwards.cascade_months(quarters, quotes, months, ratios)
    check = forwards.conservation(split, quarters.select("market", "year", "quarter", "price"), ["market", "year", "quarter"])
    assert check.where("NOT conserved").count() == 0


def curve_frame(days, seed=42):
    ts = pd.date_range("2025-01-01", periods=days * 96, freq="15min")
    price = 70 + 5 * np.sin(2 * np.pi * np.arange(len(ts)) / 96) + np.random.default_rng(seed).normal(size=len(ts))
    return pd.DataFrame({"curve_id": "c", "ts": ts, "is_peak": (ts.dayofweek < 5) & (ts.hour >= 8) & (ts.hour < 20), "price": price})


@pytest.mark.parametrize("contracts", [
    [("Jan", "2025-01-01", "2025-02-01", "Base", 75.0)],
    [("Jan", "2025-01-01", "2025-02-01", "Base", 80.0), ("Feb", "2025-02-01", "2025-03-01", "Base", 65.0)],
    [("JanP", "2025-01-01", "2025-02-01", "Peak", 90.0), ("JanO", "2025-01-01", "2025-02-01", "Offpeak", 66.0), ("Feb", "2025-02-01", "2025-03-01", "Base", 65.0)],
])
def test_calibration_reprices_contracts(spark, contracts):
    slots = spark.createDataFrame(curve_frame(59)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    table = spark.createDataFrame([("c", n, dt.datetime.fromisoformat(a), dt.datetime.fromisoformat(b), load, p) for n, a, b, load, p in contracts], "curve_id string, contract_id string, start timestamp_ntz, end timestamp_ntz, load string, price double")
    out = curve.calibrate(slots, table).toPandas()
    for _, a, b, load, p in contracts:
        part = out[(out.ts >= a) & (out.ts < b)]
        part = part if load == "Base" else part[part.is_peak == (load == "Peak")]
        assert abs(part.calibrated.mean() - p) < 0.01


def test_monotone_cubic_keeps_monotone_data_monotone(spark):
    knots = spark.createDataFrame([("a", float(x), y) for x, y in enumerate([1.0, 2.0, 2.0, 5.0, 9.0])], "key string, x double, y double")
    got = [r["slope"] for r in curve.monotone_slopes(knots, "key", "x", "y").orderBy("x").collect()]
    assert all(s >= 0 for s in got) and got[1] == got[2] == 0


def test_profiles_have_mean_one_and_bands_are_ordered(spark):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame(pd.DataFrame({"series": "s", "season": "Ete", "day_type": "Samedi", "hour": np.repeat(np.arange(24), 10), "price": rng.uniform(20, 80, 240), "w": 1.0}))
    profile = shapes.hourly_profile(rows)
    for table in (profile, shapes.smoothed(profile)):
        assert abs(table.agg(F.avg("f")).first()[0] - 1) < 1e-9
    every = shapes.with_fallback(profile)
    assert every.count() == 4 * 5 * 24 and every.where("f IS NULL").count() == 0
    bands = shapes.bootstrap_bands(rows.withColumn("row_id", F.monotonically_increasing_id()), ["hour"], "price")
    assert bands.where("p10 <= p50 AND p50 <= p90").count() == 24


@pytest.mark.parametrize("deviation,side", [(2.0, -1), (-2.0, 1)])
def test_fuller_reservoirs_lower_the_price(spark, deviation, side):
    from pyspark.sql import Window

    rows = spark.createDataFrame([("a", "Hiver", deviation)] + [("a", "Hiver", 0.0)] * 9, "k string, season string, dev double")
    got = [r[0] for r in rows.select(shapes.water_value(F.col("dev"), F.col("season"), Window.partitionBy("k"))).collect()]
    assert (got[0] - got[1]) * side > 0 and all(shapes.FLOOR <= f <= shapes.CAP for f in got)


def test_huber_ridge_and_elastic_net_recover_known_values():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(5, 1, 200), [500.0] * 5])
    assert abs(shapes.huber_location(x) - 5) < 0.3
    a = rng.normal(size=(300, 3))
    y = a @ [1.0, -2.0, 0.5] + 4 + rng.normal(0, 0.01, 300)
    coef, b = shapes.ridge(a, y)
    assert np.allclose(coef, [1, -2, 0.5], atol=0.01) and abs(b - 4) < 0.01
    coef, b = forecast.elastic_net(a, y, 1e-4)
    assert np.allclose(coef, [1, -2, 0.5], atol=0.01) and abs(b - 4) < 0.01


def test_window_fits_equal_single_elastic_nets():
    rng = np.random.default_rng(8)
    samples = []
    for n in (42, 90, 365):
        x = rng.normal(size=(n, 7)) * [1, 5, 0.1, 1, 1, 1, 0] + [0, 3, 0, 0, 0, 0, 1]
        samples.append((x, 40 + x[:, 0] * 3 - x[:, 1] + rng.normal(size=n)))
    for (x, y), (coef, intercept, mu, sd) in zip(samples, forecast.window_fits(samples), strict=True):
        z = np.arcsinh((y - y.mean()) / y.std())
        a = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 1e-12, x.std(axis=0), 1)
        c, i = forecast.elastic_net(a, z, forecast.best_penalty(a, z))
        assert abs(mu - y.mean()) < 1e-9 and abs(sd - y.std()) < 1e-9
        assert np.allclose(x @ coef + intercept, a @ c + i, atol=2e-3)


def test_hourly_forecasts_learn_a_rule(spark):
    rng = np.random.default_rng(9)
    d = pd.date_range("2020-01-01", periods=460)
    rows = pd.concat([pd.DataFrame({"market": "A", "d": d.date, "hour": np.int32(h), "x": (x := rng.normal(size=460)), "u": rng.normal(size=460), "price": 50 + h + 6 * x}) for h in (0, 7)])
    table = spark.createDataFrame(rows)
    models = forecast.hourly_fits(table, (42, 365), ["x", "u"])
    cutoffs = [str(r[0]) for r in models.select("cutoff").distinct().orderBy("cutoff").collect()]
    assert cutoffs == ["2021-01-01", "2021-02-01", "2021-03-01", "2021-04-01", "2021-04-05"] and models.count() == 5 * 2 * 2
    found = forecast.hourly_forecasts(table.withColumn("cutoff", F.to_date(F.date_trunc("month", "d"))), models, ["x", "u"]).toPandas()
    assert len(found) == 2 * (460 - 366) and (found["forecast"] - found["price"]).abs().mean() < 1.0


def test_bands_widen_with_the_days_ahead(spark):
    rows = spark.createDataFrame([(4.0, 30, 50.0, 1), (4.0, 30, 50.0, 5), (None, 0, -50.0, 2)], "w double, n int, f double, a int")
    got = [r[0] for r in rows.select(forecast.conformal_half(*(F.col(c) for c in "wnfa"))).collect()]
    assert np.allclose(got, [4.0, 4.8, 1.28 * 50 * 0.07])


def test_recurrence_uses_corrected_errors(spark):
    rows = spark.createDataFrame([("a", k, 10.0, 8.0) for k in range(3)], "k string, d int, forecast double, actual double")
    got = [r["corrected"] for r in recurrence.corrected(rows, ["k"], "d").orderBy("d").collect()]
    second = 10.0 - 0.6 * 2.0
    assert np.allclose(got, [10.0, second, 10.0 - 0.6 * (second - 8.0) - 0.15 * 2.0])


def test_recurrence_skips_missing_days_and_clamps(spark):
    pairs = [(10.0, 8.0), (10.0, None), (10.0, 9.0), (None, 9.0), (400.0, 100.0), (10.0, 10.0), (10.0, 10.0)]
    rows = spark.createDataFrame([("a", k, f, a) for k, (f, a) in enumerate(pairs)], "k string, d int, forecast double, actual double")
    got = recurrence.corrected(rows, ["k"], "d").orderBy("d").toPandas()
    e0, third = 2.0, 10.0 - 0.15 * 2.0
    e2 = third - 9.0
    fifth = 400.0 - 0.15 * e2
    e4 = fifth - 100.0
    sixth = 10.0 - 0.6 * 100.0 - 0.7 * (e0 + e2 + e4) / 3
    e5 = sixth - 10.0
    seventh = 10.0 + 0.6 * 100.0 - 0.15 * 100.0 - 0.7 * (e0 + e2 + e4 + e5) / 4
    assert np.allclose(got["corrected"].astype(float), [10.0, 10.0 - 1.2, third, np.nan, fifth, sixth, seventh], equal_nan=True)
    assert got["error"].isna().tolist() == [False, True, False, True, False, False, False]


def test_welch_on_equal_halves_is_zero(spark):
    rows = spark.createDataFrame([("a", h, float(v)) for h in (0, 1) for v in (1, 2, 3)], "k string, half int, v double")
    r = aggregates.welch(rows, ["k"], "half", "v").first()
    assert r["t"] == 0 and abs(r["df"] - 4) < 1e-9


@pytest.mark.parametrize("t,df,p", [(2.228139, 10, 0.05), (0.0, 5, 1.0), (12.7062, 1, 0.05), (1.959964, 1e7, 0.05), (3.169273, 10, 0.01)])
def test_p_values_of_the_t_distribution(t, df, p):
    assert abs(aggregates.incomplete_beta(df / (df + t * t), df / 2, 0.5) - p) < 1e-5


def test_restored_months_keep_their_means(spark, tmp_path):
    days = pd.date_range("2024-01-01", "2024-12-31")
    level = {m: 50 + 20 * np.sin(m) for m in range(1, 13)}
    rows = spark.createDataFrame(pd.DataFrame({"key": "a", "d": days.date, "price": [level[d.month] for d in days]}))
    monthly = rows.groupBy("key", F.to_date(F.date_trunc("month", "d")).alias("month_start")).agg(F.avg("price").alias("base"))

    def settle(table, k):
        table.write.parquet(f"{tmp_path}/{k}")
        return spark.read.parquet(f"{tmp_path}/{k}")

    got = curve.restored_months(rows, monthly, settle).groupBy(F.month("d").alias("m")).agg(F.avg("smooth").alias("s")).collect()
    plain = curve.smooth_base(rows, monthly).groupBy(F.month("d").alias("m")).agg(F.avg("smooth").alias("s")).collect()
    worst = lambda rows_: max(abs(r["s"] - level[r["m"]]) for r in rows_)
    assert worst(got) < 1.0 and worst(got) < worst(plain)


def test_calibration_query_covers_all_years_and_reprices_all_contracts(spark, sf_dir):
    from fwdcurve.plans import bindings, curve_plans

    t = bindings.Tables(spark, sf_dir)
    out = curve_plans.crv8(t).withColumn("at", F.col("ts").cast("timestamp_ntz")).toPandas()
    slots = curve_plans.curve_slots(t).toPandas()
    assert len(out) == len(slots) and out["at"].dt.year.nunique() >= 6
    out = out.merge(slots[["curve_id", "ts", "is_peak"]], left_on=["curve_id", "at"], right_on=["curve_id", "ts"])
    met = curve_plans.curve_contracts(t, curve_plans.curve_slots(t)).toPandas()
    assert set(met["load"]) == {"Base", "Peak", "Offpeak"} and met["contract_id"].str.len().nunique() >= 3
    for c in met.itertuples():
        part = out[(out.curve_id == c.curve_id) & (out["at"] >= c.start) & (out["at"] < c.end)]
        part = part if c.load == "Base" else part[part.is_peak == (c.load == "Peak")]
        assert part.empty or abs(part.calibrated.mean() - c.price) < 0.01


def dense_knots(stats, targets, eps=1e-8, tie=1e-6):
    """The same minimum by one dense system of all knots and contracts."""
    days = np.arange(stats["day"].min(), stats["day"].max() + 2)
    k, m, ids = len(days), len(targets), targets["contract_id"].tolist()
    d2, a = np.diff(np.eye(k), 2, axis=0), np.zeros((m, 2 * k))
    for c, day, peak, n, w1 in stats[["contract_id", "day", "is_peak", "n", "w1"]].itertuples(index=False):
        at = int(day - days[0]) + (0 if peak else k)
        a[ids.index(c), at] += n - w1
        a[ids.index(c), at + 1] += w1
    a /= a.sum(axis=1, keepdims=True)
    h = np.kron(np.eye(2), d2.T @ d2 + (eps + tie) * np.eye(k)) - tie * np.kron(np.array([[0, 1], [1, 0]]), np.eye(k))
    system = np.block([[h, a.T], [a, np.zeros((m, m))]])
    return np.linalg.solve(system, np.concatenate([np.zeros(2 * k), targets["gap"]]))[: 2 * k].reshape(2, k)


def test_banded_knots_equal_the_dense_solution():
    rng = np.random.default_rng(2)
    rows = [(c, d, peak, 4.0, float(w)) for c, (a, b) in {"q1": (0, 90), "q2": (90, 181), "m1": (0, 31), "y": (0, 365)}.items() for d in range(a, b) for peak in (True, False) for w in [rng.random()] if c != "m1" or peak]
    stats = pd.DataFrame(rows, columns=["contract_id", "day", "is_peak", "n", "w1"])
    gaps = pd.DataFrame({"contract_id": ["q1", "q2", "m1", "y"], "gap": [3.0, -2.0, 5.0, 1.0]})
    got, want = curve.solve_knots(stats, gaps), dense_knots(stats, gaps)
    for r, peak in enumerate((True, False)):
        assert np.allclose(got[got.is_peak == peak].sort_values("day")["knot"], want[r], atol=1e-4)


@pytest.mark.parametrize("multiplicative", [False, True])
def test_calibration_falls_back_and_keeps_a_least_factor(spark, multiplicative):
    ts = pd.date_range("2024-01-01", periods=60, freq="D")
    rows = pd.concat([pd.DataFrame({"curve_id": c, "ts": ts, "is_peak": True, "price": 40.0}) for c in ("fine", "torn", "low")])
    slots = spark.createDataFrame(rows).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    a, b = pd.Timestamp("2024-01-01"), pd.Timestamp("2024-03-01")
    deals = [("fine", "x", 50.0), ("torn", "x", 500.0), ("torn", "y", 0.0), ("low", "x", 1.0)]
    deals = pd.DataFrame([(c, i, a, b, "Base", p) for c, i, p in deals], columns=["curve_id", "contract_id", "start", "end", "load", "price"])
    deals = spark.createDataFrame(deals).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
    got = {r["curve_id"]: r["m"] for r in curve.calibrate(slots, deals, multiplicative).groupBy("curve_id").agg(F.avg("calibrated").alias("m")).collect()}
    assert abs(got["fine"] - 50) < 1e-6 and got["torn"] == 40 and abs(got["low"] - (4 if multiplicative else 1)) < 1e-6


def test_quarter_fallback_walks_the_chain(spark):
    cells = spark.createDataFrame([("s", "Hiver", d, 5) for d in ("Ferie_DE", "Samedi", "Ouvrable")] + [("s", "Ete", "Dimanche", 5), ("s", "Ete", "Dimanche", 6)], "series string, season string, day_type string, hour int")
    base = [("s", "Hiver", "Dimanche", 5, q, 1.0 + q / 10) for q in range(1, 5)] + [("s", "Automne", "Ouvrable", 5, q, 2.0 + q / 10) for q in range(1, 5)]
    got = shapes.quarter_fallback(cells, spark.createDataFrame(base, "series string, season string, day_type string, hour int, quarter int, f double"))
    first = {(r["season"], r["day_type"], r["hour"]): r["f"] for r in got.where("quarter = 1").collect()}
    assert first == {("Hiver", "Ferie_DE", 5): 1.1, ("Hiver", "Samedi", 5): 2.1, ("Hiver", "Ouvrable", 5): 2.1, ("Ete", "Dimanche", 5): 2.1, ("Ete", "Dimanche", 6): 1.0} and got.count() == 20


def test_water_fit_finds_known_betas_and_defaults(spark):
    rng = np.random.default_rng(3)
    months = pd.date_range("2015-01-01", periods=72, freq="MS")
    dev = rng.normal(size=72)
    of = np.array([{"Hiver": -6.0, "Printemps": -3.0, "Ete": -1.0, "Automne": -4.0}[s] for s in shapes.calendar_season(pd.Series(months))])
    price = 100 + 5 * np.arange(72) / 71 + of * dev
    price += 100 - price.mean()
    table = pd.DataFrame({"market": "A", "month": months.date, "p": price, "dev": dev})
    table = pd.concat([table, table.head(11).assign(market="B")])
    got = {r["market"]: r for r in shapes.water_fit(shapes.water_design(spark.createDataFrame(table))).collect()}
    n = {s: (shapes.calendar_season(pd.Series(months)) == s).mean() for s in ("Hiver", "Printemps", "Ete", "Automne")}
    beta = -(0.06 * n["Hiver"] + 0.03 * n["Printemps"] + 0.01 * n["Ete"] + 0.04 * n["Automne"])
    assert abs(got["A"]["beta"] - beta) < 2e-3 and abs(got["A"]["hiver"] - max(-2.0, 0.06 / beta)) < 0.05
    assert (got["B"]["beta"], got["B"]["hiver"], got["B"]["months"]) == (shapes.BETA, shapes.SENSITIVITY["Hiver"], 11)


def test_state_of_a_stream_is_compacted(spark, tmp_path):
    path = f"{tmp_path}/state"
    merge = jobs.keep_last_into(path, ["k"], ["v"], compact=3)
    for batch in range(8):
        rows = spark.createDataFrame([(batch % 4, batch), (99, -batch)], "k int, v int")
        merge(rows, batch)
        merge(rows, batch)
    got = {r["k"]: r["v"] for r in jobs.latest(spark, path, ["k"], ["v"]).collect()}
    assert got == {0: 4, 1: 5, 2: 6, 3: 7, 99: 0}
    assert spark.read.parquet(f"{path}/base=2").select("batch").distinct().count() == 2


def test_stale_series_raise_an_alert(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00", 1.0), ("b", "2024-01-01 09:00:00", 2.0), ("b", "2024-01-01 10:00:00", None)], "series string, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    jobs.gate_into(f"{tmp_path}/gate")(rows, 0)
    got = {r["series"]: (r["stale"], r["ok"]) for r in spark.read.parquet(f"{tmp_path}/gate").collect()}
    assert got == {"a": (True, False), "b": (False, False)}


def test_sources_that_cannot_be_read_count_as_empty(spark, tmp_path):
    (tmp_path / "bad.parquet").mkdir()
    (tmp_path / "bad.parquet" / "part.parquet").write_bytes(b"no parquet at all, but long enough for a footer")
    (tmp_path / "none.parquet").mkdir()
    for name in ("bad", "none", "absent"):
        with pytest.warns(UserWarning):
            assert readers.optional(spark, f"{tmp_path}/{name}.parquet", "a long, b string").columns == ["a", "b"]
    spark.createDataFrame([(1, 2.5)], "a int, c double").write.parquet(f"{tmp_path}/some.parquet")
    got = readers.optional(spark, f"{tmp_path}/some.parquet", "a long, b string")
    assert got.dtypes == [("a", "bigint"), ("b", "string")] and [tuple(r) for r in got.collect()] == [(1, None)]


def test_weeks_are_met_within_keys(spark):
    weeks = spark.createDataFrame([("x", "2024-01-01", 1.0), ("y", "2024-01-08", 2.0), ("x", "2024-01-15", 3.0)], "k string, w string, v double").withColumn("w", F.col("w").cast("date"))
    left = spark.createDataFrame([("x", "2024-01-09"), ("y", "2024-01-09"), ("y", "2024-01-03"), ("x", "2024-01-30")], "k string, d string").withColumn("d", F.col("d").cast("date"))
    got = {(r["k"], str(r["d"])): r["v"] for r in joins.asof_weekly(left, weeks, "d", "w", "v", ("k",)).collect()}
    assert got == {("x", "2024-01-09"): 1.0, ("y", "2024-01-09"): 2.0, ("y", "2024-01-03"): None, ("x", "2024-01-30"): 3.0}


def test_implied_contracts_change_no_knot():
    stats = pd.DataFrame([(c, d, True, 1.0, 0.0) for c, days in (("a", range(3)), ("b", range(3, 6)), ("both", range(6))) for d in days], columns=["contract_id", "day", "is_peak", "n", "w1"])
    gaps = pd.DataFrame({"contract_id": ["a", "b", "both"], "gap": [1.0, 3.0, 2.0]})
    one, two = (curve.solve_knots(stats[stats.contract_id.isin(g.contract_id)], g) for g in (gaps, gaps[:2]))
    assert np.allclose(one["knot"], two["knot"], atol=1e-5)


def priced(spark, tmp_path, days=800, first="1990-03-10"):
    """orders and lineitem whose dates end before 2000: two markets of daily prices."""
    d = pd.date_range(first, periods=days)
    value = 1000 * (50 + 10 * np.sin(np.arange(days) / 9) + np.random.default_rng(1).normal(size=days))
    spark.createDataFrame(pd.DataFrame({"o_orderdate": d, "o_totalprice": value})).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(pd.DataFrame({"l_shipdate": d, "l_extendedprice": value + 500})).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/lineitem.parquet")
    return d


def test_backtest_rolls_over_all_months_of_any_years(spark, tmp_path):
    from fwdcurve.plans import bindings, forecast_plans

    d, t = priced(spark, tmp_path, 450), bindings.Tables(spark, str(tmp_path))
    cutoffs = [str(x.date()) for x in pd.date_range("1991-04-01", d[-1], freq="MS")]
    models = forecast_plans.fct3(t).toPandas()
    assert sorted(models["cutoff"].unique()) == cutoffs and len(models) == 2 * 5 * len(cutoffs)
    want = [str(x.date()) for x in d if str(x.date()) >= cutoffs[0]]
    for query in (forecast_plans.fct4, forecast_plans.fct8, forecast_plans.fct9):
        got = query(t).toPandas()
        assert sorted(got["d"]) == sorted(want * 2) and got["forecast"].notna().all()
    ahead = forecast_plans.fct8(t).where("d = '1991-05-31'").toPandas()["days_ahead"]
    assert ahead.tolist() == [31, 31]
    # a fit sees the days before its cutoff alone
    train, test = forecast_plans.rolling(t)
    spans = train.groupBy("market", "cutoff").agg(F.min("d").alias("a"), F.max("d").alias("b")).toPandas()
    assert all(b == c - dt.timedelta(1) and a >= c - dt.timedelta(365) for a, b, c in zip(spans.a, spans.b, spans.cutoff, strict=True))
    assert test.where("d < cutoff OR d >= add_months(cutoff, 1)").isEmpty()


def test_monthly_folds_train_on_24_months(spark, tmp_path):
    from fwdcurve.plans import bindings, forecast_plans

    d = priced(spark, tmp_path)
    got = forecast_plans.val1b(bindings.Tables(spark, str(tmp_path))).where("market = 'CH'").orderBy("fold").toPandas()
    months = pd.date_range("1992-04-01", d[-1], freq="MS")
    assert got["fold"].tolist() == [str(m.date()) for m in months]
    assert got["n"].tolist() == [int(((d >= m) & (d < m + pd.offsets.MonthBegin())).sum()) for m in months]
    price = spark.read.parquet(f"{tmp_path}/orders.parquet").toPandas().set_index("o_orderdate").sort_index()["o_totalprice"] / 1000
    assert abs(got["level"][0] - price["1990-04-01":"1992-03-31"].mean()) < 1e-5


def brute_tree(bins, g, known, depth, node=0, rows=None):
    """Leaf of every row of a tree over binned columns, and the leaves' means."""
    rows = np.arange(len(g)) if rows is None else rows
    mine = rows[known[rows]]
    best = (1e-12, 0, 0)
    for j in range(bins.shape[1] if depth else 0):
        for cut in np.unique(bins[mine, j]):
            left = bins[mine, j] <= cut
            n = left.sum()
            if 0 < n < len(mine):
                gain = n * (len(mine) - n) / len(mine) * (g[mine][left].mean() - g[mine][~left].mean()) ** 2
                if gain > best[0] * (1 + 1e-12):
                    best = (gain, j, cut)
    if best[0] <= 1e-12:
        return {int(r): g[mine].mean() for r in rows}
    left = bins[rows, best[1]] <= best[2]
    return brute_tree(bins, g, known, depth - 1, 0, rows[left]) | brute_tree(bins, g, known, depth - 1, 0, rows[~left])


def test_boosted_trees_of_all_groups_equal_brute_force(spark, tmp_path):
    rng, rows = np.random.default_rng(6), []
    for group, n in (("a", 240), ("b", 90), ("none", 5)):
        x = rng.normal(size=(n, 3))
        x[:, 2] = np.round(x[:, 2])
        y = np.where(x[:, 0] > 0.3, 5.0, 1.0) + 2 * (x[:, 2] > 0) + 0.1 * rng.normal(size=n)
        rows += [(group, k, *map(float, v), None if group == "none" or k % 5 == 0 else float(t)) for k, (v, t) in enumerate(zip(x, y, strict=True))]
    table = spark.createDataFrame(rows, "key string, k int, a double, b double, c double, y double").repartition(4)
    count = iter(range(1000))

    def settle(df):
        df.write.parquet(path := f"{tmp_path}/{next(count)}")
        return spark.read.schema(df.schema).parquet(path)

    got = trees.boosted(table, ["key"], ["a", "b", "c"], "y", settle, rounds=4, depth=3, bins=8).toPandas()
    assert set(got["key"]) == {"a", "b"} and not any(c.startswith("_") for c in got.columns)
    for group, part in got.groupby("key"):
        part = part.sort_values("k").reset_index(drop=True)
        x, y = part[["a", "b", "c"]].to_numpy(), part["y"].to_numpy()
        known = ~np.isnan(y)
        edges = [np.unique(np.quantile(x[known, j], np.arange(1, 8) / 8, method="inverted_cdf")) for j in range(3)]
        bins = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
        fitted = np.zeros(len(y))
        for k in range(4):
            g = y if k == 0 else 2 * (y - fitted)
            leaves = brute_tree(bins, g, known, 3)
            fitted = fitted + (1.0 if k == 0 else 0.1) * np.array([leaves[i] for i in range(len(y))])
        assert np.allclose(part["prediction"], fitted), group
        assert np.corrcoef(part["prediction"][~known], np.where(x[~known, 0] > 0.3, 5.0, 1.0) + 2 * (x[~known, 2] > 0))[0, 1] > 0.9


@pytest.mark.parametrize("limit", [1, 20, 10**6])
def test_quantiles_of_long_series_equal_sorting(spark, tmp_path, limit):
    rng = np.random.default_rng(7)
    series = {"plain": rng.normal(size=700), "ties": rng.integers(0, 4, 500).astype(float), "far": np.append(rng.random(300), 1e12), "one": np.array([3.0]), "two": np.array([1.0, 2.0])}
    rows = [(s, float(v)) for s, x in series.items() for v in x] + [("ties", None), ("empty", None)]
    shares, count = [0.0, 0.01, 0.333, 0.5, 0.999, 1.0], iter(range(1000))

    def settle(df):
        df.write.parquet(path := f"{tmp_path}/{next(count)}")
        return spark.read.schema(df.schema).parquet(path)

    got = quantiles.exact_quantiles(spark.createDataFrame(rows, "s string, v double").repartition(3), ["s"], "v", shares, settle, limit=limit, bins=16)
    got = {r["s"]: r["q"] for r in got.collect()}
    assert set(got) == set(series)
    for s, x in series.items():
        assert np.allclose(got[s], np.quantile(x, shares), rtol=1e-12), s


def test_payloads_are_split_by_hour_and_part(spark, sf_dir):
    from fwdcurve.plans import bindings, source_plans

    t = bindings.Tables(spark, sf_dir)
    hours = t.events.select("event_type", F.date_trunc("hour", "ts")).distinct().count()
    sizes = source_plans.payload(t).select(F.length("body").alias("n")).toPandas()["n"]
    assert len(sizes) >= hours and sizes.max() < sizes.sum() / 20


def test_last_event_of_a_second_wins_across_bodies(spark):
    bodies = [("a", '{"unix_seconds":[5],"event_id":[9],"price":[1.0]}'), ("a", '{"unix_seconds":[5,5],"event_id":[3,4],"price":[2.0,3.0]}'), ("b", '{"unix_seconds":[5,5],"price":[2.0,3.0]}')]
    rows = readers.price_payload(spark.createDataFrame(bodies, "series string, body string"), "1970-01-01", "1970-01-02")
    assert {r["series"]: r["price"] for r in rows.collect()} == {"a": 1.0, "b": 3.0}
