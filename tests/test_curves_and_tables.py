"""The 15-minute curve, load types, stored upserts, keyed state, expanding backtests, breaks, autocorrelations."""

import datetime as dt
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fwdcurve.operators import aggregates, curve, forecast, forwards, shapes, windows
from fwdcurve.plans import curve_plans, forecast_plans, registry, slot_plans
from fwdcurve.plans.bindings import Tables
from fwdcurve.sources import readers, upserts, writers
from fwdcurve.streaming import jobs, state
from twins import agree

COLUMNS = ["price_shape", "f_s", "f_w", "f_h", "f_q", "f_wv", "profile_type", "confidence", "p10", "p90", "calibrated"]


def test_the_curve_reprices_its_contracts_on_slots(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    slot_plans.full_curve(t).write.parquet(f"{tmp_path}/curve")
    rows = spark.read.parquet(f"{tmp_path}/curve")
    assert set(COLUMNS) <= set(rows.columns) and rows.where("price_shape IS NULL OR p10 > price_shape OR p90 < price_shape").count() == 0
    found = t.settled("slot_contracts", lambda: None)
    met = rows.join(found, "curve_id").where("ts >= start AND ts < end AND (load = 'Base' OR (load = 'Peak') = is_peak)")
    misses = met.groupBy("curve_id", "contract_id").agg(F.abs(F.avg("price_shape") - F.first("price")).alias("miss"))
    assert misses.count() == found.count() > 20 and misses.agg(F.max("miss")).first()[0] < 1e-6
    assert {r["load"] for r in found.select("load").distinct().collect()} == {"Base", "Peak", "Offpeak"}
    assert rows.select("curve_id", "calibrated").distinct().count() == rows.select("curve_id").distinct().count()
    # factors keep their level: months, days and hours
    slots = t.settled("slots", lambda: None)
    for factor, keys in (("f_w", ["curve_id", "month"]), ("f_h", ["curve_id", "d"]), ("f_q", ["curve_id", "d", "hour", F.hour("ts").alias("h")])):
        assert slots.groupBy(*keys).agg(F.abs(F.avg(factor) - 1).alias("off")).agg(F.max("off")).first()[0] < 1e-9


def test_a_curve_that_misses_a_contract_keeps_its_price_and_says_so(spark):
    hours = [(c, dt.datetime(2024, 1, 1) + dt.timedelta(hours=k), k % 24 in range(8, 20), 50.0) for c in ("met", "missed", "free") for k in range(240)]
    slots = spark.createDataFrame(hours, "curve_id string, ts timestamp_ntz, is_peak boolean, price double")
    a, b, c = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 6)
    contracts = [("met", "x", a, b, "Base", 60.0), ("met", "y", a, c, "Peak", 70.0), ("missed", "x", a, b, "Base", 60.0), ("missed", "z", a, b, "Base", 400.0)]
    table = spark.createDataFrame(contracts, "curve_id string, contract_id string, start timestamp_ntz, end timestamp_ntz, load string, price double")
    got = curve.calibrate(slots, table, flag="met").groupBy("curve_id").agg(F.avg("calibrated").alias("mean"), F.bool_and(F.coalesce("met", F.lit(False))).alias("met"), F.max(F.abs(F.col("calibrated") - F.col("price"))).alias("move"))
    got = {r["curve_id"]: r for r in got.collect()}
    assert got["met"]["met"] and abs(got["met"]["mean"] - 60) < 1e-6
    assert not got["missed"]["met"] and got["missed"]["move"] == 0 and not got["free"]["met"] and got["free"]["move"] == 0


def test_slots_lie_on_the_cubic_of_their_own_time(spark):
    months = [(dt.date(2023 + k // 12, k % 12 + 1, 1), 40 + 10 * np.sin(k / 2)) for k in range(18)]
    monthly = spark.createDataFrame([("a", d, float(v)) for d, v in months], "key string, month_start date, base double")
    slots = [("a", dt.datetime(2023, 1, 1) + dt.timedelta(minutes=15 * 37 * k)) for k in range(1300)]
    rows = curve.smooth_slots(spark.createDataFrame(slots, "k string, at timestamp_ntz"), monthly, "k", "at").orderBy("at").toPandas()
    assert len(rows) == len(slots) and rows["smooth"].notna().all()
    epoch = dt.datetime(1970, 1, 1)
    x = np.array([(dt.datetime.combine(d, dt.time()) - epoch).days + pd.Period(d, "M").days_in_month / 2 for d, _ in months])
    at = np.array([(a - epoch).total_seconds() / 86400 for a in rows["at"]])
    knots = curve.monotone_slopes(spark.createDataFrame([("a", float(p), float(v)) for p, (_, v) in zip(x, months, strict=True)], "key string, x double, y double"), "key", "x", "y").orderBy("x").toPandas()
    y, m = knots["y"].to_numpy(), knots["slope"].to_numpy()
    i = np.clip(np.searchsorted(x, at, side="right") - 1, 0, len(x) - 2)
    h = x[i + 1] - x[i]
    s = (at - x[i]) / h
    want = (2 * s**3 - 3 * s**2 + 1) * y[i] + (s**3 - 2 * s**2 + s) * h * m[i] + (3 * s**2 - 2 * s**3) * y[i + 1] + (s**3 - s**2) * h * m[i + 1]
    assert np.abs(rows["smooth"].to_numpy() - want).max() < 1e-8


def test_peak_and_offpeak_make_up_base_in_every_period(spark, sf_dir):
    t = Tables(spark, sf_dir)
    months = curve_plans.load_months(t).toPandas()
    assert not months[["base", "peak", "offpeak"]].isna().any().any()
    for keys in (["market", "year", "quarter", "month"], ["market", "year", "quarter"], ["market", "year"]):
        for _, g in months.groupby(keys):
            rest = g["hours"] - g["peak_hours"]
            assert abs((g["base"] * g["hours"]).sum() - (g["peak"] * g["peak_hours"]).sum() - (g["offpeak"] * rest).sum()) < 1e-6 * g["hours"].sum()
    quoted = curve_plans.peak_quotes(t).toPandas()
    for _, q in quoted.iterrows():
        part = months[(months.market == q.market) & (months.year == q.year)]
        part = part[part.month == q.month] if not np.isnan(q.month) else part[part.quarter == q.quarter] if not np.isnan(q.quarter) else part
        assert abs((part["peak"] * part["peak_hours"]).sum() / part["peak_hours"].sum() - q.peak) < 1e-6
    synthetic = curve_plans.load_quotes(t)
    assert synthetic.where("peak IS NULL").count() == 0 and synthetic.where("NOT synthetic").count() > 0


def test_missing_ratios_take_the_default(spark):
    ratios = forwards.period_ratios(spark.createDataFrame([("A", 1, 1.2)], "market string, month int, ratio double"), spark.createDataFrame([("A",), ("B",)], "market string"))
    got = {(r["market"], r["quarter"], r["month"]): r["ratio"] for r in ratios.collect()}
    assert len(got) == 2 * 17 and got["A", None, 1] == 1.2 and abs(got["A", 1, None] - (1.2 + 2 * 1.05) / 3) < 1e-12 and got["B", None, None] == pytest.approx(1.05)


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_upserts_write_only_the_partitions_they_change(spark, tmp_path):
    path, schema = f"{tmp_path}/table", "k int, v double, m string"
    first = [(k, float(k), f"m{k % 3}") for k in range(30)] + [(100, None, None)]
    assert upserts.upsert_stored(spark.createDataFrame(first, schema), path, ["k"], "m") == [None, "m0", "m1", "m2"]
    before = files_of(path)
    time.sleep(0.01)
    same = [(0, 0.0, "m0"), (4, 4.0, "m1"), (100, None, None)]
    assert upserts.upsert_stored(spark.createDataFrame(same, schema), path, ["k"], "m") == [] and files_of(path) == before
    batch = spark.createDataFrame([(1, -1.0, "m1"), (4, 4.0, "m1"), (40, 40.0, "m1"), (3, 3.0, "m0"), (100, 1.0, None)], schema)
    assert upserts.upsert_stored(batch, path, ["k"], "m") == [None, "m1"]
    after = files_of(path)
    kept = {f: s for f, s in before.items() if "m=m0" in f or "m=m2" in f}
    assert {f: s for f, s in after.items() if f in kept} == kept and len(kept) == 2
    assert upserts.upsert_stored(batch, path, ["k"], "m") == [] and files_of(path) == after
    rows = {r["k"]: (r["v"], r["m"]) for r in spark.read.schema(schema).parquet(path).collect()}
    want = {k: (v, m) for k, v, m in first} | {1: (-1.0, "m1"), 40: (40.0, "m1"), 100: (1.0, None)}
    assert rows == want
    # a new partition, and of equal keys in a batch the newest
    later = spark.createDataFrame([(200, 1.0, "m9"), (200, 2.0, "m9")], schema)
    assert upserts.upsert_stored(later, path, ["k"], "m", [F.desc("v")]) == ["m9"]
    assert spark.read.schema(schema).parquet(path).where("k = 200").first()["v"] == 2.0


def messages(spark, folder, rows):
    table = spark.createDataFrame([(i, r, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), v, c) for i, r, h, v, c in rows], MESSAGE.replace("timestamp", "timestamp_ntz"))
    table.coalesce(1).write.mode("append").parquet(folder)


MESSAGE = "id long, revision long, ts timestamp, value double, cancelled boolean"


def test_revisions_out_of_order_late_cancelled_restarted_and_forgotten(spark, tmp_path):
    session, folder, out = state.stateful_session(spark), f"{tmp_path}/feed", f"{tmp_path}/changes"

    def drain():
        stream = session.readStream.schema(MESSAGE).parquet(folder)
        jobs.run(state.latest_revisions(stream, "1 hour", keep_ms=48 * 3_600_000), f"{tmp_path}/checkpoint", each=jobs.keep_last_into(out, ["id"], ["revision"]))
        return {r["id"]: (r["revision"], r["value"], r["withdrawn"]) for r in jobs.latest(spark, out, ["id"], ["revision"]).collect()}

    messages(spark, folder, [(1, 2, 5, 2.0, False), (1, 1, 4, 1.0, False), (2, 1, 1, 5.0, False), (3, 7, 2, 1.0, True)])
    assert drain() == {1: (2, 2.0, False), 2: (1, 5.0, False), 3: (7, 1.0, True)}
    # a restart from the checkpoint: an older revision and a repeat change nothing, a withdrawn message stays withdrawn
    messages(spark, folder, [(1, 1, 6, 9.0, False), (1, 2, 6, 9.0, False), (3, 6, 6, 9.0, False), (2, 3, 6, 6.0, True), (4, 1, 6, 4.0, False)])
    assert drain() == {1: (2, 2.0, False), 2: (3, 6.0, True), 3: (7, 1.0, True), 4: (1, 4.0, False)}
    # four days on, all that was known has left the state
    messages(spark, folder, [(5, 1, 100, 1.0, False)])
    drain()
    messages(spark, folder, [(6, 1, 101, 1.0, False)])
    drain()
    left = session.read.format("statestore").option("stateVarName", "newest").load(f"{tmp_path}/checkpoint")
    assert {r["key"]["id"] for r in left.collect()} <= {5, 6}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != state.ROCKSDB


def test_running_sums_equal_refits(spark, sf_dir):
    t = Tables(spark, sf_dir)
    hours = forecast_plans.market_hours(t).where("market = 'CH' AND d < DATE '1996-12-01'").toPandas()
    hours["d"] = pd.to_datetime(hours["d"])
    table = spark.createDataFrame(hours.assign(d=hours["d"].dt.date), "market string, d date, hour int, price double")
    found = forecast.expanding_profiles(table).toPandas()
    found[["d", "fold"]] = found[["d", "fold"]].apply(pd.to_datetime)
    folds = sorted(found["fold"].unique())
    assert len(folds) > 5
    for fold in folds[:: len(folds) // 5]:
        train, test = hours[hours.d < fold], found[found.fold == fold]
        assert set(test.d.dt.to_period("M")) == {pd.Timestamp(fold).to_period("M")} and len(train) >= 720
        level = train.price.mean()
        base = train[train.d >= fold - pd.Timedelta(days=30)].price.mean()
        cells = train.groupby([train.d.dt.weekday >= 5, "hour"]).price.mean() / level
        week = train[train.d >= fold - pd.Timedelta(days=7)]
        naive = week.groupby([week.d.dt.weekday, "hour"]).price.mean()
        want = [base * cells.get((d.weekday() >= 5, h), 1.0) for d, h in zip(test.d, test.hour, strict=True)]
        assert np.allclose(test.pred, want) and np.allclose(test.naive, [naive.get((d.weekday(), h), level) for d, h in zip(test.d, test.hour, strict=True)])


def test_a_planted_break_is_found_and_noise_has_none(spark):
    rng = np.random.default_rng(11)
    rows = []
    for market, breaks_at in (("noise", None), ("break", 30)):
        for m in range(60):
            shape = 50 + 10 * np.sin(np.arange(24) / 4)
            if breaks_at is not None and m >= breaks_at:
                shape[18] += 25
            for day in (3, 10, 17):
                rows += [(market, dt.date(2015 + m // 12, m % 12 + 1, day), h, float(shape[h] + rng.normal())) for h in range(24)]
    tests = aggregates.sliding_breaks(spark.createDataFrame(rows, "market string, d date, hour int, price double"), ["market"])
    assert tests.select("market", "cut").distinct().count() == 2 * (60 - 24 + 1)
    got = aggregates.breaks(tests, ["market"]).toPandas()
    assert not got[got.market == "noise"].broken.any() and set(got[got.market == "noise"].lookback_months) == {36}
    mine = got[got.market == "break"]
    assert mine.loc[mine.p.idxmin(), "cut"] in [dt.date(2017, m, 1) for m in (6, 7, 8)] and mine.broken.any() and mine.lookback_months.max() < 36


def test_error_slices_share_out_the_squared_error(spark, sf_dir):
    from fwdcurve.plans import registry

    registry.load()
    got = registry.QUERIES["val9_error_slices"](spark, sf_dir).groupBy("market", "dimension").agg(F.sum("contribution").alias("all"), F.sum("n").alias("n")).toPandas()
    assert set(got.dimension) == set(forecast_plans.SLICES) and (got["all"] - 1).abs().max() < 1e-3 and got.groupby("market").n.nunique().max() == 1


@pytest.mark.parametrize("block", [50, 2048])
def test_autocorrelations_equal_brute_force(spark, block):
    rng = np.random.default_rng(1)
    series = {"a": np.cumsum(rng.normal(size=900)), "b": rng.normal(size=40), "c": np.ones(5)}
    table = spark.createDataFrame([(s, k, float(v)) for s, x in series.items() for k, v in enumerate(x)], "s string, t int, v double").repartition(3)
    got = {(r["s"], r["lag"]): r["acf"] for r in windows.autocorrelations(table, ["s"], "t", "v", 672, block).collect()}
    assert len(got) == 672 + 39 + 4
    for s, x in series.items():
        e = x - x.mean()
        for k in range(1, min(672, len(x) - 1) + 1):
            assert (got[s, k] is None) if s == "c" else abs(got[s, k] - (e[k:] * e[:-k]).sum() / (e * e).sum()) < 1e-9


def test_rows_of_the_days_ahead_carry_what_is_known(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(40)]
    hours = [(m, d, h, float(100 * (m == "B") + k + h / 100)) for m in "AB" for k, d in enumerate(days) for h in range(24)]
    table = spark.createDataFrame(hours, "market string, d date, hour int, price double")
    other = table.withColumn("market", F.when(F.col("market") == "A", "B").otherwise("A"))
    daily = spark.createDataFrame([(d, float(k), float(k) / 2) for k, d in enumerate(days)], "d date, load double, gas double")
    rows = forecast.hour_features(table, other, daily, ["load"], {"gas": 2}, ahead=10)
    past, ahead = rows.where("price IS NOT NULL"), rows.where("price IS NULL AND market = 'A' AND hour = 5").orderBy("d").collect()
    plain = forecast.hour_features(table, other, daily, ["load"], {"gas": 2})
    assert past.exceptAll(plain).count() == plain.exceptAll(past).count() == 0 and plain.count() == 2 * 24 * 40
    price = lambda k: k + 0.05
    for a, r in enumerate(ahead, 1):
        assert r["d"] == days[-1] + dt.timedelta(days=a)
        for k in (1, 2, 3, 7):
            assert r[f"price_d{k}"] == pytest.approx(price(min(39, 39 + a - k)))
        for k in (1, 2, 7):
            assert r[f"beside_d{k}"] == pytest.approx(100 + price(min(39, 39 + a - k)))
        assert r["gas_d2"] == min(39, 39 + a - 2) / 2 and r["load_d0"] == pytest.approx(np.arange(12, 40).mean()) and r["load_d7"] == pytest.approx(39 + a - 7 if a <= 7 else np.arange(12, 40).mean())
        assert r["momentum"] == pytest.approx(r["price_d1"] - r["price_d2"]) and r["vol7"] > 0 and r["weekend"] == (r["d"].weekday() >= 5)
    assert len(ahead) == 10


def test_trends_of_profiles_and_bounded_corrections(spark):
    rows = [("m", "w", dt.date(y, 1, 1 + d), h, 50.0 + (5 * (y - 2018) if h == 18 else 0)) for y in (2018, 2019, 2020, 2021) for d in range(5) for h in range(24)]
    rows += [("m", "flat", dt.date(y, 2, 1), h, 50.0 + h) for y in (2018, 2019, 2020) for h in range(24)] + [("m", "short", dt.date(y, 3, 1), h, float(h * y)) for y in (2018, 2019) for h in range(24)]
    got = shapes.profile_trends(spark.createDataFrame(rows, "market string, cell string, d date, hour int, price double"), ["market", "cell"]).collect()
    assert {r["cell"] for r in got} == {"w"} and max(got, key=lambda r: r["slope"])["hour"] == 18
    f = spark.range(1).select(shapes.trended_factor(F.lit(1.0), F.lit(0.1), F.lit(1000.0)).alias("far"), shapes.trended_factor(F.lit(1.0), F.lit(5.0), F.lit(1.0)).alias("cut"), shapes.trended_factor(F.lit(1.0), F.lit(0.1), F.lit(-3.0)).alias("past")).first()
    assert f["far"] == pytest.approx(1.2) and f["cut"] == 2.0 and f["past"] == 1.0
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    fit = spark.createDataFrame([("k", k, float(a), float(b), float(0.02 * a - 0.5 * b)) for k, (a, b) in enumerate(x)], "key string, ts int, a double, b double, y double")
    r = shapes.ridge_correction(fit, ["key"], ["a", "b"], "y", most=shapes.MOST_CORRECTION).first()
    assert r["accepted"] and r["coefs"] == pytest.approx([0.02, -0.05], abs=1e-3)


def test_a_corrupt_file_beside_good_ones_is_left_out(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").repartition(2).write.parquet(f"{tmp_path}/t.parquet")
    (tmp_path / "t.parquet" / "part-bad.parquet").write_bytes(b"not a footer at all, whatever it is called")
    with pytest.warns(UserWarning):
        rows = readers.optional(spark, f"{tmp_path}/t.parquet", "k long, v string, more double")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "a", None), (2, "b", None)]


def test_fixed_decimals_are_those_of_the_binary_value(spark):
    values = [61.50875, 42.45625, 0.03125, 0.09375, 0.00015, 0.99995, -0.03125, -0.00001, -0.0, 0.0, 211411417311031.96875, 2.0**57 + 16, float("nan"), float("inf"), -float("inf"), None]
    values += [k / 1600 for k in range(-3000, 3000)]
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v double").select("k", writers.fixed(F.col("v")).alias("text"))
    got = [r["text"] for r in rows.orderBy("k").collect()]
    assert got == [None if v is None else f"{v:.4f}" for v in values]


def test_exported_prices_tie_as_in_the_twin_and_names_come_back(spark, sf_dir, tmp_path):
    for table in os.listdir(sf_dir):
        if table != "events.parquet":
            os.symlink(f"{sf_dir}/{table}", tmp_path / table)
    names = ["click", "", None, " pad ", "a;b", 'q"uote', "back\\", "new\nline", "cr\rx"]
    # eight events a slot, whose mean of cents ties in the fifth decimal
    rows = [(names[s % len(names)], dt.datetime(2024, 10, 26) + dt.timedelta(minutes=15 * s, seconds=k), None if s % 11 == 0 else k * 0.37 if k else (s - 150) * 3.01) for s in range(300) for k in range(8)]
    pd.DataFrame(rows, columns=["event_type", "ts", "value"]).astype({"ts": "datetime64[us]"}).to_parquet(tmp_path / "events.parquet")
    registry.load()
    agree(spark, registry.QUERIES["snk4_export_csv"], registry.SQL["snk4_export_csv"], str(tmp_path))
