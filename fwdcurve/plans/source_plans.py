"""Queries SRC1-SRC16 and SNK1-SNK13: scans, failover, upserts, exports, history tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import timegrid as tg
from ..operators import shapes
from ..operators import windows as win
from ..sources import readers, upserts, writers
from .curve_plans import HISTORY, LOADS, PEAKR, RATIO, quote_history
from .registry import query
from .shape_plans import BANDS, DAYS, EXOGENOUS, FH, FH_ALL, FH_SMOOTH, FQ, FW, RATIOS, bands, profile, quarter_corrections, quarter_table, water_months, weighted_days
from .table_plans import HOURLY, hourly
from .time_plans import R, S

PERIOD = "CASE WHEN month IS NOT NULL THEN printf('%d-%02d', year, month) WHEN quarter IS NOT NULL THEN printf('%d-Q%d', year, quarter) ELSE CAST(year AS VARCHAR) END"


def scratch(t, name: str) -> str:
    """A new folder in the shared storage for a written form that the query reads back."""
    return writers.shared_folder(t.spark, name)


@query("src1_parquet", "SELECT event_type AS series, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def src1(t):
    rows = readers.parquet(t.spark, f"{t.path}/events.parquet", "event_type string, value double")
    return rows.groupBy(F.col("event_type").alias("series")).agg(F.count(F.lit(1)).alias("n"), R(F.sum("value"), "total", 4))


@query("src2_optional", "SELECT count(*) AS found, 0::BIGINT AS missing FROM events")
def src2(t):
    there, absent = (readers.optional(t.spark, f"{t.path}/{n}.parquet", "event_id long") for n in ("events", "no_such_table"))
    return there.agg(F.count(F.lit(1)).alias("found")).crossJoin(absent.agg(F.count(F.lit(1)).alias("missing")))


@query("src3_curve_csv", "SELECT market, CAST(d AS VARCHAR) AS d, round(price / 7.13, 4) AS price FROM daily")
def src3(t):
    path = scratch(t, "curve-csv")
    writers.curve_csv(t.daily.select("market", F.col("d").cast("timestamp_ntz").alias("ts"), (F.col("price") / 7.13).alias("price")), path)
    rows = readers.curve_csv(t.spark, path)
    return rows.select("market", F.to_date("ts").cast("string").alias("d"), "price")


PAYLOAD = "payload AS (SELECT event_type AS series, list(epoch(ts) ORDER BY ts, event_id) AS unix_seconds, list(CASE WHEN event_id % 11 <> 0 THEN value END ORDER BY ts, event_id) AS price FROM events GROUP BY event_type)"


def payload(t):
    """JSON texts with parallel arrays unix_seconds, event_id and price: one per series, hour and one of 16 parts of its events."""
    item = F.struct("ts", "event_id", F.unix_timestamp("ts").alias("s"), F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("v"))
    part = F.pmod(F.xxhash64("event_id"), F.lit(16))
    rows = t.events.groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("hour"), part.alias("part")).agg(F.sort_array(F.collect_list(item)).alias("x"))
    return rows.select("series", F.to_json(F.struct(F.col("x.s").alias("unix_seconds"), F.col("x.event_id").alias("event_id"), F.col("x.v").alias("price")), {"ignoreNullFields": "false"}).alias("body"))


@query("src4_price_payload", "SELECT event_type AS series, CAST(date_trunc('second', ts) AS VARCHAR) AS ts, round(arg_max(value, event_id), 6) AS price FROM events WHERE event_id % 11 <> 0 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY event_type, date_trunc('second', ts)")
def src4(t):
    # landed payloads: a row per hour and part, so their arrays are exploded in parallel
    rows = readers.price_payload(payload(t), "2024-01-05", "2024-01-25")
    return rows.select("series", S("ts"), R("price", "price"))


@query("src5_power_payload", "SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS ts, round(sum(value) FILTER (event_type = 'click'), 6) AS click, round(sum(value) FILTER (event_type = 'view'), 6) AS view, round(sum(value) FILTER (event_type NOT IN ('click', 'view')), 6) AS other FROM events GROUP BY date_trunc('hour', ts)")
def src5(t):
    kinds = F.struct(F.col("event_type").alias("name"), "value")
    hours = t.events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.collect_list(kinds).alias("production_types"))
    landed = hours.select("ts", F.to_json("production_types").alias("body"))
    return readers.power_payload(landed, {"click": "click", "view": "view"}).select(S("ts"), *(R(c, c) for c in ("click", "view", "other")))


@query("src6_chunked_series", "SELECT event_type AS series, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY event_type")
def src6(t):
    path = scratch(t, "chunks")
    rows = t.events.select("event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "value", F.to_date("ts").cast("string").alias("chunk"))
    rows.write.partitionBy("chunk").json(path)
    found = readers.chunked(t.spark, path, "event_type string, ms long, value double", "2024-01-10", "2024-01-20")
    return found.groupBy(F.col("event_type").alias("series")).agg(F.count(F.lit(1)).alias("n"), R(F.sum("value"), "total", 4))


@query("src7_reservoir_csv", "SELECT CAST(week AS VARCHAR) AS week, greatest(0.0, least(100.0, round(fill_pct, 2))) AS fill_pct FROM hydro")
def src7(t):
    path = scratch(t, "reservoir")
    t.hydro.select(F.col("week").alias("Datum"), (F.col("fill_pct") * 50).alias("Inhalt"), F.lit(5000.0).alias("Maximum")).write.csv(path, header=True)
    return readers.reservoir_csv(t.spark, path).select(S("week"), "fill_pct")


@query("src8_range_read", "SELECT CAST(week AS VARCHAR) AS week, round(fill_pct, 6) AS fill_pct FROM hydro WHERE week >= DATE '1998-01-01' - INTERVAL 2 year AND week <= DATE '1999-12-31'")
def src8(t):
    lo, hi = F.add_months(F.lit("1998-01-01").cast("date"), -24), F.lit("1999-12-31").cast("date")
    return t.hydro.where(F.col("week").between(lo, hi)).select(S("week"), R("fill_pct", "fill_pct"))


@query("src9_latest_snapshot", "SELECT market, CAST(d AS VARCHAR) AS run_date, round(price, 6) AS price FROM daily WHERE d = (SELECT max(d) FROM daily) ORDER BY market")
def src9(t):
    last = t.daily.agg(F.max("d").alias("last"))
    return t.daily.join(F.broadcast(last), F.col("d") == F.col("last")).orderBy("market").select("market", S("d", "run_date"), R("price", "price"))


@query("src10_wide_report", "SELECT CAST(d AS VARCHAR) AS date, market, round(price, 2) AS price FROM daily WHERE round(price, 2) > 0")
def src10(t):
    wide = t.daily.groupBy("d").pivot("market", ["CH", "DE"]).agg(F.first("price"))
    text = lambda c: F.replace(F.format_string("%.2f", F.round(c, 2)), F.lit("."), F.lit(","))
    landed = wide.select(S("d", "date"), *(F.when(F.col(c).isNotNull(), text(c)).alias(f"M01_{c}") for c in ("CH", "DE")))
    long = readers.wide_report(landed, ["M01_CH", "M01_DE"])
    return long.select("date", F.substring_index("code", "_", -1).alias("market"), "price")


@query("src11_product_codes", f"SELECT market, code, CASE WHEN month IS NULL AND quarter IS NULL THEN CAST(year AS VARCHAR) ELSE {PERIOD} END AS key, CASE WHEN load = 'PEAK' THEN 'Peak' ELSE 'Base' END AS load FROM (SELECT *, CASE WHEN year % 3 = 0 THEN 'PEAK' ELSE 'BASE' END AS load, CASE WHEN month IS NOT NULL THEN printf('M%02d', month) WHEN quarter IS NOT NULL THEN printf('Q%02d', quarter) ELSE 'Y01' END || '_' || CAST(year AS VARCHAR) || '_' || CASE WHEN year % 3 = 0 THEN 'PEAK' ELSE 'BASE' END AS code FROM quotes)")
def src11(t):
    kind = F.when(F.col("month").isNotNull(), F.format_string("M%02d", "month")).when(F.col("quarter").isNotNull(), F.format_string("Q%02d", "quarter")).otherwise("Y01")
    code = F.concat_ws("_", kind, F.col("year").cast("string"), F.when(F.col("year") % 3 == 0, "PEAK").otherwise("BASE"))
    rows = t.quotes.select("market", code.alias("code")).withColumn("p", readers.product_code(F.col("code")))
    return rows.where("p IS NOT NULL").select("market", "code", "p.key", "p.load")


@query("src12_asof_pick", "SELECT market, CAST(max(d) AS VARCHAR) AS d, round(arg_max(price, d), 6) AS price FROM daily WHERE d <= DATE '1999-06-30' AND price > 0 GROUP BY market")
def src12(t):
    rows = t.daily.where((F.col("d") <= F.lit("1999-06-30").cast("date")) & (F.col("price") > 0))
    return rows.groupBy("market").agg(F.max("d").cast("string").alias("d"), R(F.max_by("price", "d"), "price"))


@query("src13_failover", """SELECT CAST(g.d AS VARCHAR) AS d, CASE WHEN a.price IS NOT NULL THEN 'primary' WHEN b.price IS NOT NULL THEN 'secondary' WHEN c.price IS NOT NULL THEN 'third' WHEN k.price IS NOT NULL THEN 'cache' END AS source, round(coalesce(a.price, b.price, c.price, k.price), 6) AS price
  FROM (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 day)) AS DATE) AS d FROM daily) g LEFT JOIN (SELECT d, price FROM daily WHERE market = 'CH' AND day(d) % 3 <> 0) a ON a.d = g.d LEFT JOIN (SELECT d, price FROM daily WHERE market = 'DE' AND day(d) % 2 <> 0) b ON b.d = g.d
  LEFT JOIN (SELECT week AS d, fill_pct AS price FROM hydro) c ON c.d = g.d ASOF LEFT JOIN (SELECT d, price FROM daily WHERE market = 'CH' AND day(d) % 3 <> 0) k ON g.d >= k.d""")
def src13(t):
    """Each day's price from the first source that has it, of three, else the primary's last one from the cache; with its origin."""
    part = lambda m, every: t.daily.where((F.col("market") == m) & (F.dayofmonth("d") % every != 0)).select("d", "price")
    days = t.daily.agg(F.min("d").alias("a"), F.max("d").alias("b")).select(F.explode(F.sequence("a", "b")).alias("d"))
    primary = part("CH", 3)
    cached = days.join(primary, "d", "left").withColumn("market", F.lit("CH")).withColumn("price", win.ffill("price", ["market"], "d")).select("d", "price")
    third = t.hydro.select(F.col("week").alias("d"), F.col("fill_pct").alias("price"))
    found = readers.failover({"primary": primary, "secondary": part("DE", 2), "third": third, "cache": cached}, ["d"], "price")
    return days.join(found, "d", "left").select(S("d"), "source", R("price", "price"))


@query("src14_column_choice", "SELECT l_orderkey, round(coalesce(arg_min(v, p), 0), 6) AS value FROM (SELECT l_orderkey, l_extendedprice AS v, CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END * 1000000 + l_linenumber * 1000 + l_quantity AS p FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END * 1000000 + l_linenumber * 1000 + l_quantity ORDER BY l_extendedprice) = 1) GROUP BY l_orderkey")
def src14(t):
    # columns of a group as rows: the aggregated one first, else the first of the others
    rank = F.struct(F.when(F.col("l_linestatus") == "O", 0).otherwise(1), "l_linenumber", "l_quantity", "l_extendedprice")
    return t.lineitem.groupBy("l_orderkey").agg(R(F.coalesce(F.min_by("l_extendedprice", rank), F.lit(0.0)), "value"))


@query("src15_close_columns", "SELECT name, CAST(d AS VARCHAR) AS d, round(close, 6) AS close FROM commodities")
def src15(t):
    closes = t.commodities
    names = sorted(r[0] for r in t.part.select("p_brand").where("p_brand IS NOT NULL").distinct().collect())
    wide = closes.groupBy("d").pivot("name", names).agg(F.first("close"))
    wide = wide.select("d", *(F.col(f"`{n}`").alias(f"{n}|close") for n in names))
    return readers.close_columns(wide, "d").select("name", S("d"), R("close", "close"))


@query("src16_latest_artifact", "SELECT prefix, CAST(make_date(y, 12, 31) AS VARCHAR) AS run_date, count(*) AS n, round(sum(price), 4) AS total FROM (SELECT 'curve_' || lower(market) AS prefix, CAST(year(d) AS INT) AS y, max(CAST(year(d) AS INT)) OVER (PARTITION BY market) AS last, price FROM daily) WHERE y = last GROUP BY prefix, y")
def src16(t):
    """Artifacts lie in folders <prefix>_<date>; of each prefix the latest one is read, by its name alone."""
    path = scratch(t, "artifacts")
    name = F.concat(F.lit("curve_"), F.lower("market"), F.lit("_"), F.year("d").cast("string"), F.lit("-12-31"))
    t.daily.select("market", "d", "price", name.alias("artifact")).write.partitionBy("artifact").parquet(path)
    rows = None
    for prefix in ("curve_ch", "curve_de"):
        one = readers.latest_artifact(t.spark, path, prefix, "market string, d date, price double")
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("prefix", S("run_date")).agg(F.count(F.lit(1)).alias("n"), R(F.sum("price"), "total", 4))


DAILY = "market string, d date, price double, month string"


def stored_daily(t, path: str) -> None:
    rows = t.daily.withColumn("month", F.date_format("d", "yyyy-MM"))
    upserts.upsert_stored(rows, path, ["market", "d"], "month")


@query("snk1_upsert", "SELECT market, CAST(d AS VARCHAR) AS d, round(CASE WHEN day(d) <= 10 THEN price + 1 ELSE price END, 6) AS price FROM daily")
def snk1(t):
    """Daily prices in a table by month, and a batch of the first ten days of each month merged into it, twice."""
    path = scratch(t, "daily")
    stored_daily(t, path)
    new = t.spark.read.schema(DAILY).parquet(path).where(F.dayofmonth("d") <= 10).withColumn("price", F.col("price") + 1)
    batch = scratch(t, "daily-batch")
    new.write.parquet(batch)
    for _ in range(2):
        upserts.upsert_stored(t.spark.read.schema(DAILY).parquet(batch), path, ["market", "d"], "month")
    return t.spark.read.schema(DAILY).parquet(path).select("market", S("d"), R("price", "price"))


LONG = "(SELECT market, quoted, printf('%d-%02d', year, month) AS product, load, CASE load WHEN 'Base' THEN base ELSE peak END AS price, month FROM hq, (VALUES ('Base'), ('Peak')) l(load))"


@query("snk2_upsert_composite", f"SELECT market, CAST(quoted AS VARCHAR) AS quoted, product, load, round(CASE WHEN month % 2 = 0 AND load = 'Peak' THEN price * 1.01 ELSE price END, 6) AS price FROM {LONG}", f"{RATIO}, {LOADS}, {PEAKR}, {HISTORY}")
def snk2(t):
    """Forward quotes by date, product, load type and market in a table by year of quotation, and a batch of peaks merged into it."""
    path, keys = scratch(t, "forwards"), ["quoted", "product", "load", "market"]
    sides = F.inline(F.array(*(F.struct(F.lit(load).alias("load"), F.col(c).alias("price")) for load, c in (("Base", "base"), ("Peak", "peak")))))
    rows = quote_history(t).select("market", "quoted", tg.key_of(F.col("year"), F.lit(None).cast("int"), F.col("month")).alias("product"), sides, "month", F.year("quoted").alias("quoted_year"))
    written = t.settled("forwards", lambda: rows)
    upserts.upsert_stored(written, path, keys, "quoted_year")
    upserts.upsert_stored(written.where("month % 2 = 0 AND load = 'Peak'").withColumn("price", F.col("price") * 1.01), path, keys, "quoted_year")
    return t.spark.read.schema(written.schema).parquet(path).select("market", S("quoted"), "product", "load", R("price", "price"))


@query("snk3_derived_again", "SELECT market, CAST(d AS VARCHAR) AS d, round(coalesce((p - avg(p) OVER w) / nullif(stddev_samp(p) OVER w, 0), 0), 6) AS z FROM (SELECT market, d, CASE WHEN day(d) = 1 AND month(d) = 6 THEN price + 5 ELSE price END AS p FROM daily) WINDOW w AS (PARTITION BY market, year(d), month(d))")
def snk3(t):
    """A raw table and one derived from it by month; a batch touches the Junes, and only these are derived again."""
    raw, derived = scratch(t, "raw"), scratch(t, "derived")
    scored = lambda rows: rows.select("market", "d", win.zscore("price", ["market", "month"]).alias("z"), "month")
    stored_daily(t, raw)
    rows = t.spark.read.schema(DAILY).parquet(raw)
    scored(rows).repartition("month").write.partitionBy("month").parquet(derived)
    batch = scratch(t, "raw-batch")
    rows.where("day(d) = 1 AND month(d) = 6").withColumn("price", F.col("price") + 5).write.parquet(batch)
    changed = upserts.upsert_stored(t.spark.read.schema(DAILY).parquet(batch), raw, ["market", "d"], "month")
    upserts.derive_stored(t.spark, raw, derived, "month", changed, DAILY, scored)
    return t.spark.read.schema("market string, d date, z double, month string").parquet(derived).select("market", S("d"), R("z", "z"))


@query("snk4_export_csv", "SELECT series, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Zurich', '%d.%m.%Y %H:%M') AS local_ts, printf('%.4f', round(price, 6)) AS price FROM spot")
def snk4(t):
    path = scratch(t, "export-csv")
    price = F.signum("price") * R(F.abs("price"), "price")  # what rounds to zero keeps its sign, as in the twin
    writers.local_csv(t.spot.select("series", "ts", price.alias("price")), path)
    return readers.local_csv(t.spark, path)


@query("snk5_export_parquet", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(price, 6) AS price, false AS calibrated FROM spot")
def snk5(t):
    path = scratch(t, "export-parquet")
    writers.curve_parquet(t.spot.withColumn("calibrated", F.lit(False)), path, ["series"])
    rows = t.spark.read.parquet(path)
    return rows.select("series", S("ts"), R("price", "price"), "calibrated")


@query("snk6_export_variants", "SELECT flavor, count(*) AS n, round(sum(price + add), 4) AS total FROM spot, (VALUES ('mid_market', 0.0), ('client', 1.0), ('production', 0.8)) f(flavor, add) GROUP BY flavor")
def snk6(t):
    path = scratch(t, "export-flavors")
    flavors = F.array(*(F.struct(F.lit(n).alias("flavor"), F.lit(a).alias("add")) for n, a in (("mid_market", 0.0), ("client", 1.0), ("production", 0.8))))
    rows = t.spot.select("series", "ts", "price", F.inline(flavors)).select("flavor", "series", "ts", (F.col("price") + F.col("add")).alias("price"))
    writers.curve_parquet(rows, path, ["flavor"])
    return t.spark.read.parquet(path).groupBy("flavor").agg(F.count(F.lit(1)).alias("n"), R(F.sum("price"), "total", 4))


RUNS = "SELECT CAST(year(d) AS INT) AS run_id, count(*) AS n_rows, bool_or(market = 'DE') AS calibrated FROM daily GROUP BY year(d)"


@query("snk7_run_registry", RUNS)
def snk7(t):
    runs = t.daily.groupBy(F.year("d").alias("run_id")).agg(F.count(F.lit(1)).alias("n_rows"), F.bool_or(F.col("market") == "DE").alias("calibrated"))
    path = scratch(t, "runs")
    writers.replace_runs(runs.withColumn("n_rows", F.lit(0).cast("long")), path)
    writers.replace_runs(runs, path)  # a second run of the same ids replaces them
    return t.spark.read.schema(runs.schema).parquet(path)


@query("snk8_hourly_downsample", "SELECT series, CAST(date_trunc('hour', ts) AS VARCHAR) AS ts, round(avg(price), 6) AS price FROM spot GROUP BY series, date_trunc('hour', ts)")
def snk8(t):
    return hourly(t).select("series", S("ts"), R("price", "price"))


@query("snk9_benchmarks", "SELECT CAST(year(d) AS INT) AS run_id, market, round(avg(price), 6) AS mean FROM daily GROUP BY year(d), market")
def snk9(t):
    rows = t.daily.groupBy(F.year("d").alias("run_id"), "market").agg(R(F.avg("price"), "mean"))
    path = scratch(t, "benchmarks")
    writers.replace_runs(rows, path)
    return t.spark.read.schema(rows.schema).parquet(path)


@query("snk10_history_tables", "SELECT series AS run_id, count(*) AS n FROM spot GROUP BY series")
def snk10(t):
    name = f"forecasts_{uuid.uuid4().hex}"
    writers.create_history(t.spark, name, scratch(t, "history"))
    t.spot.select("ts", "price", F.col("series").alias("run_id")).write.insertInto(name)
    return t.spark.table(name).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


@query("snk11_run_report", "SELECT market, CAST(json_object('n', count(*), 'mean', round(avg(price), 4), 'complete', count(*) FILTER (price IS NULL) = 0) AS VARCHAR) AS report FROM daily GROUP BY market")
def snk11(t):
    gates = F.struct(F.count(F.lit(1)).alias("n"), R(F.avg("price"), "mean", 4), (F.count_if(F.col("price").isNull()) == 0).alias("complete"))
    return t.daily.groupBy("market").agg(F.to_json(gates).alias("report"))


MODEL = """SELECT 'f_H' AS kind, series AS key, season, day_type, hour, NULL::INT AS quarter, 'f' AS name, f AS value FROM fh_all UNION ALL SELECT 'f_Q', series, season, day_type, hour, quarter, 'f', f FROM fq UNION ALL SELECT 'f_W', market, NULL, day_type, NULL, NULL, 'f', f FROM fw
  UNION ALL SELECT 'bands', series, NULL, NULL, hour, NULL, name, CASE name WHEN 'p10' THEN p10 WHEN 'p50' THEN p50 ELSE p90 END FROM bands, (VALUES ('p10'), ('p50'), ('p90')) n(name)"""


@query("snk12_model_tables", f"SELECT kind, key, season, day_type, hour, quarter, name, round(value, 6) AS value FROM ({MODEL})", f"{RATIOS}, {FQ}, {FH[FH.index('fh_raw AS'):]}, {FH_SMOOTH}, {FH_ALL}, {DAYS}, {FW}, {HOURLY}, {BANDS}")
def snk12(t):
    """The fitted shapes in one long table by version (f_H, f_W, f_Q, its corrections, bands, water value), written and read back; the
    twin has the parts that SQL can fit."""
    path = scratch(t, "model")
    writers.save_model(model_table(t), path, "v1")
    return readers.load_model(t.spark, path, "v1").where("kind NOT IN ('f_Q correction', 'water value')").select("kind", "key", "season", "day_type", "hour", "quarter", "name", R("value", "value"))


def model_table(t):
    """(kind, key, season, day_type, hour, quarter, name, value) of everything that is fitted."""
    columns = ("season", "day_type", "hour", "quarter")

    def long(rows, kind: str, key: str, values: dict):
        cells = [F.col(c).cast("int" if c in ("hour", "quarter") else "string").alias(c) if c in rows.columns else F.lit(None).cast("int" if c in ("hour", "quarter") else "string").alias(c) for c in columns]
        named = F.inline(F.array(*(F.struct(F.lit(n).alias("name"), v.cast("double").alias("value")) for n, v in values.items())))
        return rows.select(F.lit(kind).alias("kind"), F.col(key).alias("key"), *cells, named)

    fixes = quarter_corrections(t).where("accepted")
    parts = [
        long(shapes.with_fallback(shapes.smoothed(profile(t))), "f_H", "series", {"f": F.col("f")}), long(quarter_table(t), "f_Q", "series", {"f": F.col("f")}),
        long(shapes.day_factor(weighted_days(t), ["market"], 20), "f_W", "market", {"f": F.col("f")}), long(bands(t), "bands", "series", {c: F.col(c) for c in ("p10", "p50", "p90")}),
        long(fixes, "f_Q correction", "series", {"intercept": F.col("intercept"), **{c: F.col("coefs")[k] for k, c in enumerate(EXOGENOUS)}}),
        long(shapes.water_fit(water_months(t)), "water value", "market", {"beta": F.col("beta"), **{c: F.col(c) for c in shapes.WATER_SEASONS}}),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("snk13_report_csv", "SELECT market, CAST(count(*) AS VARCHAR) AS n FROM daily GROUP BY market")
def snk13(t):
    path = scratch(t, "report")
    t.daily.groupBy("market").count().write.csv(path, header=True)
    return t.spark.read.schema("market string, n string").csv(path, header=True)
