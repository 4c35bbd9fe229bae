"""Benchmarks, their errors, recursive forecasts, calibration, scenarios and trends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalmill.operators.global_rank import global_quantiles, global_row_number
from pedalmill.plans.features import COLOR_SQL, GROUP_SQL, PANEL_SQL, by_sku, color_monthly, group_monthly, panel
from pedalmill.session import cut

# Fixed values of the forecasts.
#: Weights of the current month in the exponential averages tried, and the one the forecast uses.
ALPHAS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
ALPHA = 0.3
#: The calendar month whose rows are held out.
TEST_MONTH = 3
#: Months ahead.
STEPS = 3
MODELS = ("naive", "rolling_2m", "rolling_3m", *(f"ewma_{a}" for a in ALPHAS))


def stepped(p: DataFrame) -> DataFrame:
    """``p``, a panel, with the month before, the means of the two and three before it, and the next month as actual."""
    means = {f"mean_{k}": F.avg("qty").over(by_sku().rowsBetween(-k, -1)) for k in (2, 3)}
    return p.withColumns({"lag_1": F.lag("qty").over(by_sku()), "actual": F.lead("qty").over(by_sku())} | means)


def benchmark_frame(p: DataFrame) -> DataFrame:
    """Rows of a ``stepped`` panel that have a next month, with every benchmark's prediction of it, none below 0."""
    floor = lambda c: F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0))
    preds = {"naive": floor(F.col("qty")), "rolling_2m": floor(F.col("mean_2")), "rolling_3m": floor(F.col("mean_3"))}
    preds |= {f"ewma_{a}": floor(F.lit(a) * F.col("qty") + F.lit(1 - a) * F.coalesce("lag_1", F.lit(0.0))) for a in ALPHAS}
    return p.where("actual is not null").select("product_code", "group_name", "fiscal_year", "fiscal_month", "actual", *[c.alias(n) for n, c in preds.items()])


def held_out_of(p: DataFrame) -> DataFrame:
    return benchmark_frame(p).where(F.col("fiscal_month") == TEST_MONTH)


def held_out(spark: SparkSession, d: str) -> DataFrame:
    return held_out_of(stepped(panel(spark, d)))


def long_form(frame: DataFrame) -> DataFrame:
    """(model, product_code, fiscal_year, actual, pred), a row per benchmark."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"`{m}`").alias("pred")) for m in MODELS])
    return frame.select("product_code", "fiscal_year", "actual", F.explode(pairs).alias("x")).select("x.model", "product_code", "fiscal_year", "actual", "x.pred")


def metrics(rows: DataFrame) -> DataFrame:
    """Errors per model in one aggregation; 0 where a denominator is."""
    e = F.col("pred") - F.col("actual")
    both = (F.abs("actual") + F.abs("pred")) / 2
    pct = lambda num, den: F.round(F.coalesce(F.try_divide(num, den) * 100, F.lit(0.0)), 4)
    sse, n = F.sum(e * e), F.count(F.lit(1))
    sst = F.sum(F.col("actual") * F.col("actual")) - F.sum("actual") * F.sum("actual") / n
    return rows.groupBy("model").agg(
        F.round(F.avg(F.abs(e)), 4).alias("mae"),
        F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"),
        F.round(F.coalesce(F.avg(F.when(F.col("actual") != 0, F.abs(e / F.col("actual")))) * 100, F.lit(0.0)), 4).alias("mape"),
        pct(F.sum(F.abs(e)), F.sum("actual")).alias("wmape"),
        F.round(F.avg(F.when(both == 0, 0.0).otherwise(F.abs(e) / F.nullif(both, F.lit(0.0)))) * 100, 4).alias("smape"),
        pct(F.sum(e), F.sum("actual")).alias("bias_pct"),
        F.round(F.coalesce(1 - F.try_divide(sse, sst), F.lit(0.0)), 6).alias("r2"),
        F.round(F.sum("actual"), 2).alias("actual_total"),
        F.round(F.sum("pred"), 2).alias("pred_total"),
    )


def hit_rate(rows: DataFrame, k: int) -> DataFrame:
    """(model, hit rate): the share of the ``k`` largest actual rows that are among the ``k`` largest predicted."""
    key = ["product_code", "fiscal_year"]
    top = lambda c: Window.partitionBy("model").orderBy(F.col(c).desc(), *key)
    # a model's ranks are cut off at k, so the planner keeps k rows per task before the shuffle
    real = rows.withColumn("r", F.row_number().over(top("actual"))).where(F.col("r") <= k).select("model", *key)
    guess = rows.withColumn("r", F.row_number().over(top("pred"))).where(F.col("r") <= k).select("model", *key)
    return real.join(guess, ["model", *key]).groupBy("model").agg((F.count(F.lit(1)) / k).alias(f"top{k}_hit_rate"))


def benchmark_predictions(spark: SparkSession, d: str) -> DataFrame:
    return long_form(held_out(spark, d))


def forecast_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics(long_form(held_out(spark, d)))


def topk_hit_rate(spark: SparkSession, d: str) -> DataFrame:
    rows = long_form(held_out(spark, d))
    models = spark.createDataFrame([(m,) for m in MODELS], "model string")
    out = models
    for k in (10, 20):
        out = out.join(hit_rate(rows, k), "model", "left").na.fill(0.0, [f"top{k}_hit_rate"])
    return out


def selected_model(spark: SparkSession, d: str) -> DataFrame:
    """The benchmark with the least WMAPE, then MAE and RMSE, then with the best hits among the twenty, then by name."""
    rows = cut(long_form(held_out(spark, d)))  # used for the errors and twice for the ranks
    hits = hit_rate(rows, 20)
    m = metrics(rows).join(hits, "model", "left").na.fill(0.0, ["top20_hit_rate"])
    return m.orderBy("wmape", "mae", "rmse", F.col("top20_hit_rate").desc(), "model").limit(1).select("model", "wmape", "mae", "rmse", "smape", "top20_hit_rate")


def calibration_of(test: DataFrame) -> DataFrame:
    g = test.groupBy("group_name").agg(F.round(F.sum("actual"), 4).alias("actual_qty"), F.round(F.sum(f"`ewma_{ALPHA}`"), 4).alias("pred_qty"))
    raw = F.when(F.col("pred_qty") > 0, F.col("actual_qty") / F.col("pred_qty")).otherwise(1.0)
    return g.withColumn("raw_factor", raw).withColumn("factor", F.least(F.lit(1.1), F.greatest(F.lit(0.9), 1 + 0.5 * (F.col("raw_factor") - 1))))


def group_calibration(spark: SparkSession, d: str) -> DataFrame:
    return calibration_of(held_out(spark, d))


def recursive_forecast(p: DataFrame) -> DataFrame:
    """The three months after the last observed one, each from the two before it. The recursion is unrolled
    into columns: no loop, no growing plan. ``p`` is a ``stepped`` panel, in which every product has every month."""
    last = p.where("actual is null").withColumn("lag_1", F.coalesce("lag_1", F.lit(0.0)))  # the last month has no next one
    steps: list[Column] = [F.col("lag_1"), F.col("qty")]
    for _ in range(STEPS):
        steps.append(F.greatest(F.lit(ALPHA) * steps[-1] + F.lit(1 - ALPHA) * steps[-2], F.lit(0.0)))
    ahead = F.posexplode(F.array(*steps[2:])).alias("step", "forecast_qty_raw")
    first = F.make_date("fiscal_year", "fiscal_month", F.lit(1))
    return (
        last.select("product_code", "group_name", "color", "avg_unit_price", first.alias("last_month"), ahead)
        .withColumn("period", F.add_months("last_month", F.col("step") + 1))
        .select("product_code", "group_name", "color", "avg_unit_price", F.year("period").alias("fiscal_year"), F.month("period").alias("fiscal_month"), "forecast_qty_raw")
    )


def recursive_ewma_forecast(spark: SparkSession, d: str) -> DataFrame:
    return recursive_forecast(stepped(panel(spark, d)))


def scenarios(spark: SparkSession, d: str) -> DataFrame:
    """Calibrated forecasts with a margin of the error seen, between 5 and 20 percent."""
    return scenarios_of(stepped(panel(spark, d)))


def scenarios_of(p: DataFrame) -> DataFrame:
    test = held_out_of(p)
    smape = metrics(test.select(F.lit("ewma").alias("model"), "actual", F.col(f"`ewma_{ALPHA}`").alias("pred"))).select(F.least(F.lit(0.20), F.greatest(F.lit(0.05), F.col("smape") / 100)).alias("margin"))
    c = calibration_of(test).select(F.col("group_name").alias("g"), "factor")
    f = recursive_forecast(p)
    base = (
        f.join(c, f["group_name"].eqNullSafe(c["g"]), "left")
        .crossJoin(F.broadcast(smape))  # one row
        .withColumn("forecast_qty_base", F.col("forecast_qty_raw") * F.coalesce("factor", F.lit(1.0)))
    )
    cols = {"conservative": 1 - F.col("margin"), "optimistic": 1 + F.col("margin")}
    base = base.withColumns({f"forecast_qty_{k}": F.col("forecast_qty_base") * m for k, m in cols.items()})
    return base.withColumns({f"forecast_revenue_{k}": F.col(f"forecast_qty_{k}") * F.col("avg_unit_price") for k in ("conservative", "base", "optimistic")}).drop("g", "factor", "margin")


_SUMS = [f"forecast_{m}_{k}" for m in ("qty", "revenue") for k in ("conservative", "base", "optimistic")]


def _sums() -> list[Column]:
    return [F.round(F.sum(c), 2).alias(c) for c in _SUMS]


def forecast_monthly(spark: SparkSession, d: str) -> DataFrame:
    return scenarios(spark, d).groupBy("fiscal_year", "fiscal_month").agg(*_sums())


def forecast_group(spark: SparkSession, d: str) -> DataFrame:
    g = scenarios(spark, d).groupBy("group_name").agg(*_sums(), F.countDistinct("product_code").alias("sku_count"))
    return g.withColumn("revenue_share", F.round(F.try_divide(F.col("forecast_revenue_base"), F.sum("forecast_revenue_base").over(Window.partitionBy())), 4))  # groups are few


def forecast_sku(spark: SparkSession, d: str) -> DataFrame:
    return scenarios(spark, d).groupBy("product_code", "group_name", "color").agg(F.round(F.sum("forecast_qty_base"), 4).alias("forecast_qty"), F.round(F.sum("forecast_revenue_base"), 2).alias("forecast_revenue"), F.avg("avg_unit_price").alias("avg_unit_price"))


def sku_rank(spark: SparkSession, d: str) -> DataFrame:
    """Dense ranks by quantity and revenue: distinct values are numbered globally and joined back."""
    f = cut(forecast_sku(spark, d).select("product_code", "forecast_qty", "forecast_revenue"))
    for c, name in (("forecast_qty", "rank_qty"), ("forecast_revenue", "rank_revenue")):
        values = global_row_number(f.select(c).where(F.col(c).isNotNull()).distinct(), [(c, True)], name)
        f = f.join(values, c)
    return f.select("product_code", "rank_qty", "rank_revenue")


def top20_sku(spark: SparkSession, d: str) -> DataFrame:
    """The twenty largest with the reasons that hold, thresholds at the upper quartiles of all."""
    f = cut(forecast_sku(spark, d))  # ranged twice for the quartiles
    q = global_quantiles(f, "forecast_qty", {"q_qty": 0.75}).crossJoin(global_quantiles(f, "forecast_revenue", {"q_rev": 0.75}))  # one row each
    top = f.orderBy(F.col("forecast_qty").desc(), F.col("forecast_revenue").desc(), "product_code").limit(20)
    said = F.concat_ws(", ", F.when(F.col("forecast_qty") >= F.col("q_qty"), "high volume"), F.when(F.col("forecast_revenue") >= F.col("q_rev"), "high revenue"), F.when(F.col("group_name").isNull(), "check master data"))
    return top.crossJoin(F.broadcast(q)).select("product_code", "forecast_qty", "forecast_revenue", F.when(said == "", "stable demand").otherwise(said).alias("reason"))  # q is one row


def actual_plus_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Months as sold and as forecast in one series."""
    p = panel(spark, d)
    sold = p.groupBy("fiscal_year", "fiscal_month").agg(F.round(F.sum("qty"), 2).alias("qty")).withColumn("kind", F.lit("actual"))
    ahead = scenarios_of(stepped(p)).groupBy("fiscal_year", "fiscal_month").agg(F.round(F.sum("forecast_qty_base"), 2).alias("qty")).withColumn("kind", F.lit("forecast"))
    return sold.unionByName(ahead)


def trend_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Per group: the mean of the last three months carried on at the growth over the three before the last,
    kept within -15 and +20 percent."""
    w = Window.partitionBy("group_code").orderBy(F.col("fiscal_year").desc(), F.col("fiscal_month").desc())
    priced = Window.partitionBy("group_code", F.col("avg_unit_price") > 0).orderBy(F.col("fiscal_year").desc(), F.col("fiscal_month").desc())
    m = group_monthly(spark, d).withColumn("r", F.row_number().over(w)).withColumn("pr", F.row_number().over(priced))
    g = m.groupBy("group_code").agg(
        F.avg(F.when(F.col("r") <= 3, F.col("revenue"))).alias("recent"),
        F.max(F.when(F.col("r") == 1, F.col("revenue"))).alias("last"),
        F.avg(F.when(F.col("r").between(2, 4), F.col("revenue"))).alias("prev"),
        F.avg(F.when((F.col("avg_unit_price") > 0) & (F.col("pr") <= 3), F.col("avg_unit_price"))).alias("price"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.make_date("fiscal_year", "fiscal_month", F.lit(1))).alias("last_month"),
    )
    base = F.when(F.col("recent") > 0, F.col("recent")).otherwise(F.col("last"))
    growth = F.when((F.col("n") >= 4) & (F.col("prev") > 0), (base - F.col("prev")) / F.col("prev")).otherwise(0.0)
    g = g.withColumn("base", base).withColumn("growth", F.least(F.lit(0.20), F.greatest(F.lit(-0.15), growth)))
    x = g.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(STEPS)))).withColumn("period", F.add_months("last_month", F.col("step")))
    revenue = F.greatest(F.col("base") * F.pow(1 + F.col("growth"), F.col("step")), F.lit(0.0))
    margin = F.greatest(F.lit(0.12), F.least(F.lit(0.30), F.abs("growth") + 0.12))
    return x.withColumn("revenue", revenue).withColumn("margin", margin).select(
        "group_code", "period", F.round("revenue", 2).alias("forecast_revenue"), F.round(F.when(F.col("price") > 0, F.col("revenue") / F.col("price")).otherwise(0.0), 4).alias("forecast_qty"),
        F.round(F.col("revenue") * (1 - F.col("margin")), 2).alias("lower_revenue"), F.round(F.col("revenue") * (1 + F.col("margin")), 2).alias("upper_revenue"), F.round("growth", 6).alias("growth"), F.round("margin", 6).alias("margin"),
    )


def group_trend_forecast(spark: SparkSession, d: str) -> DataFrame:
    return trend_forecast(spark, d)


#: What the revenue is shifted by, one at a time.
SENSITIVITY = (("price_plus_5pct", 0.05), ("price_minus_5pct", -0.05), ("volume_plus_10pct", 0.10), ("volume_minus_10pct", -0.10), ("retention_plus_5pct", 0.05), ("retention_minus_5pct", -0.05))


def forecast_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    total = trend_forecast(spark, d).agg(F.sum("forecast_revenue").alias("t"))
    shifts = spark.createDataFrame(list(SENSITIVITY), "scenario string, shift double")
    return shifts.crossJoin(F.broadcast(total)).select("scenario", F.round(F.col("t") * F.col("shift"), 0).alias("revenue_delta"))  # total is one row


def colors(spark: SparkSession, d: str) -> DataFrame:
    """Revenue per colour in the last three months against the three before, or, where those sold nothing at
    all, against the same months a year ago."""
    c = color_monthly(spark, d)
    latest = c.agg(F.max("period").alias("z"))
    x = c.crossJoin(F.broadcast(latest))  # one row
    start = F.add_months("z", -2)
    recent = F.col("period") >= start
    before = (F.col("period") >= F.add_months("z", -5)) & (F.col("period") < start)
    year_ago = F.col("period").between(F.add_months(start, -12), F.add_months("z", -12))
    money = F.col("revenue").cast("decimal(20,2)")
    sums = x.groupBy("color").agg(*[F.coalesce(F.sum(F.when(k, money)), F.lit(0)).cast("double").alias(n) for n, k in (("recent_revenue", recent), ("b", before), ("y", year_ago))])
    silent = reduce(lambda a, b: a & b, [F.sum("b").over(Window.partitionBy()) == 0])  # colours are few
    prev = F.when(silent, F.col("y")).otherwise(F.col("b"))
    t = sums.withColumn("previous_revenue", prev).where((F.col("recent_revenue") != 0) | (F.col("previous_revenue") != 0))
    delta = F.col("recent_revenue") - F.col("previous_revenue")
    pct = F.when(F.col("previous_revenue") > 0, delta / F.col("previous_revenue")).when(F.col("recent_revenue") > 0, 1.0).otherwise(0.0)
    return t.select("color", "recent_revenue", "previous_revenue", F.round(delta, 2).alias("trend_delta"), pct.alias("trend_pct"))


def color_trend(spark: SparkSession, d: str) -> DataFrame:
    return colors(spark, d)


def rising_colors(spark: SparkSession, d: str) -> DataFrame:
    return colors(spark, d).where("recent_revenue > 0").orderBy(F.col("trend_delta").desc(), F.col("recent_revenue").desc(), "color").limit(3)


def declining_colors(spark: SparkSession, d: str) -> DataFrame:
    return colors(spark, d).where("previous_revenue > 0").orderBy("trend_delta", "recent_revenue", "color").limit(3)


QUERIES = {
    f.__name__: f
    for f in (
        benchmark_predictions, forecast_metrics, topk_hit_rate, selected_model, group_calibration, recursive_ewma_forecast, forecast_monthly, forecast_group, forecast_sku, sku_rank,
        top20_sku, actual_plus_forecast, group_trend_forecast, forecast_sensitivity, color_trend, rising_colors, declining_colors,
    )
}

_W = "over (partition by product_code order by fiscal_year, fiscal_month)"
_WK = "over (partition by product_code order by fiscal_year, fiscal_month rows between {0} preceding and 1 preceding)"
_EWMA = ", ".join(f"greatest({a}::double * qty + {1 - a!r}::double * coalesce(lag_1, 0), 0) as \"ewma_{a}\"" for a in ALPHAS)
_LONG = " union all ".join(f"select '{m}' as model, product_code, fiscal_year, actual, \"{m}\" as pred from test" for m in MODELS)
BENCH_SQL = f"""{PANEL_SQL}, lagged as (select *, lag(qty) {_W} as lag_1, lead(qty) {_W} as actual, avg(qty) {_WK.format(2)} as mean_2, avg(qty) {_WK.format(3)} as mean_3 from panel),
    bench as (select product_code, group_name, fiscal_year, fiscal_month, actual, greatest(qty, 0) as naive, greatest(coalesce(mean_2, 0), 0) as rolling_2m, greatest(coalesce(mean_3, 0), 0) as rolling_3m, {_EWMA} from lagged where actual is not null),
    test as (select * from bench where fiscal_month = {TEST_MONTH}), rows_ as ({_LONG}),
    met as (select model, round(avg(abs(pred - actual)), 4) as mae, round(sqrt(avg((pred - actual) * (pred - actual))), 4) as rmse, round(coalesce(avg(abs((pred - actual) / nullif(actual, 0))) * 100, 0), 4) as mape,
        round(coalesce(sum(abs(pred - actual)) / nullif(sum(actual), 0) * 100, 0), 4) as wmape,
        round(avg(case when abs(actual) + abs(pred) = 0 then 0 else abs(pred - actual) / ((abs(actual) + abs(pred)) / 2) end) * 100, 4) as smape,
        round(coalesce(sum(pred - actual) / nullif(sum(actual), 0) * 100, 0), 4) as bias_pct,
        round(coalesce(1 - sum((pred - actual) * (pred - actual)) / nullif(sum(actual * actual) - sum(actual) * sum(actual) / count(*), 0), 0), 6) as r2, round(sum(actual), 2) as actual_total, round(sum(pred), 2) as pred_total
        from rows_ group by 1),
    cal0 as (select group_name, round(sum(actual), 4) as actual_qty, round(sum("ewma_{ALPHA}"), 4) as pred_qty from test group by 1),
    cal as (select *, case when pred_qty > 0 then actual_qty / pred_qty else 1.0 end as raw_factor, least(1.1, greatest(0.9, 1 + 0.5 * (case when pred_qty > 0 then actual_qty / pred_qty else 1.0 end - 1))) as factor from cal0)"""
_A, _B = f"{ALPHA}::double", f"{1 - ALPHA!r}::double"
FUTURE_SQL = f"""{BENCH_SQL}, tip as (select *, coalesce(lag_1, 0) as l1, row_number() over (partition by product_code order by fiscal_year desc, fiscal_month desc) as r from lagged),
    s1 as (select *, greatest({_A} * qty + {_B} * l1, 0) as f1 from tip where r = 1), s2 as (select *, greatest({_A} * f1 + {_B} * qty, 0) as f2 from s1), s3 as (select *, greatest({_A} * f2 + {_B} * f1, 0) as f3 from s2),
    rec as (select product_code, group_name, color, avg_unit_price, year(p)::int as fiscal_year, month(p)::int as fiscal_month, raw as forecast_qty_raw from (
        select *, make_date(fiscal_year, fiscal_month, 1) + interval 1 month as p, f1 as raw from s3 union all select *, make_date(fiscal_year, fiscal_month, 1) + interval 2 month, f2 from s3
        union all select *, make_date(fiscal_year, fiscal_month, 1) + interval 3 month, f3 from s3) x),
    scen0 as (select rec.*, forecast_qty_raw * coalesce(factor, 1.0) as forecast_qty_base, (select least(0.20, greatest(0.05, smape / 100)) from met where model = 'ewma_{ALPHA}') as margin from rec left join cal on rec.group_name is not distinct from cal.group_name),
    scen1 as (select *, forecast_qty_base * (1 - margin) as forecast_qty_conservative, forecast_qty_base * (1 + margin) as forecast_qty_optimistic from scen0),
    scen as (select *, forecast_qty_conservative * avg_unit_price as forecast_revenue_conservative, forecast_qty_base * avg_unit_price as forecast_revenue_base, forecast_qty_optimistic * avg_unit_price as forecast_revenue_optimistic from scen1),
    fsku as (select product_code, group_name, color, round(sum(forecast_qty_base), 4) as forecast_qty, round(sum(forecast_revenue_base), 2) as forecast_revenue, avg(avg_unit_price) as avg_unit_price from scen group by 1, 2, 3)"""
_SQL_SUMS = ", ".join(f"round(sum({c}), 2) as {c}" for c in _SUMS)
_RANKED = "ranked as (select *, row_number() over (partition by model order by actual desc, product_code, fiscal_year) as ra, row_number() over (partition by model order by pred desc, product_code, fiscal_year) as rp from rows_)"
TREND_SQL = f"""{GROUP_SQL}, m as (select *, row_number() over (partition by group_code order by fiscal_year desc, fiscal_month desc) as r, row_number() over (partition by group_code, avg_unit_price > 0 order by fiscal_year desc, fiscal_month desc) as pr from gm),
    g as (select group_code, avg(revenue) filter (where r <= 3) as recent, max(revenue) filter (where r = 1) as last, avg(revenue) filter (where r between 2 and 4) as prev, avg(avg_unit_price) filter (where avg_unit_price > 0 and pr <= 3) as price, count(*) as n, max(make_date(fiscal_year, fiscal_month, 1)) as last_month from m group by 1),
    b as (select *, case when recent > 0 then recent else last end as base from g),
    gr as (select *, least(0.20, greatest(-0.15, case when n >= 4 and prev > 0 then (base - prev) / prev else 0 end)) as growth from b),
    x as (select gr.*, step, greatest(base * pow(1 + growth, step), 0) as revenue, greatest(0.12, least(0.30, abs(growth) + 0.12)) as margin from gr cross join (select unnest([1, 2, 3]) as step) s),
    trend as (select group_code, (last_month + to_months(step))::date as period, round(revenue, 2) as forecast_revenue, round(case when price > 0 then revenue / price else 0 end, 4) as forecast_qty, round(revenue * (1 - margin), 2) as lower_revenue, round(revenue * (1 + margin), 2) as upper_revenue, round(growth, 6) as growth, round(margin, 6) as margin from x)"""
COLORS_SQL = f"""{COLOR_SQL}, z as (select max(period) as z from cm),
    cs as (select color, coalesce(sum(revenue::decimal(20,2)) filter (where period >= z - interval 2 month), 0)::double as recent_revenue, coalesce(sum(revenue::decimal(20,2)) filter (where period >= z - interval 5 month and period < z - interval 2 month), 0)::double as b,
        coalesce(sum(revenue::decimal(20,2)) filter (where period >= z - interval 14 month and period <= z - interval 12 month), 0)::double as y from cm, z group by 1),
    ct as (select color, recent_revenue, case when sum(b) over () = 0 then y else b end as previous_revenue from cs),
    colors as (select color, recent_revenue, previous_revenue, round(recent_revenue - previous_revenue, 2) as trend_delta, case when previous_revenue > 0 then (recent_revenue - previous_revenue) / previous_revenue when recent_revenue > 0 then 1.0 else 0.0 end as trend_pct from ct where recent_revenue <> 0 or previous_revenue <> 0)"""

ORACLES = {
    "benchmark_predictions": f"with {BENCH_SQL} select * from rows_",
    "forecast_metrics": f"with {BENCH_SQL} select * from met",
    "topk_hit_rate": f"with {BENCH_SQL}, {_RANKED} select model, (count(*) filter (where ra <= 10 and rp <= 10))::double / 10 as top10_hit_rate, (count(*) filter (where ra <= 20 and rp <= 20))::double / 20 as top20_hit_rate from ranked group by 1",
    "selected_model": f"with {BENCH_SQL}, {_RANKED}, h as (select model, (count(*) filter (where ra <= 20 and rp <= 20))::double / 20 as top20_hit_rate from ranked group by 1) select model, wmape, mae, rmse, smape, top20_hit_rate from met join h using (model) order by wmape, mae, rmse, top20_hit_rate desc, model limit 1",
    "group_calibration": f"with {BENCH_SQL} select * from cal",
    "recursive_ewma_forecast": f"with {FUTURE_SQL} select * from rec",
    "forecast_monthly": f"with {FUTURE_SQL} select fiscal_year, fiscal_month, {_SQL_SUMS} from scen group by 1, 2",
    "forecast_group": f"with {FUTURE_SQL}, g as (select group_name, {_SQL_SUMS}, count(distinct product_code) as sku_count from scen group by 1) select *, round(forecast_revenue_base / nullif(sum(forecast_revenue_base) over (), 0), 4) as revenue_share from g",
    "forecast_sku": f"with {FUTURE_SQL} select * from fsku",
    "sku_rank": f"with {FUTURE_SQL} select product_code, dense_rank() over (order by forecast_qty desc) as rank_qty, dense_rank() over (order by forecast_revenue desc) as rank_revenue from fsku",
    "top20_sku": f"""with {FUTURE_SQL}, q as (select quantile_cont(forecast_qty, 0.75) as q_qty, quantile_cont(forecast_revenue, 0.75) as q_rev from fsku),
        t as (select * from fsku order by forecast_qty desc, forecast_revenue desc, product_code limit 20)
        select product_code, forecast_qty, forecast_revenue, coalesce(nullif(concat_ws(', ', case when forecast_qty >= q_qty then 'high volume' end, case when forecast_revenue >= q_rev then 'high revenue' end, case when group_name is null then 'check master data' end), ''), 'stable demand') as reason from t, q""",
    "actual_plus_forecast": f"with {FUTURE_SQL} select fiscal_year, fiscal_month, round(sum(qty), 2) as qty, 'actual' as kind from panel group by 1, 2 union all select fiscal_year, fiscal_month, round(sum(forecast_qty_base), 2), 'forecast' from scen group by 1, 2",
    "group_trend_forecast": f"with {TREND_SQL} select * from trend",
    "forecast_sensitivity": f"with {TREND_SQL}, t as (select sum(forecast_revenue) as t from trend) select scenario, round(t * shift, 0) as revenue_delta from t, (values " + ", ".join(f"('{n}', {v}::double)" for n, v in SENSITIVITY) + ") as s(scenario, shift)",
    "color_trend": f"with {COLORS_SQL} select * from colors",
    "rising_colors": f"with {COLORS_SQL} select * from colors where recent_revenue > 0 order by trend_delta desc, recent_revenue desc, color limit 3",
    "declining_colors": f"with {COLORS_SQL} select * from colors where previous_revenue > 0 order by trend_delta, recent_revenue, color limit 3",
}
