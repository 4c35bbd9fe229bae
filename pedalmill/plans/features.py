"""Feature frames: SKU by month, group by month, colours and customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from pedalmill.operators.global_rank import global_quantiles, global_row_number, quantile_bin
from pedalmill.plans.fact import FACT_SQL, davg, dsum, fact_sales, orders
from pedalmill.session import cut
from pedalmill.sources.tables import table

_MONTHS = ["fiscal_year", "fiscal_month"]


def by_sku() -> WindowSpec:
    return Window.partitionBy("product_code").orderBy(*_MONTHS)


def growth(now: Column, before: Column, default: float | None = 0.0) -> Column:
    """(now - before) / before where before is positive, else ``default``."""
    return F.when(before > 0, (now - before) / before).otherwise(F.lit(default))


#: Parts into which a product's month is spread by customer.
SALTS = 64


def sku_monthly(fact: DataFrame) -> DataFrame:
    """Per product and month: qty, revenue, order_count, active_dealer_count, group_name, color and prices, the
    positive unit prices with their numbers of lines.

    Lines move once, by product, month and a salt of the customer, so that a hot product is spread over months and
    salts. Within these parts orders, then customers, then all are added up without moving again: an order has
    one customer and a customer one salt, so the counts of the parts add up. Sums are of hundredths, as integers.
    """
    month = ["product_code", *_MONTHS]
    cents = lambda c: (F.col(c) * 100).cast("bigint")
    salt = F.pmod(F.xxhash64("customer_code"), F.lit(SALTS)).cast("int").alias("s")
    lines = fact.where("product_code is not null").select(*month, "group_code", "color", "customer_code", "order_id", cents("quantity").alias("q"), cents("line_total").alias("r"), cents("unit_price").alias("p"), salt)
    # a line counts under its order, and under its price and labels; as keys, not as maxima, for those would be sorted
    kind = "struct<sold:boolean,c:string,o:bigint,p:bigint,g:string,k:string>"
    by_order = F.struct(F.lit(True), F.col("customer_code"), F.col("order_id"), F.lit(None), F.lit(None), F.lit(None)).cast(kind)
    by_label = F.struct(F.lit(False), F.lit(None), F.lit(None), F.when(F.col("p") > 0, F.col("p")), F.col("group_code"), F.col("color")).cast(kind)
    part = [*month, "s"]
    both = lines.repartition(*part).withColumn("x", F.explode(F.array(by_order, by_label))).select(*part, "q", "r", "x.*")
    label = ["sold", "p", "g", "k"]
    sums = lambda *more: [F.sum(c).alias(c) for c in ("q", "r", *more)]
    orders_ = both.groupBy(*part, *label, "c", "o").agg(*sums(), F.count(F.lit(1)).alias("n"))
    dealers = orders_.groupBy(*part, *label, "c").agg(*sums("n"), F.count(F.lit(1)).alias("o"))
    sold = F.col("sold")
    once = [F.sum(F.when(sold, F.col(c))).alias(c) for c in ("q", "r", "o")]
    prices = F.collect_list(F.when(F.col("p").isNotNull(), F.struct((F.col("p") / 100).alias("price"), "n"))).alias("prices")
    salted = dealers.groupBy(*part).agg(*once, F.count_if(sold).alias("c"), F.max("g").alias("group_code"), F.max("k").alias("color"), prices)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return salted.groupBy(*month).agg(
        (total("q").cast("double") / 100).alias("qty"), (total("r").cast("double") / 100).alias("revenue"), total("o").alias("order_count"), F.sum("c").alias("active_dealer_count"),
        F.max("group_code").alias("group_name"), F.max("color").alias("color"), F.flatten(F.collect_list("prices")).alias("prices"),
    )


def sku_sold(fact: DataFrame) -> DataFrame:
    """``sku_monthly`` without order_count and active_dealer_count. Orders and customers need not be told apart then,
    so lines are added up before they move, and not doubled."""
    month = ["product_code", *_MONTHS]
    cents = lambda c: (F.col(c) * 100).cast("bigint")
    lines = fact.where("product_code is not null").select(*month, "group_code", "color", cents("quantity").alias("q"), cents("line_total").alias("r"), cents("unit_price").alias("p"))
    alike = lines.groupBy(*month, "group_code", "color", F.when(F.col("p") > 0, F.col("p")).alias("p")).agg(F.sum("q").alias("q"), F.sum("r").alias("r"), F.count(F.lit(1)).alias("n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double") / 100
    prices = F.collect_list(F.when(F.col("p").isNotNull(), F.struct((F.col("p") / 100).alias("price"), "n")))
    return alike.groupBy(*month).agg(total("q").alias("qty"), total("r").alias("revenue"), F.max("group_code").alias("group_name"), F.max("color").alias("color"), prices.alias("prices"))


def months_sold(spark: SparkSession, d: str) -> DataFrame:
    """``sku_monthly`` of the whole fact, written once; all panels and forecasts read it instead of the fact."""
    return cut(sku_monthly(fact_sales(spark, d)))


def priced_products(sold: DataFrame, *more: Column) -> tuple[DataFrame, DataFrame]:
    """(products with group, colour, ``more`` aggregates and the median of their prices, one row with the median of all)."""
    priced = sold.select("product_code", F.inline("prices"))
    own = priced.groupBy("product_code").agg(F.percentile("price", F.lit(0.5), F.col("n")).alias("own_price"))
    every = global_quantiles(priced, "price", {"all_price": 0.5}, "n")
    return sold.groupBy("product_code").agg(F.max("group_name").alias("group_name"), F.max("color").alias("color"), *more).join(own, "product_code", "left"), every


def panel_of(sold: DataFrame) -> DataFrame:
    """Every product with every observed month; months without sales have zeros. avg_unit_price is revenue
    by quantity, else the product's median price, else the median of all, else 0. ``sold`` is of ``months_sold``."""
    months = sold.select(*_MONTHS).distinct()
    products, every = priced_products(sold)
    # the calendar of observed months: at most 12 rows per year of history, so broadcast is bounded
    grid = products.crossJoin(F.broadcast(months)).crossJoin(F.broadcast(every))
    zero = {c: F.coalesce(c, F.lit(0.0)) for c in ("qty", "revenue")} | {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("order_count", "active_dealer_count")}
    price = F.when(F.col("qty") > 0, F.col("revenue") / F.col("qty")).otherwise(F.coalesce("own_price", "all_price", F.lit(0.0)))
    return grid.join(sold.drop("group_name", "color", "prices"), ["product_code", *_MONTHS], "left").withColumns(zero).withColumn("avg_unit_price", price).drop("own_price", "all_price")


def panel(spark: SparkSession, d: str) -> DataFrame:
    return panel_of(months_sold(spark, d))


def sku_month_panel(spark: SparkSession, d: str) -> DataFrame:
    return panel(spark, d)


def sku_price_fallback(spark: SparkSession, d: str) -> DataFrame:
    return panel(spark, d).where("qty = 0").groupBy("product_code").agg(F.max("avg_unit_price").alias("fallback_price"))


def sku_lags(spark: SparkSession, d: str) -> DataFrame:
    """Lags step over observed months, not over the calendar."""
    p = panel(spark, d)
    lags = {f"{c}_lag_{k}": F.lag(c, k).over(by_sku()) for c in ("qty", "revenue") for k in (1, 2)}
    return p.select("product_code", *_MONTHS, "qty", *[c.alias(n) for n, c in lags.items()], F.lead("qty").over(by_sku()).alias("qty_next_month"))


def sku_rolling(spark: SparkSession, d: str) -> DataFrame:
    """Means of the two and three months before, and growth on the month before."""
    p = panel(spark, d)
    means = {f"rolling_{k}m_qty": F.round(F.avg("qty").over(by_sku().rowsBetween(-k, -1)), 6) for k in (2, 3)}
    mom = growth(F.col("qty"), F.lag("qty").over(by_sku()))
    return p.select("product_code", *_MONTHS, *[c.alias(n) for n, c in means.items()], mom.alias("mom_qty_growth"))


def with_year_before(p: DataFrame, sold: DataFrame) -> DataFrame:
    """``p``, a panel, with the same month of the year before, by an equi join on the shifted year with what was sold."""
    last = sold.select("product_code", (F.col("fiscal_year") + 1).alias("fiscal_year"), "fiscal_month", F.col("qty").alias("q0"), F.col("revenue").alias("r0"))
    return p.join(last, ["product_code", *_MONTHS], "left").withColumns(
        {
            "same_month_qty_last_year": F.coalesce("q0", F.lit(0.0)), "same_month_revenue_last_year": F.coalesce("r0", F.lit(0.0)), "has_sku_yoy": (F.coalesce("q0", F.lit(0.0)) > 0).cast("int"),
            "sku_yoy_qty_growth": growth(F.col("qty"), F.col("q0")), "sku_yoy_revenue_growth": growth(F.col("revenue"), F.col("r0")),
        }
    ).drop("q0", "r0")


def sku_yoy(spark: SparkSession, d: str) -> DataFrame:
    sold = months_sold(spark, d)
    return with_year_before(panel_of(sold), sold).select("product_code", *_MONTHS, "same_month_qty_last_year", "same_month_revenue_last_year", "has_sku_yoy", "sku_yoy_qty_growth", "sku_yoy_revenue_growth")


def with_group_share(p: DataFrame) -> DataFrame:
    """``p``, a panel, with the product's share of its group's month. Group totals are aggregated and joined back, so
    a large group is no large window; groups by month are few."""
    totals = p.groupBy(*_MONTHS, "group_name").agg(F.sum(F.col("qty").cast("decimal(20,2)")).cast("double").alias("group_month_qty"), F.sum(F.col("revenue").cast("decimal(20,2)")).cast("double").alias("group_month_revenue"))
    t = totals.withColumnsRenamed({"group_name": "g", "fiscal_year": "y", "fiscal_month": "m"})
    j = p.join(t, (F.col("fiscal_year") == F.col("y")) & (F.col("fiscal_month") == F.col("m")) & F.col("group_name").eqNullSafe(F.col("g")), "left").drop("y", "m", "g")
    return j.withColumns({f"sku_{c}_share_in_group": F.when(F.col(f"group_month_{c}") > 0, F.col(c) / F.col(f"group_month_{c}")).otherwise(0.0) for c in ("qty", "revenue")})


def sku_share_in_group(spark: SparkSession, d: str) -> DataFrame:
    return with_group_share(panel(spark, d)).select("product_code", *_MONTHS, "group_month_qty", "group_month_revenue", "sku_qty_share_in_group", "sku_revenue_share_in_group")


def with_outlier_flag(p: DataFrame) -> DataFrame:
    """``p``, a panel, with outlier_flag: a month outside 1.5 interquartile ranges of the product's own, where it has
    four months and a range."""
    q = p.groupBy("product_code").agg(F.percentile("qty", F.lit(0.25)).alias("q1"), F.percentile("qty", F.lit(0.75)).alias("q3"), F.count(F.lit(1)).alias("n"))
    iqr = F.col("q3") - F.col("q1")
    out = (F.col("n") >= 4) & (iqr > 0) & ((F.col("qty") < F.col("q1") - 1.5 * iqr) | (F.col("qty") > F.col("q3") + 1.5 * iqr))
    return p.join(q, "product_code").withColumn("outlier_flag", out.cast("int")).drop("q1", "q3", "n")


def sku_outlier_flag(spark: SparkSession, d: str) -> DataFrame:
    return with_outlier_flag(panel(spark, d)).select("product_code", *_MONTHS, "outlier_flag")


# What counts as no value in a label, and the year from which on a product first sold is new.
NO_LABEL, UNKNOWN, NEW_SINCE = ("", "<NA>", "Unknown"), "Unknown", 2001


def labelled(column: str) -> Column:
    return F.when(F.coalesce(F.trim(column), F.lit("")).isin(*NO_LABEL), UNKNOWN).otherwise(F.col(column))


def sku_panel_features(spark: SparkSession, d: str, new_since: int = NEW_SINCE) -> DataFrame:
    """The whole feature frame of the models: the panel with lags, means of past months, growth, group shares, the
    year before, labels without gaps, flags of what is missing or odd, and the next month's quantity.

    Quality flags: a missing group or colour, either of them as missing master data, no usable price or negative
    figures, a first sale in ``new_since`` or later, an outlier month.
    """
    sold = months_sold(spark, d)
    first = sold.where("qty > 0").groupBy("product_code").agg(F.min("fiscal_year").alias("first_sale_year"))
    p = with_outlier_flag(with_group_share(with_year_before(panel_of(sold), sold))).join(first, "product_code", "left")
    w = by_sku()
    lags = {f"{c}_lag_{k}": F.coalesce(F.lag(c, k).over(w), F.lit(0.0)) for c in ("qty", "revenue") for k in (1, 2)}
    means = {f"{c}_rolling_{k}": F.round(F.coalesce(F.avg(c).over(w.rowsBetween(-k, -1)), F.lit(0.0)), 6) for c in ("qty", "revenue") for k in (2, 3)}
    mom = {f"mom_{c}_growth": growth(F.col(c), F.lag(c).over(w)) for c in ("qty", "revenue")}
    no_group, no_color = F.col("group_name") == UNKNOWN, F.col("color") == UNKNOWN
    odd = (F.col("qty") < 0) | (F.col("revenue") < 0) | (F.col("avg_unit_price") <= 0)
    flags = {"missing_group_flag": no_group, "missing_color_flag": no_color, "missing_master_flag": no_group | no_color, "numeric_issue_flag": odd, "new_sku_flag": F.coalesce(F.col("first_sale_year") >= new_since, F.lit(False))}
    ahead = {"qty_next_month": F.lead("qty").over(w)}
    p = p.withColumns(lags | means | mom | ahead).withColumns({c: labelled(c) for c in ("group_name", "color")})
    period = F.concat_ws("-", F.col("fiscal_year").cast("string"), F.lpad(F.col("fiscal_month").cast("string"), 2, "0"))
    return p.withColumns({n: c.cast("int") for n, c in flags.items()}).withColumn("period", period).drop("first_sale_year")


def group_monthly(spark: SparkSession, d: str) -> DataFrame:
    return fact_sales(spark, d).groupBy(*_MONTHS, "group_code").agg(
        dsum("quantity").alias("qty"), dsum("line_total").alias("revenue"), F.countDistinct("order_id").alias("order_count"), F.countDistinct("customer_code").alias("active_customer_count"), davg("unit_price").alias("avg_unit_price")
    )


def monthly_group_features(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("group_code").orderBy(*_MONTHS)
    m = group_monthly(spark, d)
    cols = {}
    for c in ("qty", "revenue"):
        cols |= {f"{c}_lag_{k}": F.coalesce(F.lag(c, k).over(w), F.lit(0.0)) for k in (1, 2)}
        cols[f"{c}_rolling_3"] = F.round(F.coalesce(F.avg(c).over(w.rowsBetween(-3, -1)), F.lit(0.0)), 4)
    angle = 2 * F.pi() * F.col("fiscal_month") / 12
    return m.withColumns(cols).withColumns({"month_sin": F.round(F.sin(angle), 6) + 0.0, "month_cos": F.round(F.cos(angle), 6) + 0.0}).withColumn("period", F.make_date("fiscal_year", "fiscal_month", F.lit(1)))


def color_monthly(spark: SparkSession, d: str) -> DataFrame:
    return fact_sales(spark, d).groupBy(*_MONTHS, F.coalesce("color", F.lit("UNKNOWN")).alias("color")).agg(dsum("quantity").alias("qty"), dsum("line_total").alias("revenue"), F.countDistinct("order_id").alias("order_count")).withColumn(
        "period", F.make_date("fiscal_year", "fiscal_month", F.lit(1))
    )


def color_features(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("color").orderBy("period")
    return color_monthly(spark, d).withColumns(
        {"revenue_lag_1": F.coalesce(F.lag("revenue").over(w), F.lit(0.0)), "revenue_rolling_3": F.round(F.coalesce(F.avg("revenue").over(w.rowsBetween(-3, -1)), F.lit(0.0)), 4)}
    )


def order_facts(spark: SparkSession, d: str) -> DataFrame:
    return fact_sales(spark, d).groupBy("customer_code", "so_number").agg(F.min("order_date").alias("order_date"), F.max("region").alias("region"), dsum("line_total").alias("order_revenue"))


def customer_orders(spark: SparkSession, d: str) -> DataFrame:
    """Lines to orders to customers, in two steps."""
    return order_facts(spark, d).groupBy("customer_code").agg(
        F.max("region").alias("region"), F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"), F.count("so_number").alias("order_frequency"),
        F.sum(F.col("order_revenue").cast("decimal(20,2)")).cast("double").alias("total_revenue"), (F.sum(F.col("order_revenue").cast("decimal(20,2)")).cast("double") / F.count(F.lit(1))).alias("avg_order_value"),
    )


def features_of_customers(spark: SparkSession, d: str) -> DataFrame:
    """Customer features with the last 90 days and the 90 before, counted back from the last order of all."""
    o = order_facts(spark, d)
    snap = orders(spark, d).join(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id")), "order_id", "left_semi").agg(F.max("order_date").alias("snapshot_date"))
    x = o.crossJoin(F.broadcast(snap))  # one row
    recent = F.col("order_date") > F.date_sub("snapshot_date", 90)
    previous = (F.col("order_date") > F.date_sub("snapshot_date", 180)) & ~recent
    money = F.col("order_revenue").cast("decimal(20,2)")
    c = x.groupBy("customer_code", "snapshot_date").agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"), F.count("so_number").alias("order_frequency"), F.sum(money).cast("double").alias("total_revenue"),
        F.coalesce(F.sum(F.when(recent, money)), F.lit(0)).cast("double").alias("recent_90d_revenue"), F.count_if(recent).alias("recent_90d_orders"), F.coalesce(F.sum(F.when(previous, money)), F.lit(0)).cast("double").alias("previous_90d_revenue"),
    )
    was, now = F.col("previous_90d_revenue"), F.col("recent_90d_revenue")
    trend = F.when(was > 0, (now - was) / was).when(now > 0, 1.0).otherwise(0.0)
    return c.withColumn("days_since_last_order", F.datediff("snapshot_date", "last_order_date")).withColumn("revenue_trend", trend)


def scored_customers(spark: SparkSession, d: str) -> DataFrame:
    """Quintiles of ranks, first come first in ties (by customer_code); rfm_score is 3 to 15."""
    c = cut(features_of_customers(spark, d))  # counted, and ranked three times
    c = c.crossJoin(F.broadcast(c.agg(F.count(F.lit(1)).alias("n"))))  # n is one row
    for key, name in (("days_since_last_order", "recency_score"), ("order_frequency", "frequency_score"), ("total_revenue", "monetary_score")):
        c = global_row_number(c, [(key, False), ("customer_code", False)]).withColumn(name, quantile_bin(F.col("rn"), F.col("n"), 5)).drop("rn")
    return c.drop("n").withColumn("rfm_score", 6 - F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))


def customer_features(spark: SparkSession, d: str) -> DataFrame:
    return features_of_customers(spark, d)


def customer_rfm_qcut(spark: SparkSession, d: str) -> DataFrame:
    return scored_customers(spark, d).select("customer_code", "recency_score", "frequency_score", "monetary_score", "rfm_score")


def rfm_features(spark: SparkSession, d: str) -> DataFrame:
    """Recency, log frequency and log revenue, and their z-scores; population deviation."""
    o = orders(spark, d).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("frequency"), F.max("order_date").alias("last"))
    spent = fact_sales(spark, d).groupBy(F.col("customer_code")).agg(dsum("line_total").alias("monetary"))
    snap = orders(spark, d).agg(F.max("order_date").alias("snapshot"))
    base = (
        table(spark, d, "customer").select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").join(spent, F.col("c_custkey").cast("string") == F.col("customer_code"), "left")
        .crossJoin(F.broadcast(snap))  # one row
        .select(
            F.col("c_custkey").cast("string").alias("customer_code"), F.coalesce(F.datediff("snapshot", "last"), F.lit(9999)).alias("recency_days"),
            F.log1p(F.coalesce("frequency", F.lit(0)).cast("double")).alias("log_frequency"), F.log1p(F.coalesce("monetary", F.lit(0.0))).alias("log_monetary"),
        )
    )
    three = ("recency_days", "log_frequency", "log_monetary")
    stats = base.agg(*[f(F.col(c).cast("double")).alias(f"{k}_{c}") for c in three for k, f in (("m", F.avg), ("s", F.stddev_pop))])
    z = {f"z_{c}": F.round(F.try_divide(F.col(c) - F.col(f"m_{c}"), F.col(f"s_{c}")), 4) for c in three}
    return base.crossJoin(F.broadcast(stats)).select("customer_code", "recency_days", F.round("log_frequency", 6).alias("log_frequency"), F.round("log_monetary", 6).alias("log_monetary"), *[c.alias(n) for n, c in z.items()])  # stats is one row


def weekly_summary(o: DataFrame, end: str) -> DataFrame:
    """(customer_code, frequency, recency, age, n_orders): weeks (Monday to Sunday) with a purchase less the
    first, weeks from the first to the last, weeks from the first to ``end``; later purchases do not count."""
    last = F.lit(end).cast("date")
    w = o.where(F.col("order_date") <= last).withColumn("week", F.date_trunc("week", F.col("order_date").cast("timestamp")).cast("date"))
    whole = F.datediff(F.date_trunc("week", last.cast("timestamp")).cast("date"), F.min("week"))
    return w.groupBy("customer_code").agg(
        (F.countDistinct("week") - 1).alias("frequency"), (F.datediff(F.max("week"), F.min("week")) / 7).cast("int").alias("recency"), (whole / 7).cast("int").alias("age"), F.countDistinct("so_number").alias("n_orders")
    )


OBSERVED_UNTIL = "2000-12-31"


def bgnbd_summary(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d).select(F.col("o_custkey").cast("string").alias("customer_code"), "so_number", "order_date")
    return weekly_summary(o, OBSERVED_UNTIL)


QUERIES = {
    f.__name__: f
    for f in (
        sku_month_panel, sku_price_fallback, sku_lags, sku_rolling, sku_yoy, sku_share_in_group, sku_outlier_flag, sku_panel_features, monthly_group_features, color_features,
        customer_orders, customer_features, customer_rfm_qcut, rfm_features, bgnbd_summary,
    )
}

#: The panel for DuckDB, after FACT_SQL.
PANEL_SQL = f"""{FACT_SQL},
    pf as materialized (select * from fact where product_code is not null),
    pm as (select product_code, fiscal_year, fiscal_month, sum(quantity)::double as qty, sum(line_total)::double as revenue, count(distinct so_number) as order_count, count(distinct customer_code) as active_dealer_count from pf group by 1, 2, 3),
    pp as (select product_code, max(group_code) as group_name, max(color) as color, median(unit_price::double) filter (where unit_price > 0) as own_price from pf group by 1),
    panel as materialized (select p.product_code, p.group_name, p.color, m.fiscal_year, m.fiscal_month, coalesce(x.qty, 0) as qty, coalesce(x.revenue, 0) as revenue, coalesce(x.order_count, 0) as order_count,
        coalesce(x.active_dealer_count, 0) as active_dealer_count,
        case when x.qty > 0 then x.revenue / x.qty else coalesce(p.own_price, (select median(unit_price::double) from pf where unit_price > 0), 0) end as avg_unit_price
        from pp p cross join (select distinct fiscal_year, fiscal_month from pf) m left join pm x on x.product_code = p.product_code and x.fiscal_year = m.fiscal_year and x.fiscal_month = m.fiscal_month)"""
_W = "over (partition by product_code order by fiscal_year, fiscal_month)"
_WK = "over (partition by product_code order by fiscal_year, fiscal_month rows between {0} preceding and 1 preceding)"
ORDERS_SQL = f"{FACT_SQL}, ofact as (select customer_code, so_number, min(order_date) as order_date, max(region) as region, sum(line_total) as order_revenue from fact group by 1, 2)"
CUSTOMERS_SQL = f"""{ORDERS_SQL}, snap as (select max(order_date) as snapshot_date from ofact),
    cust as (select customer_code, snapshot_date, min(order_date) as first_order_date, max(order_date) as last_order_date, count(so_number) as order_frequency, sum(order_revenue)::double as total_revenue,
        coalesce(sum(order_revenue) filter (where order_date > snapshot_date - 90), 0)::double as recent_90d_revenue, count(*) filter (where order_date > snapshot_date - 90) as recent_90d_orders,
        coalesce(sum(order_revenue) filter (where order_date > snapshot_date - 180 and order_date <= snapshot_date - 90), 0)::double as previous_90d_revenue from ofact, snap group by 1, 2),
    feat as (select *, date_diff('day', last_order_date, snapshot_date)::int as days_since_last_order,
        case when previous_90d_revenue > 0 then (recent_90d_revenue - previous_90d_revenue) / previous_90d_revenue when recent_90d_revenue > 0 then 1.0 else 0.0 end as revenue_trend from cust)"""


def _bin(key: str) -> str:
    return f"greatest(1, ceil(5 * (row_number() over (order by {key}, customer_code) - 1) / greatest(count(*) over () - 1, 1)))::int"


SCORED_SQL = f"""{CUSTOMERS_SQL}, bins as (select *, {_bin('days_since_last_order')} as recency_score, {_bin('order_frequency')} as frequency_score, {_bin('total_revenue')} as monetary_score from feat),
    scored as (select *, 6 - recency_score + frequency_score + monetary_score as rfm_score from bins)"""
GROUP_SQL = f"{FACT_SQL}, gm as (select fiscal_year, fiscal_month, group_code, sum(quantity)::double as qty, sum(line_total)::double as revenue, count(distinct so_number) as order_count, count(distinct customer_code) as active_customer_count, sum(unit_price)::double / count(unit_price) as avg_unit_price from fact group by 1, 2, 3)"
COLOR_SQL = f"{FACT_SQL}, cm as (select fiscal_year, fiscal_month, coalesce(color, 'UNKNOWN') as color, sum(quantity)::double as qty, sum(line_total)::double as revenue, count(distinct so_number) as order_count, make_date(fiscal_year, fiscal_month, 1) as period from fact group by 1, 2, 3)"
_GW = "over (partition by group_code order by fiscal_year, fiscal_month)"
_G3 = "over (partition by group_code order by fiscal_year, fiscal_month rows between 3 preceding and 1 preceding)"
_Z = ", ".join(f"round(({c} - avg({c}) over ()) / nullif(stddev_pop({c}) over (), 0), 4) as z_{c}" for c in ("recency_days", "log_frequency", "log_monetary"))
_WEEK = f"date_trunc('week', date '{OBSERVED_UNTIL}')"

ORACLES = {
    "sku_month_panel": f"with {PANEL_SQL} select * from panel",
    "sku_price_fallback": f"with {PANEL_SQL} select product_code, max(avg_unit_price) as fallback_price from panel where qty = 0 group by 1",
    "sku_lags": f"with {PANEL_SQL} select product_code, fiscal_year, fiscal_month, qty, lag(qty, 1) {_W} as qty_lag_1, lag(qty, 2) {_W} as qty_lag_2, lag(revenue, 1) {_W} as revenue_lag_1, lag(revenue, 2) {_W} as revenue_lag_2, lead(qty) {_W} as qty_next_month from panel",
    "sku_rolling": f"with {PANEL_SQL} select product_code, fiscal_year, fiscal_month, round(avg(qty) {_WK.format(2)}, 6) as rolling_2m_qty, round(avg(qty) {_WK.format(3)}, 6) as rolling_3m_qty, case when lag(qty) {_W} > 0 then (qty - lag(qty) {_W}) / lag(qty) {_W} else 0 end as mom_qty_growth from panel",
    "sku_yoy": f"""with {PANEL_SQL} select p.product_code, p.fiscal_year, p.fiscal_month, coalesce(l.qty, 0) as same_month_qty_last_year, coalesce(l.revenue, 0) as same_month_revenue_last_year, (coalesce(l.qty, 0) > 0)::int as has_sku_yoy,
        case when l.qty > 0 then (p.qty - l.qty) / l.qty else 0 end as sku_yoy_qty_growth, case when l.revenue > 0 then (p.revenue - l.revenue) / l.revenue else 0 end as sku_yoy_revenue_growth
        from panel p left join panel l on l.product_code = p.product_code and l.fiscal_year + 1 = p.fiscal_year and l.fiscal_month = p.fiscal_month""",
    "sku_share_in_group": f"""with {PANEL_SQL}, g as (select *, (sum(qty::decimal(20,2)) over w)::double as group_month_qty, (sum(revenue::decimal(20,2)) over w)::double as group_month_revenue from panel window w as (partition by fiscal_year, fiscal_month, group_name))
        select product_code, fiscal_year, fiscal_month, group_month_qty, group_month_revenue, case when group_month_qty > 0 then qty / group_month_qty else 0 end as sku_qty_share_in_group, case when group_month_revenue > 0 then revenue / group_month_revenue else 0 end as sku_revenue_share_in_group from g""",
    "sku_outlier_flag": f"""with {PANEL_SQL}, q as (select product_code, quantile_cont(qty, 0.25) as q1, quantile_cont(qty, 0.75) as q3, count(*) as n from panel group by 1)
        select p.product_code, fiscal_year, fiscal_month, (n >= 4 and q3 - q1 > 0 and (qty < q1 - 1.5 * (q3 - q1) or qty > q3 + 1.5 * (q3 - q1)))::int as outlier_flag from panel p join q on p.product_code = q.product_code""",
    "sku_panel_features": f"""with {PANEL_SQL}, q as (select product_code, quantile_cont(qty, 0.25) as q1, quantile_cont(qty, 0.75) as q3, count(*) as n from panel group by 1),
        first as (select product_code, min(fiscal_year) filter (where qty > 0) as y0 from pm group by 1),
        x as (select p.*, coalesce(l.qty, 0) as q0, coalesce(l.revenue, 0) as r0, q1, q3, n, y0,
            (sum(p.qty::decimal(20,2)) over (partition by p.fiscal_year, p.fiscal_month, p.group_name))::double as group_month_qty, (sum(p.revenue::decimal(20,2)) over (partition by p.fiscal_year, p.fiscal_month, p.group_name))::double as group_month_revenue
            from panel p join q on q.product_code = p.product_code join first f on f.product_code = p.product_code left join pm l on l.product_code = p.product_code and l.fiscal_year + 1 = p.fiscal_year and l.fiscal_month = p.fiscal_month)
        select product_code, case when coalesce(trim(group_name), '') in ('', '<NA>') then 'Unknown' else group_name end as group_name, case when coalesce(trim(color), '') in ('', '<NA>') then 'Unknown' else color end as color, fiscal_year, fiscal_month,
            qty, revenue, order_count, active_dealer_count, avg_unit_price, q0 as same_month_qty_last_year, r0 as same_month_revenue_last_year, (q0 > 0)::int as has_sku_yoy,
            case when q0 > 0 then (qty - q0) / q0 else 0 end as sku_yoy_qty_growth, case when r0 > 0 then (revenue - r0) / r0 else 0 end as sku_yoy_revenue_growth, group_month_qty, group_month_revenue,
            case when group_month_qty > 0 then qty / group_month_qty else 0 end as sku_qty_share_in_group, case when group_month_revenue > 0 then revenue / group_month_revenue else 0 end as sku_revenue_share_in_group,
            (n >= 4 and q3 - q1 > 0 and (qty < q1 - 1.5 * (q3 - q1) or qty > q3 + 1.5 * (q3 - q1)))::int as outlier_flag,
            {", ".join(f"coalesce(lag({c}, {k}) {_W}, 0) as {c}_lag_{k}, round(coalesce(avg({c}) {_WK.format(k + 1)}, 0), 6) as {c}_rolling_{k + 1}" for c in ("qty", "revenue") for k in (1, 2))},
            {", ".join(f"case when lag({c}) {_W} > 0 then ({c} - lag({c}) {_W}) / lag({c}) {_W} else 0 end as mom_{c}_growth" for c in ("qty", "revenue"))}, lead(qty) {_W} as qty_next_month,
            (coalesce(trim(group_name), '') in ('', '<NA>', 'Unknown'))::int as missing_group_flag, (coalesce(trim(color), '') in ('', '<NA>', 'Unknown'))::int as missing_color_flag,
            (coalesce(trim(group_name), '') in ('', '<NA>', 'Unknown') or coalesce(trim(color), '') in ('', '<NA>', 'Unknown'))::int as missing_master_flag, (qty < 0 or revenue < 0 or avg_unit_price <= 0)::int as numeric_issue_flag,
            coalesce(y0 >= {NEW_SINCE}, false)::int as new_sku_flag, fiscal_year::varchar || '-' || lpad(fiscal_month::varchar, 2, '0') as period from x""",
    "monthly_group_features": f"""with {GROUP_SQL} select *, coalesce(lag(qty, 1) {_GW}, 0) as qty_lag_1, coalesce(lag(qty, 2) {_GW}, 0) as qty_lag_2, round(coalesce(avg(qty) {_G3}, 0), 4) as qty_rolling_3,
        coalesce(lag(revenue, 1) {_GW}, 0) as revenue_lag_1, coalesce(lag(revenue, 2) {_GW}, 0) as revenue_lag_2, round(coalesce(avg(revenue) {_G3}, 0), 4) as revenue_rolling_3,
        round(sin(2 * pi() * fiscal_month / 12), 6) + 0.0::double as month_sin, round(cos(2 * pi() * fiscal_month / 12), 6) + 0.0::double as month_cos, make_date(fiscal_year, fiscal_month, 1) as period from gm""",
    "color_features": f"with {COLOR_SQL} select *, coalesce(lag(revenue) over (partition by color order by period), 0) as revenue_lag_1, round(coalesce(avg(revenue) over (partition by color order by period rows between 3 preceding and 1 preceding), 0), 4) as revenue_rolling_3 from cm",
    "customer_orders": f"with {ORDERS_SQL} select customer_code, max(region) as region, min(order_date) as first_order_date, max(order_date) as last_order_date, count(so_number) as order_frequency, sum(order_revenue)::double as total_revenue, sum(order_revenue)::double / count(*) as avg_order_value from ofact group by 1",
    "customer_features": f"with {CUSTOMERS_SQL} select * from feat",
    "customer_rfm_qcut": f"with {SCORED_SQL} select customer_code, recency_score, frequency_score, monetary_score, rfm_score from scored",
    "rfm_features": f"""with {FACT_SQL}, o as (select o_custkey, count(*) as frequency, max(o_orderdate)::date as last from orders group by 1), s as (select customer_code, sum(line_total)::double as monetary from fact group by 1),
        b as (select c_custkey::varchar as customer_code, coalesce(date_diff('day', last, (select max(o_orderdate)::date from orders)), 9999)::int as recency_days, ln(1 + coalesce(frequency, 0)::double) as log_frequency, ln(1 + coalesce(monetary, 0)) as log_monetary
              from customer left join o on o_custkey = c_custkey left join s on s.customer_code = c_custkey::varchar)
        select customer_code, recency_days, round(log_frequency, 6) as log_frequency, round(log_monetary, 6) as log_monetary, {_Z} from b""",
    "bgnbd_summary": f"""with w as (select o_custkey::varchar as customer_code, o_orderkey as k, date_trunc('week', o_orderdate)::date as week from orders where o_orderdate::date <= date '{OBSERVED_UNTIL}')
        select customer_code, count(distinct week) - 1 as frequency, (date_diff('day', min(week), max(week)) / 7)::int as recency, (date_diff('day', min(week), {_WEEK}::date) / 7)::int as age, count(distinct k) as n_orders from w group by 1""",
}
