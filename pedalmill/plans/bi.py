"""Business questions over the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalmill.operators.global_rank import global_row_number, ntile
from pedalmill.plans.fact import FACT_SQL, davg, dsum, fact_sales
from pedalmill.session import cut

#: The period asked about.
DATE_FROM, DATE_TO = "1996-01-01", "2000-12-31"


def in_period(fact: DataFrame, date_from: str = DATE_FROM, date_to: str = DATE_TO) -> DataFrame:
    return fact.where(F.col("order_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))


def share_of_all(column: str, places: int = 6) -> Column:
    """A row's share of the column's grand total; for aggregated, so few, rows."""
    return F.round(F.try_divide(F.col(column), F.sum(column).over(Window.partitionBy())), places)


def bi_revenue_trend(spark: SparkSession, d: str) -> DataFrame:
    return (
        in_period(fact_sales(spark, d))
        .groupBy("fiscal_year", "fiscal_month")
        .agg(
            F.countDistinct("order_id").alias("order_count"),
            F.countDistinct("customer_code").alias("active_customer_count"),
            dsum("quantity").alias("total_qty"),
            dsum("line_total").alias("total_revenue"),
            davg("unit_price").alias("avg_unit_price"),
        )
        .orderBy("fiscal_year", "fiscal_month")
    )


def bi_product_analysis(spark: SparkSession, d: str) -> DataFrame:
    """Grouped by the group as stored, so a null and a literal UNKNOWN stay two rows."""
    grouped = (
        in_period(fact_sales(spark, d))
        .withColumn("g", F.when(F.col("group_code") != "PROMO", F.col("group_code")))
        .groupBy("g")
        .agg(
            F.countDistinct("product_code").alias("sku_count"),
            F.countDistinct("order_id").alias("order_count"),
            dsum("quantity").alias("total_qty"),
            dsum("line_total").alias("total_revenue"),
            davg("unit_price").alias("avg_unit_price"),
        )
    )
    return grouped.select(F.coalesce("g", F.lit("UNKNOWN")).alias("group_code"), "sku_count", "order_count", "total_qty", "total_revenue", "avg_unit_price", share_of_all("total_revenue").alias("revenue_share")).orderBy(
        F.col("total_revenue").desc()
    )


def bi_customer_rfm(spark: SparkSession, d: str) -> DataFrame:
    """Quintiles over all customers by ranks that no single task makes, then the best hundred."""
    base = (
        in_period(fact_sales(spark, d))
        .groupBy("customer_code")
        .agg(
            F.max("customer_name").alias("customer_name"),
            F.max("province_name").alias("province_name"),
            F.max("region").alias("region"),
            F.countDistinct("order_id").alias("frequency"),
            dsum("line_total").alias("monetary"),
            F.max("order_date").alias("last_order_date"),
        )
        .withColumn("recency_days", F.datediff(F.lit(DATE_TO).cast("date"), F.col("last_order_date")))
    )
    base = cut(base)  # counted, and ranked three times
    base = base.crossJoin(F.broadcast(base.agg(F.count(F.lit(1)).alias("n"))))  # n is one row
    for key, desc, score in (("recency_days", True, "recency_score"), ("frequency", False, "frequency_score"), ("monetary", False, "monetary_score")):
        base = global_row_number(base, [(key, desc), ("customer_code", False)]).withColumn(score, ntile(F.col("rn"), F.col("n"), 5)).drop("rn")
    scored = base.withColumn("rfm_score", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")).drop("n")
    return scored.orderBy(F.col("rfm_score").desc(), F.col("monetary").desc(), "customer_code").limit(100)


def bi_geo_analysis(spark: SparkSession, d: str) -> DataFrame:
    grouped = (
        in_period(fact_sales(spark, d))
        .groupBy("region", "province_name")
        .agg(F.countDistinct("customer_code").alias("active_customer_count"), F.countDistinct("order_id").alias("order_count"), dsum("quantity").alias("total_qty"), dsum("line_total").alias("total_revenue"))
        .withColumn("revenue_share", share_of_all("total_revenue"))
    )
    return grouped.withColumns({c: F.coalesce(c, F.lit("UNKNOWN")) for c in ("region", "province_name")}).orderBy(F.col("total_revenue").desc(), "province_name").limit(50)


def bi_operational_kpis(spark: SparkSession, d: str) -> DataFrame:
    one = in_period(fact_sales(spark, d)).agg(
        F.countDistinct("order_id").alias("order_count"),
        F.countDistinct("customer_code").alias("active_customer_count"),
        F.countDistinct("product_code").alias("active_sku_count"),
        dsum("quantity").alias("total_qty"),
        dsum("line_total").alias("total_revenue"),
        F.count(F.lit(1)).alias("line_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    per = {"avg_order_value": "total_revenue", "avg_qty_per_order": "total_qty", "avg_lines_per_order": "line_count"}
    return one.withColumns({k: F.round(F.try_divide(F.col(v).cast("double"), F.col("order_count").cast("double")), 6) for k, v in per.items()}).drop("line_count")


def month_growth(spark: SparkSession, d: str) -> DataFrame:
    """Growth over the month before among observed months; null where that had none."""
    trend = bi_revenue_trend(spark, d).select("fiscal_year", "fiscal_month", "total_revenue")
    before = F.lag("total_revenue").over(Window.orderBy("fiscal_year", "fiscal_month"))  # one row per month
    return trend.withColumn("previous_revenue", before).withColumn("growth", F.round(F.try_divide(F.col("total_revenue") - F.col("previous_revenue"), F.col("previous_revenue")), 6))


def report_signals(spark: SparkSession, d: str) -> DataFrame:
    """Signals of the report, a row each: concentration of the three largest places, share of products
    without group, customers long without an order."""
    geo = in_period(fact_sales(spark, d)).groupBy("province_name").agg(dsum("line_total").alias("r"))
    top3 = geo.orderBy(F.col("r").desc(), "province_name").limit(3).agg(F.sum("r").alias("top"))
    whole = geo.agg(F.sum("r").alias("whole"))
    concentration = top3.crossJoin(whole).select(F.lit("top3_province_share").alias("signal"), F.round(F.try_divide("top", "whole"), 6).alias("value"))  # one row each
    product = bi_product_analysis(spark, d).where("group_code = 'UNKNOWN'").agg(F.coalesce(F.round(F.sum("revenue_share"), 6), F.lit(0.0)).alias("value")).select(F.lit("unknown_group_share").alias("signal"), "value")
    stale = (
        in_period(fact_sales(spark, d))
        .groupBy("customer_code")
        .agg(F.max("order_date").alias("last"))
        .agg(F.count_if(F.datediff(F.lit(DATE_TO).cast("date"), F.col("last")) >= 30).cast("double").alias("value"))
        .select(F.lit("stale_customers").alias("signal"), "value")
    )
    return concentration.unionByName(product).unionByName(stale)


QUERIES = {f.__name__: f for f in (bi_revenue_trend, bi_product_analysis, bi_customer_rfm, bi_geo_analysis, bi_operational_kpis, month_growth, report_signals)}

_P = f"with {FACT_SQL}, f as (select * from fact where order_date between date '{DATE_FROM}' and date '{DATE_TO}')"
_TREND = "select fiscal_year, fiscal_month, count(distinct so_number) as order_count, count(distinct customer_code) as active_customer_count, sum(quantity)::double as total_qty, sum(line_total)::double as total_revenue, sum(unit_price)::double / count(unit_price) as avg_unit_price from f group by 1, 2"
_PRODUCT = """select coalesce(g, 'UNKNOWN') as group_code, sku_count, order_count, total_qty, total_revenue, avg_unit_price,
    round(total_revenue / sum(total_revenue) over (), 6) as revenue_share from (
    select case when group_code <> 'PROMO' then group_code end as g, count(distinct product_code) as sku_count, count(distinct so_number) as order_count,
           sum(quantity)::double as total_qty, sum(line_total)::double as total_revenue, sum(unit_price)::double / count(unit_price) as avg_unit_price from f group by 1) x"""

ORACLES = {
    "bi_revenue_trend": f"{_P} {_TREND}",
    "bi_product_analysis": f"{_P} {_PRODUCT}",
    "bi_customer_rfm": f"""{_P}, b as (
        select customer_code, max(customer_name) as customer_name, max(province_name) as province_name, max(region) as region,
               count(distinct so_number) as frequency, sum(line_total)::double as monetary, max(order_date) as last_order_date from f group by 1),
        s as (select *, date_diff('day', last_order_date, date '{DATE_TO}')::int as recency_days from b),
        t as (select *, ntile(5) over (order by recency_days desc, customer_code)::int as recency_score,
               ntile(5) over (order by frequency, customer_code)::int as frequency_score, ntile(5) over (order by monetary, customer_code)::int as monetary_score from s)
        select *, recency_score + frequency_score + monetary_score as rfm_score from t order by rfm_score desc, monetary desc, customer_code limit 100""",
    "bi_geo_analysis": f"""{_P} select coalesce(region, 'UNKNOWN') as region, coalesce(province_name, 'UNKNOWN') as province_name, active_customer_count, order_count, total_qty, total_revenue, revenue_share from (
        select region, province_name, count(distinct customer_code) as active_customer_count, count(distinct so_number) as order_count, sum(quantity)::double as total_qty,
               sum(line_total)::double as total_revenue, round(sum(line_total)::double / sum(sum(line_total)::double) over (), 6) as revenue_share from f group by 1, 2) x
        order by total_revenue desc, province_name limit 50""",
    "bi_operational_kpis": f"""{_P} select count(distinct so_number) as order_count, count(distinct customer_code) as active_customer_count, count(distinct product_code) as active_sku_count,
        sum(quantity)::double as total_qty, sum(line_total)::double as total_revenue, min(order_date) as first_order_date, max(order_date) as last_order_date,
        round(sum(line_total)::double / nullif(count(distinct so_number), 0), 6) as avg_order_value, round(sum(quantity)::double / nullif(count(distinct so_number), 0), 6) as avg_qty_per_order,
        round(count(*)::double / nullif(count(distinct so_number), 0), 6) as avg_lines_per_order from f""",
    "month_growth": f"""{_P}, t as ({_TREND}), l as (select fiscal_year, fiscal_month, total_revenue, lag(total_revenue) over (order by fiscal_year, fiscal_month) as previous_revenue from t)
        select *, round((total_revenue - previous_revenue) / nullif(previous_revenue, 0), 6) as growth from l""",
    "report_signals": f"""{_P}, g as (select province_name, sum(line_total)::double as r from f group by 1)
        select 'top3_province_share' as signal, round((select sum(r) from (select r from g order by r desc, province_name limit 3) x) / (select sum(r) from g), 6) as value
        union all select 'unknown_group_share', coalesce((select round(sum(revenue_share), 6) from ({_PRODUCT}) y where group_code = 'UNKNOWN'), 0)
        union all select 'stale_customers', (select count(*) filter (where date_diff('day', last, date '{DATE_TO}') >= 30)::double from (select max(order_date) as last from f group by customer_code) z)""",
}
