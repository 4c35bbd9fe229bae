"""The denormalised sales fact and the views over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalmill.sources.tables import table

#: Columns of the fact, in order.
FACT_COLUMNS = (
    "order_id so_number order_date fiscal_year fiscal_quarter fiscal_month week customer_code customer_name province_name region "
    "product_code product_name color line_name group_code quantity unit_price line_total"
).split()


def lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey"),
        F.col("l_quantity").cast("decimal(10,2)").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("line_total"),
    )


def orders(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("SO"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0")).alias("so_number"),
        day.alias("order_date"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
        F.month(day).alias("fiscal_month"),
        F.weekofyear(day).alias("week"),
        "o_custkey",
    )


def fact_sales(spark: SparkSession, d: str, order_keys: DataFrame | None = None) -> DataFrame:
    """One row per order line with its order, customer, place and product.

    Orders and customers must exist, place and product may not (null then). ``order_keys`` (order_id)
    limits the orders before any join. Place tables are small and of fixed size; the planner broadcasts
    what is under its threshold by measured size and shuffles the rest on the join keys.
    """
    o = orders(spark, d)
    if order_keys is not None:
        o = o.join(order_keys.select("order_id").distinct(), "order_id", "left_semi")
    c = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("customer_code"), F.col("c_name").alias("customer_name"), "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("province_name"), "n_regionkey")
    r = table(spark, d, "region").select("r_regionkey", F.col("r_name").alias("region"))
    p = table(spark, d, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.substring_index("p_name", " ", 1).alias("color"),
        F.col("p_brand").alias("line_name"),
        F.col("p_type").alias("group_code"),
        F.col("p_retailprice").cast("decimal(15,2)").alias("unit_price"),
    )
    return (
        lines(spark, d)
        .join(o, "order_id")
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(*FACT_COLUMNS)
    )


#: The fact for DuckDB, as the first part of a WITH list.
FACT_SQL = """fact as (
    select o.o_orderkey as order_id, 'SO' || lpad(o.o_orderkey::varchar, 8, '0') as so_number, o.o_orderdate::date as order_date,
           year(o.o_orderdate)::int as fiscal_year, quarter(o.o_orderdate)::int as fiscal_quarter, month(o.o_orderdate)::int as fiscal_month,
           weekofyear(o.o_orderdate)::int as week, c.c_custkey::varchar as customer_code, c.c_name as customer_name, n.n_name as province_name,
           r.r_name as region, p.p_partkey::varchar as product_code, p.p_name as product_name, split_part(p.p_name, ' ', 1) as color,
           p.p_brand as line_name, p.p_type as group_code, l.l_quantity::decimal(10,2) as quantity, p.p_retailprice::decimal(15,2) as unit_price,
           l.l_extendedprice::decimal(15,2) as line_total
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey
    left join nation n on c.c_nationkey = n.n_nationkey left join region r on n.n_regionkey = r.r_regionkey
    left join part p on l.l_partkey = p.p_partkey)"""


def dsum(column: str) -> F.Column:
    """Sum of a decimal column, exact, as double."""
    return F.sum(column).cast("double")


def davg(column: str) -> F.Column:
    """Mean of a decimal column from its exact sum."""
    return F.sum(column).cast("double") / F.count(column)


def fact_sales_build(spark: SparkSession, d: str) -> DataFrame:
    return fact_sales(spark, d).select(*[F.col(c).cast("double").alias(c) if c in ("quantity", "unit_price", "line_total") else F.col(c) for c in FACT_COLUMNS])


def fact_verify(spark: SparkSession, d: str) -> DataFrame:
    return fact_sales(spark, d).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("order_id").alias("order_count"),
        F.coalesce(dsum("quantity"), F.lit(0.0)).alias("total_quantity"),
        F.coalesce(dsum("line_total"), F.lit(0.0)).alias("total_revenue"),
    )


def v_monthly_by_group(spark: SparkSession, d: str) -> DataFrame:
    return fact_sales(spark, d).groupBy("fiscal_year", "fiscal_month", "group_code").agg(
        F.countDistinct("order_id").alias("order_count"), dsum("quantity").alias("total_qty"), dsum("line_total").alias("total_revenue"), F.round(F.sum("unit_price").cast("double") / F.count("unit_price"), 0).alias("avg_unit_price")
    )


def v_customer_period(spark: SparkSession, d: str) -> DataFrame:
    return fact_sales(spark, d).groupBy("customer_code", "fiscal_year", "fiscal_quarter").agg(
        F.countDistinct("order_id").alias("order_count"),
        F.countDistinct("product_code").alias("sku_count"),
        dsum("quantity").alias("total_qty"),
        dsum("line_total").alias("total_revenue"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def v_sku_monthly(spark: SparkSession, d: str) -> DataFrame:
    return fact_sales(spark, d).groupBy("product_code", "fiscal_year", "fiscal_month").agg(
        F.max("product_name").alias("product_name"),
        F.countDistinct("customer_code").alias("customer_count"),
        dsum("quantity").alias("total_qty"),
        dsum("line_total").alias("total_revenue"),
    )


def v_customer_activity(spark: SparkSession, d: str) -> DataFrame:
    """Customers without orders survive; days are counted to the last order of all, not to the clock."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("customer_name"))
    o = orders(spark, d).select("o_custkey", "order_id", "order_date")
    # lines are added up per order before they meet the customers, so orders are the finest rows joined
    per_order = lines(spark, d).groupBy("order_id").agg(F.sum("line_total").alias("order_total"))
    per_customer = o.join(per_order, "order_id", "left").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("order_total").cast("double").alias("total_revenue"), F.max("order_date").alias("last_order_date")
    )
    as_of = o.agg(F.max("order_date").alias("as_of"))
    return (
        c.join(per_customer, "o_custkey", "left")
        .crossJoin(F.broadcast(as_of))  # one row
        .select(
            F.col("o_custkey").cast("string").alias("customer_code"),
            "customer_name",
            F.coalesce("order_count", F.lit(0)).alias("order_count"),
            F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
            "last_order_date",
            F.datediff("as_of", "last_order_date").alias("days_since_last_order"),
        )
    )


def order_totals(spark: SparkSession, d: str) -> DataFrame:
    """What a trigger would keep on every order, always fresh; orders without lines have zeros."""
    totals = lines(spark, d).groupBy("order_id").agg(dsum("line_total").alias("total_amount"), F.round(F.sum("quantity"), 0).cast("int").alias("total_quantity"), F.count(F.lit(1)).alias("line_count"))
    return orders(spark, d).select("order_id", "so_number").join(totals, "order_id", "left").na.fill(0, ["total_amount", "total_quantity", "line_count"])


def history_monthly(spark: SparkSession, d: str) -> DataFrame:
    return (
        fact_sales(spark, d)
        .where(F.col("fiscal_month").isin(1, 2, 3))
        .groupBy("fiscal_year", "fiscal_month")
        .agg(dsum("quantity").alias("qty"), dsum("line_total").alias("revenue"))
        .withColumn("label", F.concat(F.col("fiscal_year").cast("string"), F.lit("-"), F.lpad(F.col("fiscal_month").cast("string"), 2, "0")))
    )


QUERIES = {f.__name__: f for f in (fact_sales_build, fact_verify, v_monthly_by_group, v_customer_period, v_sku_monthly, v_customer_activity, order_totals, history_monthly)}

ORACLES = {
    "fact_sales_build": f"with {FACT_SQL} select * replace (quantity::double as quantity, unit_price::double as unit_price, line_total::double as line_total) from fact",
    "fact_verify": f"with {FACT_SQL} select count(*) as row_count, count(distinct so_number) as order_count, coalesce(sum(quantity), 0)::double as total_quantity, coalesce(sum(line_total), 0)::double as total_revenue from fact",
    "v_monthly_by_group": f"with {FACT_SQL} select fiscal_year, fiscal_month, group_code, count(distinct so_number) as order_count, sum(quantity)::double as total_qty, sum(line_total)::double as total_revenue, round(sum(unit_price)::double / count(unit_price), 0) as avg_unit_price from fact group by all",
    "v_customer_period": f"with {FACT_SQL} select customer_code, fiscal_year, fiscal_quarter, count(distinct so_number) as order_count, count(distinct product_code) as sku_count, sum(quantity)::double as total_qty, sum(line_total)::double as total_revenue, min(order_date) as first_order_date, max(order_date) as last_order_date from fact group by 1, 2, 3",
    "v_sku_monthly": f"with {FACT_SQL} select product_code, fiscal_year, fiscal_month, max(product_name) as product_name, count(distinct customer_code) as customer_count, sum(quantity)::double as total_qty, sum(line_total)::double as total_revenue from fact group by 1, 2, 3",
    "v_customer_activity": """
        select c.c_custkey::varchar as customer_code, c.c_name as customer_name, count(distinct o.o_orderkey) as order_count,
               coalesce(sum(l.l_extendedprice::decimal(15,2)), 0)::double as total_revenue, max(o.o_orderdate)::date as last_order_date,
               date_diff('day', max(o.o_orderdate)::date, (select max(o_orderdate)::date from orders))::int as days_since_last_order
        from customer c left join orders o on o.o_custkey = c.c_custkey left join lineitem l on l.l_orderkey = o.o_orderkey group by 1, 2""",
    "order_totals": """
        select o_orderkey as order_id, 'SO' || lpad(o_orderkey::varchar, 8, '0') as so_number,
               coalesce((select sum(l_extendedprice::decimal(15,2)) from lineitem where l_orderkey = o_orderkey), 0)::double as total_amount,
               coalesce((select round(sum(l_quantity::decimal(10,2)), 0) from lineitem where l_orderkey = o_orderkey), 0)::int as total_quantity,
               (select count(*) from lineitem where l_orderkey = o_orderkey) as line_count
        from orders""",
    "history_monthly": f"with {FACT_SQL} select fiscal_year, fiscal_month, sum(quantity)::double as qty, sum(line_total)::double as revenue, fiscal_year::varchar || '-' || lpad(fiscal_month::varchar, 2, '0') as label from fact where fiscal_month in (1, 2, 3) group by 1, 2",
}
