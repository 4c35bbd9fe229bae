"""Checks, deduplication, upserts and refreshes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalmill.functions.keys import clean_key
from pedalmill.operators.upsert import dedup, delete_keys, duplicates, insert_ignore, next_codes, update_from, upsert
from pedalmill.plans.fact import FACT_SQL, dsum, fact_sales, orders
from pedalmill.sources.tables import table

_BLANK = "chr(32) || chr(9) || chr(13) || chr(10) || chr(11) || chr(12) || chr(160)"


def _k(column: str, dots: bool = False) -> str:
    key = f"upper(trim({column}, {_BLANK}))"
    return f"nullif({f'''translate({key}, '_-', '..')''' if dots else key}, '')"


def _so(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tmp_sales_order")
    return t.select(clean_key(F.col("so_number"), dots=True).alias("so"), clean_key(F.col("customer_code")).alias("customer"), "order_date", "loaded_at", "row_id")


def _ol(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tmp_order_line")
    return t.select(clean_key(F.col("so_number"), dots=True).alias("so"), clean_key(F.col("product_code")).alias("product"), "quantity", "line_total", "loaded_at", "row_id")


def anti_missing_product(spark: SparkSession, d: str) -> DataFrame:
    """Products that lines name and the master never had, with how often."""
    used = _ol(spark, d).where("product is not null").groupBy("product").agg(F.count(F.lit(1)).alias("n_lines"))  # few keys, before the join
    master = table(spark, d, "product").select(clean_key(F.col("product_code")).alias("product")).distinct()
    return used.join(master, "product", "left_anti")


def anti_missing_customer(spark: SparkSession, d: str) -> DataFrame:
    used = _so(spark, d).where("customer is not null").groupBy("customer").agg(F.count(F.lit(1)).alias("n_orders"))
    known = table(spark, d, "staging_customer").select(clean_key(F.col("customer_code")).alias("customer")).distinct()
    return used.join(known, "customer", "left_anti")


def anti_orphan_lines(spark: SparkSession, d: str) -> DataFrame:
    used = _ol(spark, d).where("so is not null").groupBy("so").agg(F.count(F.lit(1)).alias("n_lines"))
    return used.join(_so(spark, d).where("so is not null").select("so").distinct(), "so", "left_anti")


def orders_without_lines(spark: SparkSession, d: str) -> DataFrame:
    have = _ol(spark, d).where("so is not null").select("so").distinct()
    return _so(spark, d).where("so is not null").select("so").distinct().join(have, "so", "left_anti")


def semi_batch_verify(spark: SparkSession, d: str) -> DataFrame:
    """Lines whose order is in the batch: how many and how much."""
    batch = _so(spark, d).where("so is not null").select("so").distinct()
    return _ol(spark, d).join(batch, "so", "left_semi").agg(F.count(F.lit(1)).alias("n_lines"), F.coalesce(dsum("line_total"), F.lit(0.0)).alias("total"))


def fact_refresh_by_key(spark: SparkSession, d: str) -> DataFrame:
    """The fact after orders of 1997 are rebuilt by key, when their lines had been loaded with half their quantity
    and without the lines of one product in seven: changed rows are replaced and missing ones come in."""
    keys = orders(spark, d).where("fiscal_year = 1997").select("order_id")
    stale = F.col("fiscal_year") == 1997
    old = fact_sales(spark, d).where(~stale | (F.coalesce(F.col("product_code").cast("bigint"), F.lit(1)) % 7 != 0)).withColumn("quantity", F.when(stale, (F.col("quantity") / 2).cast("decimal(10,2)")).otherwise(F.col("quantity")))
    fresh = fact_sales(spark, d, keys)
    now = delete_keys(old, keys, ["order_id"]).unionByName(fresh)
    # every order, so that a row too many, too few or unchanged shows
    return now.groupBy("order_id").agg(F.max("fiscal_year").alias("fiscal_year"), F.count(F.lit(1)).alias("n_rows"), dsum("quantity").alias("quantity"), dsum("line_total").alias("revenue"))


def dedup_first_wins(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "staging_customer").select("customer_code", "customer_name", "province_id", "created_at")
    return dedup(c, ["customer_code"], [F.col("created_at"), F.coalesce("customer_name", F.lit("")), F.coalesce("province_id", F.lit(0))])


def dedup_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return dedup(_so(spark, d), ["so"], [-F.unix_micros(F.col("loaded_at").cast("timestamp")), -F.col("row_id")])


def dedup_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return duplicates(_so(spark, d).where("so is not null"), ["so"])


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders known before 2025 and those delivered since, each once."""
    rows = _so(spark, d)
    last = [-F.unix_micros(F.col("loaded_at").cast("timestamp")), -F.col("row_id")]
    cut = F.lit("2025-01-01").cast("timestamp_ntz")
    return dedup(rows.where(F.col("loaded_at") < cut), ["so"], last), dedup(rows.where(F.col("loaded_at") >= cut), ["so"], last)


def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Orders after the later delivery; a known order keeps the row_id it got first."""
    old, new = _split(spark, d)
    return upsert(old, new, ["so"], keep=("row_id",))


def insert_do_nothing(spark: SparkSession, d: str) -> DataFrame:
    """Orders known before, and of the later ones only new numbers, as first delivered."""
    old, _ = _split(spark, d)
    later = _so(spark, d).where(F.col("loaded_at") >= F.lit("2025-01-01").cast("timestamp_ntz"))
    return insert_ignore(old, later, ["so"], [F.col("loaded_at"), F.col("row_id")])


def update_from_join(spark: SparkSession, d: str) -> DataFrame:
    """Staged customers with province_id filled in, by name of the region's first province, where it is null."""
    c = dedup(table(spark, d, "staging_customer").select("customer_code", "province_id", "created_at"), ["customer_code"], [F.col("created_at"), F.coalesce("province_id", F.lit(0))]).drop("created_at")
    first = table(spark, d, "province").agg(F.min("province_id").alias("province_id"))
    fix = c.where("province_id is null").select("customer_code").crossJoin(F.broadcast(first))  # one row
    return update_from(c, fix, ["customer_code"], ["province_id"])


def agg_filter_clause(spark: SparkSession, d: str) -> DataFrame:
    """How complete the product master is, by filtered counts."""
    return table(spark, d, "product").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("color").isNull()).alias("no_color"),
        F.count_if(F.col("line_id").isNull()).alias("no_line"),
        F.count_if(F.col("unit").isNull()).alias("no_unit"),
        F.count_if(F.col("deleted_at").isNotNull()).alias("deleted"),
        F.count_if(F.coalesce("is_active", F.lit(False))).alias("active"),
    )


def quality_summary(spark: SparkSession, d: str) -> DataFrame:
    """Two facets in one table: failures by record type and by noted error."""
    rows = table(spark, d, "extract_fail")
    by_type = rows.groupBy(F.coalesce("record_type", F.lit("(none)")).alias("group_value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("record_type").alias("group_type"), "group_value", "n")
    error = F.coalesce(F.regexp_replace("error", "[0-9]+", "#"), F.lit("(none)"))
    by_error = rows.groupBy(error.alias("group_value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("error").alias("group_type"), "group_value", "n")
    return by_type.unionByName(by_error)


def new_customer_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes for customers that orders name and the staging table lacks, after the highest code of the table's
    regular range, in the order in which the orders came."""
    unknown = _so(spark, d).join(table(spark, d, "staging_customer").select(clean_key(F.col("customer_code")).alias("customer")).distinct(), "customer", "left_anti")
    number = F.regexp_extract("customer_code", "(?i)^KH-([0-9]+)$", 1)
    top = table(spark, d, "staging_customer").agg(F.max(F.when(number != "", number.cast("bigint"))).alias("top"))
    return next_codes(unknown, "customer", F.struct("loaded_at", "row_id"), top, "KH-", 8)


QUERIES = {
    f.__name__: f
    for f in (
        anti_missing_product, anti_missing_customer, anti_orphan_lines, orders_without_lines, semi_batch_verify, fact_refresh_by_key, dedup_first_wins,
        dedup_last_wins, dedup_duplicates, upsert_last_wins, insert_do_nothing, update_from_join, agg_filter_clause, quality_summary, new_customer_codes,
    )
}

_SO = f"so as (select {_k('so_number', True)} as so, {_k('customer_code')} as customer, order_date, loaded_at, row_id from tmp_sales_order)"
_OL = f"ol as (select {_k('so_number', True)} as so, {_k('product_code')} as product, quantity, line_total, loaded_at, row_id from tmp_order_line)"
_SPLIT = f"""{_SO}, ranked as (select *, loaded_at >= timestamp '2025-01-01' as later, row_number() over (partition by so, loaded_at >= timestamp '2025-01-01' order by loaded_at desc, row_id desc) as r,
    row_number() over (partition by so, loaded_at >= timestamp '2025-01-01' order by loaded_at, row_id) as f from so where so is not null),
    old as (select so, customer, order_date, loaded_at, row_id from ranked where not later and r = 1),
    new as (select so, customer, order_date, loaded_at, row_id from ranked where later and r = 1),
    first_new as (select so, customer, order_date, loaded_at, row_id from ranked where later and f = 1)"""

ORACLES = {
    "anti_missing_product": f"with {_OL} select product, count(*) as n_lines from ol where product is not null and product not in (select {_k('product_code')} from product where {_k('product_code')} is not null) group by 1",
    "anti_missing_customer": f"with {_SO} select customer, count(*) as n_orders from so where customer is not null and customer not in (select {_k('customer_code')} from staging_customer where {_k('customer_code')} is not null) group by 1",
    "anti_orphan_lines": f"with {_OL}, {_SO} select so, count(*) as n_lines from ol where so is not null and so not in (select so from so where so is not null) group by 1",
    "orders_without_lines": f"with {_OL}, {_SO} select distinct so from so where so is not null and so not in (select so from ol where so is not null)",
    "semi_batch_verify": f"with {_OL}, {_SO} select count(*) as n_lines, coalesce(sum(line_total), 0)::double as total from ol where so in (select so from so where so is not null)",
    "fact_refresh_by_key": f"with {FACT_SQL} select order_id, max(fiscal_year) as fiscal_year, count(*) as n_rows, sum(quantity)::double as quantity, sum(line_total)::double as revenue from fact group by 1",
    "dedup_first_wins": "select customer_code, customer_name, province_id, created_at from (select *, row_number() over (partition by customer_code order by created_at, coalesce(customer_name, ''), coalesce(province_id, 0)) as r from staging_customer where customer_code is not null) x where r = 1",
    "dedup_last_wins": f"with {_SO} select so, customer, order_date, loaded_at, row_id from (select *, row_number() over (partition by so order by loaded_at desc, row_id desc) as r from so where so is not null) x where r = 1",
    "dedup_duplicates": f"with {_SO} select so, count(*) as n from so where so is not null group by 1 having count(*) > 1",
    "upsert_last_wins": f"with {_SPLIT} select * from old where so not in (select so from new) union all select n.so, n.customer, n.order_date, n.loaded_at, coalesce(o.row_id, n.row_id) from new n left join old o on n.so = o.so",
    "insert_do_nothing": f"with {_SPLIT} select * from old union all select * from first_new where so not in (select so from old)",
    "update_from_join": "select customer_code, coalesce(province_id, (select min(province_id) from province)) as province_id from (select *, row_number() over (partition by customer_code order by created_at, coalesce(province_id, 0)) as r from staging_customer where customer_code is not null) x where r = 1",
    "agg_filter_clause": "select count(*) as n, count(*) filter (where color is null) as no_color, count(*) filter (where line_id is null) as no_line, count(*) filter (where unit is null) as no_unit, count(*) filter (where deleted_at is not null) as deleted, count(*) filter (where is_active) as active from product",
    "quality_summary": "select 'record_type' as group_type, coalesce(record_type, '(none)') as group_value, count(*) as n from extract_fail group by 2 union all select 'error', coalesce(regexp_replace(error, '[0-9]+', '#', 'g'), '(none)'), count(*) from extract_fail group by 2",
    "new_customer_codes": f"""with {_SO}, u as (select customer, min({{'l': loaded_at, 'r': row_id}}) as seen from so where customer is not null and customer not in (select {_k('customer_code')} from staging_customer where {_k('customer_code')} is not null) group by 1),
        t as (select max(try_cast(regexp_extract(customer_code, '(?i)^KH-([0-9]+)$', 1) as bigint)) as top from staging_customer)
        select customer, 'KH-' || lpad((row_number() over (order by seen, customer) + coalesce(top, 0))::varchar, 8, '0') as code from u, t""",
}
