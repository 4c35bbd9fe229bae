"""Queries of the general data problems: orphans, rolling totals, broken rows, skewed totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalmill.functions.keys import BLANKS, clean_key
from pedalmill.operators.broken_rows import TOO_LONG, UNITS, read_lines, split_rows
from pedalmill.operators.even_totals import even_totals, frequent_keys
from pedalmill.operators.orphan_refs import find_orphans, parent_runs
from pedalmill.operators.rolling_totals import rolling_totals
from pedalmill.sources.tables import table

_TRIM = "trim({0}, chr(32) || chr(9) || chr(13) || chr(10) || chr(11) || chr(12) || chr(160))"


def _key_sql(column: str, dots: bool = False) -> str:
    key = f"upper({_TRIM.format(column)})"
    return f"nullif({f'translate({key}, {chr(39)}_-{chr(39)}, {chr(39)}..{chr(39)})' if dots else key}, '')"


def _references(spark: SparkSession, d: str) -> list[tuple[str, str, DataFrame, bool, DataFrame]]:
    orders, lines = table(spark, d, "tmp_sales_order"), table(spark, d, "tmp_order_line")
    customers = parent_runs(table(spark, d, "staging_customer"), clean_key(F.col("customer_code")), F.col("created_at"), F.col("deleted_at"))
    products = parent_runs(table(spark, d, "product"), clean_key(F.col("product_code")), F.col("created_at"), F.col("deleted_at"))
    sales = parent_runs(orders, clean_key(F.col("so_number"), dots=True), F.col("loaded_at"))
    return [
        ("tmp_sales_order", "customer_code", orders, False, customers),
        ("tmp_order_line", "product_code", lines, False, products),
        ("tmp_order_line", "so_number", lines, True, sales),
    ]


def orphans(spark: SparkSession, d: str) -> DataFrame:
    """(ref_table, ref_field, row_id, at, why) of every reference without a live record when its row was loaded."""
    found = None
    for name, field, rows, dots, runs in _references(spark, d):
        one = find_orphans(rows, F.col("row_id"), clean_key(F.col(field), dots), F.col("loaded_at"), runs)
        one = one.select(F.lit(name).alias("ref_table"), F.lit(field).alias("ref_field"), "row_id", "at", "why")
        found = one if found is None else found.unionByName(one)
    return found


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans(spark, d).select("ref_table", "ref_field", "row_id")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per table, field, month of loaded_at and reason."""
    month = F.date_format("at", "yyyy-MM")
    return (
        orphans(spark, d)
        .groupBy("ref_table", "ref_field", month.alias("month"), "why")
        .agg(F.count(F.lit(1)).alias("n_orphans"))
    )


def _orphan_sql(columns: str, tail: str) -> str:
    def one(name, field, dots, parent, key, start, end):
        live = f"p.{start} <= r.loaded_at" + (f" and (p.{end} is null or r.loaded_at < p.{end})" if end else "")
        return f"""
        select '{name}' as ref_table, '{field}' as ref_field, r.row_id, r.loaded_at as at_,
               case when exists (select 1 from (select {_key_sql(key, dots)} as k, {start} as s from {parent}) q where q.k = r.k and q.s is not null)
                    then 'not_live' else 'missing' end as why
        from (select row_id, loaded_at, {_key_sql(field, dots)} as k from {name}) r
        where r.k is not null and r.loaded_at is not null and not exists (
            select 1 from (select {_key_sql(key, dots)} as k, * from {parent}) p where p.k = r.k and {live})"""

    parts = [
        one("tmp_sales_order", "customer_code", False, "staging_customer", "customer_code", "created_at", "deleted_at"),
        one("tmp_order_line", "product_code", False, "product", "product_code", "created_at", "deleted_at"),
        one("tmp_order_line", "so_number", True, "tmp_sales_order", "so_number", "loaded_at", None),
    ]
    return f"select {columns} from ({' union all '.join(parts)}) x {tail}"


def p3_rolling(spark: SparkSession, d: str) -> DataFrame:
    """Sums and daily averages of line_total over the last 7 and 30 days per customer_code and calendar day.

    A redelivered order counts once, as last loaded; redelivered lines (the same order, product,
    quantity, price and total) count once.
    """
    orders = table(spark, d, "tmp_sales_order")
    last = F.max_by(F.struct(clean_key(F.col("customer_code")).alias("customer_code"), "order_date"), F.struct("loaded_at", "row_id"))
    order = (
        orders.groupBy(clean_key(F.col("so_number"), dots=True).alias("so"))
        .agg(last.alias("o"))
        .select("so", "o.customer_code", "o.order_date")
        .where(F.col("customer_code").isNotNull())
    )
    amounts = (
        table(spark, d, "tmp_order_line")
        .select(clean_key(F.col("so_number"), dots=True).alias("so"), clean_key(F.col("product_code")).alias("p"), "quantity", "unit_price", "line_total")
        .where(F.col("so").isNotNull())
        .distinct()
        .groupBy("so")
        .agg(F.sum("line_total").alias("amount"))
    )
    calendar = orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    activity = order.join(amounts, "so", "left")
    return rolling_totals(activity, calendar, "customer_code", "order_date", "amount")


P3_SQL = f"""
with o as (
    select {_key_sql('so_number', True)} as so, arg_max({{'c': {_key_sql('customer_code')}, 'd': order_date}}, {{'l': loaded_at, 'r': row_id}}) as o
    from tmp_sales_order group by 1),
a as (
    select so, sum(line_total) as amount from (
        select distinct {_key_sql('so_number', True)} as so, {_key_sql('product_code')} as p, quantity, unit_price, line_total
        from tmp_order_line) x where so is not null group by so),
j as (select o.o.c as customer_code, o.o.d as order_date, coalesce(a.amount, 0) as amount from o left join a on o.so = a.so where o.o.c is not null),
cal as (select unnest(generate_series(lo, hi, interval 1 day))::date as order_date
        from (select min(order_date)::timestamp as lo, max(order_date)::timestamp as hi from tmp_sales_order)),
dense as (
    select e.customer_code, cal.order_date, coalesce(t.total, 0) as total
    from (select distinct customer_code from j) e cross join cal
    left join (select customer_code, order_date, sum(amount) as total from j where order_date is not null group by 1, 2) t
      on t.customer_code = e.customer_code and t.order_date = cal.order_date)
select customer_code, order_date, total::double as total,
       (sum(total) over w7)::double as sum_7d, (sum(total) over w30)::double as sum_30d,
       (sum(total) over w7)::double / 7.0::double as avg_7d, (sum(total) over w30)::double / 30.0::double as avg_30d
from dense
window w7 as (partition by customer_code order by order_date rows between 6 preceding and current row),
       w30 as (partition by customer_code order by order_date rows between 29 preceding and current row)
"""

def _read(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "extract_fail").where(F.col("record_type").isin("order_line", "staging_line"))
    keep = {"fail_id": F.col("fail_id"), "record_type": F.col("record_type")}
    return read_lines(rows, F.col("raw_line"), F.col("record_type") == "staging_line", keep)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """A number too long for any type can be read, so it is none of these reasons; it is not loaded either."""
    return split_rows(_read(spark, d))[1].where(F.col("reason") != TOO_LONG).select("fail_id", "reason")


def p4_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The lines that can be read, with typed values."""
    sound = split_rows(_read(spark, d))[0]
    return sound.withColumns({c: F.col(c).cast("double") for c in ("stt", "quantity", "unit_price", "line_total")})


def _skewed(spark: SparkSession, d: str) -> list[tuple[str, str, DataFrame]]:
    lines, orders = table(spark, d, "tmp_order_line"), table(spark, d, "tmp_sales_order")
    values = {"quantity": F.col("quantity"), "line_total": F.col("line_total")}
    return [
        ("tmp_order_line", "product_code", even_totals(lines, clean_key(F.col("product_code")), values)),
        ("tmp_sales_order", "customer_code", even_totals(orders, clean_key(F.col("customer_code")))),
    ]


#: Share of a table's rows from which on a key counts as one of the few that hold most.
FREQUENT = 0.03


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        frequent_keys(totals, FREQUENT).select(F.lit(t).alias("ref_table"), F.lit(f).alias("ref_field"), F.col("k").alias("key_value"))
        for t, f, totals in _skewed(spark, d)
    ]
    return parts[0].unionByName(parts[1])


def p6_totals(spark: SparkSession, d: str) -> DataFrame:
    """Rows, quantity and line_total per product_code, rows per customer_code; blank keys as null."""
    parts = []
    for t, f, totals in _skewed(spark, d):
        for c in ("quantity", "line_total"):
            totals = totals.withColumn(c, F.col(c).cast("double") if c in totals.columns else F.lit(None).cast("double"))
        parts.append(totals.select(F.lit(t).alias("ref_table"), F.lit(f).alias("ref_field"), F.col("k").alias("key_value"), "n_rows", "quantity", "line_total"))
    return parts[0].unionByName(parts[1])


_P4_UNITS = ", ".join(f"'{u}'" for unit in UNITS for u in (unit.lower(),))
_P4_SQL = f"""
with raw as (
    select fail_id, record_type, regexp_replace(raw_line, '^[\\s\\x{{85}}\\x{{A0}}\\x{{FEFF}}\\x{{3000}}]+|[\\s\\x{{85}}\\x{{A0}}\\x{{FEFF}}\\x{{3000}}]+$', '', 'g') as line
    from extract_fail where record_type in ('order_line', 'staging_line')),
w as (select *, regexp_split_to_array(line, '[\\s\\x{{A0}}\\x{{3000}}]+') as words from raw where record_type = 'order_line' and coalesce(line, '') <> ''),
u as (select *, list_transform(words, lambda x: lower(x) in ({_P4_UNITS}) or lower(x) in ('chiec', 'cai', 'bo', 'cap', 'thung', 'hop', 'cay')) as flags from w),
p as (select *, case when list_contains(flags, true) then len(words) + 1 - list_position(list_reverse(flags), true) else 0 end as place from u),
t as (select fail_id, place < 4 or len(words) - place <> 3 as wrong, list_aggregate(words[3:place - 1], 'string_agg', ' ') as name, words[place] as unit,
             words[1] as stt, words[2] as code, words[place + 1] as q, words[place + 2] as up, words[place + 3] as lt from p),
c as (select fail_id, line, regexp_matches(line, '^(?:\\s*"(?:[^"]|"")*"\\s*|[^",]*)(?:,(?:\\s*"(?:[^"]|"")*"\\s*|[^",]*))*$') as fine,
             list_transform(regexp_extract_all(',' || line, ',(\\s*"(?:[^"]|"")*"\\s*|[^",]*)', 1),
                            lambda x: trim(replace(regexp_replace(regexp_replace(x, '^\\s*"', ''), '"\\s*$', ''), '""', '"'), chr(32) || chr(9) || chr(10) || chr(13) || chr(160) || chr(65279))) as v
      from raw where record_type = 'staging_line' and coalesce(line, '') <> ''),
v as (select fail_id, case when wrong then 'COLUMN_COUNT' end as shape, stt, code, name, unit, q, up, lt from t
      union all
      select fail_id, case when not fine then 'QUOTING' when len(v) <> 7 then 'COLUMN_COUNT' end, v[1], v[2], v[3], v[4], v[5], v[6], v[7] from c
      union all
      select fail_id, 'EMPTY', null, null, null, null, null, null, null from raw where coalesce(line, '') = ''),
f as (select *, coalesce(regexp_matches(stt, '^0*[1-9][0-9]*$') and regexp_matches(code, '^[A-Z0-9.]{{8,25}}$')
             and regexp_matches(q, '^[0-9]{{1,5}}([.,][0-9]{{1,2}})?$') and regexp_matches(q, '[1-9]')
             and regexp_matches(up, '^([0-9]+|[0-9]{{1,3}}(\\.[0-9]{{3}})+)$')
             and regexp_matches(lt, '^([0-9]+|[0-9]{{1,3}}(\\.[0-9]{{3}})+)$') and regexp_matches(lt, '[1-9]'), false) as good from v)
""".replace("\\\\", "\\")


def _totals_sql() -> str:
    return f"""
    select 'tmp_order_line' as ref_table, 'product_code' as ref_field, {_key_sql('product_code')} as key_value, count(*) as n_rows,
           coalesce(sum(quantity), 0)::double as quantity, coalesce(sum(line_total), 0)::double as line_total
    from tmp_order_line group by 3
    union all
    select 'tmp_sales_order', 'customer_code', {_key_sql('customer_code')}, count(*), null::double, null::double from tmp_sales_order group by 3"""


QUERIES = {
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p3_rolling": p3_rolling,
    "p4_found": p4_found,
    "p4_loaded": p4_loaded,
    "p6_found": p6_found,
    "p6_totals": p6_totals,
}

ORACLES = {
    "p2_found": _orphan_sql("ref_table, ref_field, row_id", ""),
    "p2_report": _orphan_sql("ref_table, ref_field, strftime(at_, '%Y-%m') as month, why, count(*) as n_orphans", "group by 1, 2, 3, 4"),
    "p3_rolling": P3_SQL,
    "p4_found": f"{_P4_SQL} select fail_id, coalesce(shape, 'BAD_VALUE') as reason from f where shape is not null or not good",
    "p4_loaded": f"""{_P4_SQL} select fail_id, record_type, stt::double as stt, code as product_code, name, unit, replace(q, ',', '.')::double as quantity,
        replace(up, '.', '')::double as unit_price, replace(lt, '.', '')::double as line_total from f join raw using (fail_id) where shape is null and good""",
    "p6_found": f"""
        select ref_table, ref_field, key_value from (
            select *, sum(n_rows) over (partition by ref_table) as whole from ({_totals_sql()}) t) x
        where key_value is not null and n_rows >= whole * {FREQUENT}""",
    "p6_totals": _totals_sql(),
}
