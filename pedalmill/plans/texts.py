"""Text operators over the test tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalmill.functions.keys import clean_key
from pedalmill.functions.text import ERROR_GROUPS, amount, bare_province, clean, error_group, longest_alias, mapped_text, normalize, normalized, order_number, strip_html, tax_code
from pedalmill.operators.upsert import update_from
from pedalmill.sources.tables import table

# Colours and what else they are called, plain; the longest alias found counts, at a tie the first.
COLOR_NAMES = {
    "Đen": (), "Đen Bóng": (), "Đen Mờ": (), "Đen Nhám": (), "Trắng": (), "Trắng Da HP": (), "Đỏ": (), "Đỏ Tươi": (), "Đỏ Đun": (), "Đỏ Đậm": (),
    "Xanh": (), "Xanh Dương": (), "Xanh Da Trời": (), "Xanh Nước Biển": (), "Xanh Lá": (), "Xanh Pastel": ("pastel xanh",), "Xanh Mint": ("mint",), "Xanh Ngọc": ("ngoc",), "Xanh Rêu": ("reu",),
    "Xanh Santorini": ("santorini",), "Xanh Tím": (), "Coban": (), "Vàng": (), "Vàng Chanh": ("chanh",), "Vàng Cánh Gián": ("canh gian",), "Cam": (), "Hồng": (), "Hồng Pastel": ("pastel hong",),
    "Hồng Dạ Quang": ("da quang hong",), "Tím": (), "Tím Dạ Quang": ("da quang tim",), "Nâu": ("cafe nau", "ca phe nau"), "Kem": (), "Ghi": ("xam", "gray", "grey"), "Be": (),
}
# Words of product names, plain, that are no colour and stand between the words of one.
NOISE = (
    "inch|shimano|pro|da hp|dahp|tem|super|new|ld|mtb|gn|te|sk|grx|spd|base|highway|touring|blade|cyber|cyper|rex|neo|road|rpd|cpd|ms|nam|nu|truyen thong|lop|doi|xe|dap|thong|nhat|"
    "blackpink|batman|bat man|superman|super man|wonder woman|bat wheels|tom jerry|we bare bears|bubbles|powerpuff|spaceboy|robot|love|puppy|bunny|princess|kitten|flash"
)
COLORS = {alias: name for name, more in COLOR_NAMES.items() for alias in (normalized(name), *more)}
_NOISE = f"\\b(?:{NOISE})\\b"


def color_text(value: Column) -> Column:
    """``value`` normalized, without digits and words of product names that are no colour."""
    letters = F.regexp_replace(normalize(value), "[0-9]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(letters, _NOISE, " "), " +", " "))


def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").select("product_code", normalize(F.col("product_name")).alias("name"), normalize(F.col("color")).alias("color"))


def standard_colors(products: DataFrame) -> DataFrame:
    """``products`` with color_new, the colour that the product's name says, else the one that its colour says, where
    it was found, and mapping_status."""
    by_name, by_color = longest_alias(color_text(F.col("product_name")), COLORS), longest_alias(color_text(F.col("color")), COLORS)
    found = products.withColumns({"__name": by_name, "__color": by_color})
    named, told = F.col("__name").isNotNull(), F.col("__color").isNotNull()
    return found.withColumns(
        {
            "color_new": F.coalesce("__name", "__color"),
            "match_source": F.when(named, "product_name").when(told, "color_old"),
            "mapping_status": F.when(named, "MATCHED_FROM_NAME").when(told, "FALLBACK_FROM_OLD_COLOR").otherwise("UNMAPPED"),
        }
    ).drop("__name", "__color")


def color_standardize(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product").select("product_code", "product_name", "color")
    return standard_colors(p).select("product_code", F.col("color").alias("color_old"), "color_new", "match_source", "mapping_status")


def color_sync(spark: SparkSession, d: str) -> DataFrame:
    """Order lines by colour after the standard colours are written back to them, where one was found."""
    products = table(spark, d, "product").groupBy(clean_key(F.col("product_code")).alias("product")).agg(F.min("product_name").alias("product_name"), F.min("color").alias("color"))
    used = table(spark, d, "tmp_order_line").groupBy(clean_key(F.col("product_code")).alias("product")).agg(F.count(F.lit(1)).alias("n_lines")).where("product is not null")  # few keys, before the join
    lines = used.join(products.select("product", "color"), "product")
    now = update_from(lines, standard_colors(products).select("product", F.col("color_new").alias("color")), ["product"], ["color"])
    return now.groupBy("color").agg(F.sum("n_lines").alias("n_lines"))


#: Names and aliases of provinces that the plain map may have.
MOST_ALIASES = 10_000
# Aliases under four letters that may be looked for.
SHORT_ALIASES = ("hcm", "hue")


def province_aliases(spark: SparkSession, d: str) -> DataFrame:
    """(province_id, province_name, region, alias, kind), kind 'primary' or 'extra': plain names without the word for
    a province or city at their start, of four letters or more; of an alias that a province has twice the first kind."""
    provinces = table(spark, d, "province").where("province_id is not null and province_name is not null").select("province_id", "province_name", "region")
    named = provinces.withColumn("alias", F.col("province_name")).withColumn("kind", F.lit("primary"))
    more = provinces.join(table(spark, d, "province_alias"), "province_id").withColumn("kind", F.lit("extra"))
    both = named.unionByName(more.select(*named.columns)).withColumn("alias", bare_province(mapped_text(F.col("alias"))))
    safe = both.where((F.length("alias") >= 4) | F.col("alias").isin(*SHORT_ALIASES))
    return safe.groupBy("province_id", "province_name", "region", "alias").agg(F.max("kind").alias("kind"))


def province_map(spark: SparkSession, d: str) -> DataFrame:
    """The province that each staged address contains the name of, by plain containment in three passes: any alias
    between word ends, then names anywhere, then other aliases anywhere; the longest counts, at a tie the first name.
    No slips are read; that is what p1_map does."""
    listed = province_aliases(spark, d).limit(MOST_ALIASES + 1).collect()
    if len(listed) > MOST_ALIASES:
        raise ValueError(f"more than {MOST_ALIASES} names of provinces")
    listed = sorted(listed, key=lambda r: (-len(r.alias), r.province_name, r.alias))
    kind = "array<struct<at:int,province_id:int,province_name:string,region:string,alias:string,extra:boolean>>"
    rows = [{"at": i, "province_id": r.province_id, "province_name": r.province_name, "region": r.region, "alias": r.alias, "extra": r.kind == "extra"} for i, r in enumerate(listed)]
    aliases = F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), kind)  # a constant
    c = table(spark, d, "staging_customer").select("customer_code", "address", F.col("province_id").alias("province_id_old"), mapped_text(F.col("address")).alias("plain"))
    bounded = F.concat(F.lit(" "), "plain", F.lit(" "))
    passes = {
        "MATCHED_REGEX": lambda a: F.contains(bounded, F.concat(F.lit(" "), a["alias"], F.lit(" "))),
        "MATCHED_SUBSTRING_PRIMARY": lambda a: ~a["extra"] & F.contains(F.col("plain"), a["alias"]),
        "MATCHED_SUBSTRING_EXTRA": lambda a: a["extra"] & F.contains(F.col("plain"), a["alias"]),
    }
    # the list is in order, so the first that fits is the one
    found = c.withColumns({name: F.get(F.filter(aliases, fits), F.lit(0)) for name, fits in passes.items()})
    won = F.coalesce(*passes)
    status = F.when(F.col("plain") == "", "EMPTY_ADDRESS")
    for name in passes:
        status = status.when(F.col(name).isNotNull(), name)
    return found.select("customer_code", "address", "province_id_old", won["province_id"].alias("province_id"), won["province_name"].alias("province_name"), won["region"].alias("region"), won["alias"].alias("matched_alias"), status.otherwise("UNMAPPED").alias("mapping_status"))


# The units before the three numbers of an order line, plain.
LINE_UNITS = "Chiếc Chiec Cái Cai Bộ Bo Cặp Cap Thùng Thung Hộp Hop Cây Cay Ngày Ngay".split()
_NUMBER = "([0-9]+(?:[,.][0-9]+)*)"
_LINE = "(?i)^([0-9]+) ([A-Z0-9.]{8,25}) (.+)$"
_UNIT_UP = "|".join(sorted({x for u in LINE_UNITS for x in (u.lower(), u.upper(), u)}))
_REST = f"^.+? ({_UNIT_UP}) {_NUMBER} {_NUMBER} {_NUMBER}$"
_LAST = f"{_NUMBER}[^0-9]*$"


def order_lines_of(texts: DataFrame, keep: list[str], text: str) -> DataFrame:
    """(keep, line_no, stt, product_code, unit, quantity, unit_price, line_total, parse_error, warning): a row per line
    of ``text`` that begins with a number and a product's code.

    After a unit come quantity, price and total; without one they are the last three numbers. TOO_FEW_NUMBERS: there
    are not three; NOT_A_NUMBER: one is none, such as a quantity with two marks. A total of 0 is made quantity times
    price (TOTAL_FILLED), one that is more than 1 off is told (TOTAL_OFF). Null texts have no lines; dots in prices and
    totals stand between thousands, in a quantity a comma or dot stands before decimals.
    """
    lines = texts.select(*keep, F.posexplode(F.split(text, "\\r\\n|\\r|\\n")).alias("line_no", "line")).withColumn("line", clean(F.col("line"))).where(F.col("line").rlike(_LINE))
    head = lines.select(*keep, "line_no", "line", F.regexp_extract("line", _LINE, 1).alias("stt"), F.upper(F.regexp_extract("line", _LINE, 2)).alias("product_code"), F.regexp_extract("line", _LINE, 3).alias("rest"))
    numbers = F.regexp_extract_all("rest", F.lit(_NUMBER), F.lit(1))
    split = head.withColumn("unit", F.regexp_extract("rest", _REST, 1)).withColumn("n", numbers)
    k = F.size("n")
    text_of = {name: F.when(F.col("unit") != "", F.regexp_extract("rest", _REST, i + 2)).when(k >= 3, F.get("n", k - 3 + i)) for i, name in enumerate(("q", "p", "t"))}
    typed = split.withColumns(text_of).withColumns({"quantity": F.translate("q", ",", ".").try_cast("decimal(15,3)"), "unit_price": F.regexp_replace("p", "[.,]", "").try_cast("decimal(18,0)"), "given": F.regexp_replace("t", "[.,]", "").try_cast("decimal(18,0)")})
    error = F.when(F.col("q").isNull(), "TOO_FEW_NUMBERS").when(F.col("quantity").isNull() | F.col("unit_price").isNull() | F.col("given").isNull(), "NOT_A_NUMBER")
    made = F.round(F.col("quantity") * F.col("unit_price"), 0)
    good = typed.withColumn("parse_error", error).withColumn("made", made)
    sound = F.col("parse_error").isNull()
    warning = F.when(sound & (F.col("given") <= 0), "TOTAL_FILLED").when(sound & (F.abs(F.col("given") - F.col("made")) > 1), "TOTAL_OFF")
    total = F.when(F.col("given") <= 0, F.col("made")).otherwise(F.col("given"))
    values = {"quantity": F.col("quantity"), "unit_price": F.col("unit_price"), "line_total": total}
    return good.select(*keep, "line_no", "stt", "product_code", F.nullif("unit", F.lit("")).alias("unit"), *[F.when(sound, c).cast("double").alias(n) for n, c in values.items()], "parse_error", warning.alias("warning"))


def order_line_parse(spark: SparkSession, d: str) -> DataFrame:
    return order_lines_of(table(spark, d, "extract_fail").where("record_type = 'order_line'"), ["fail_id"], "raw_line")


def order_header(spark: SparkSession, d: str) -> DataFrame:
    """What documents say of their order: its number, as the first named, the tax code after MST, and the invoice symbol
    of the order's year; documents with neither are left out."""
    t = table(spark, d, "documents").where("text is not null")
    number = order_number([F.col("text")])
    head = t.select("doc_id", number.alias("so_number"), tax_code(F.col("text")).alias("tax_code"))
    return head.where("so_number is not null or tax_code is not null").withColumn("invoice_symbol", F.concat(F.lit("C"), F.substring("so_number", 3, 2), F.lit("TTN")))


def error_groups(spark: SparkSession, d: str) -> DataFrame:
    """Failures by the group of what an earlier run wrote of them."""
    return table(spark, d, "extract_fail").groupBy(error_group(F.col("error")).alias("error_group")).agg(F.count(F.lit(1)).alias("n"))


def regex_extract_key(spark: SparkSession, d: str) -> DataFrame:
    """The order numbers named in documents, every one, as BHyy.nnnnnnnn, with how often."""
    found = F.explode(F.regexp_extract_all("text", F.lit("(?i)BH([0-9]{2})[._-]([0-9]{8})"), F.lit(0)))
    named = table(spark, d, "documents").select("doc_id", found.alias("k"))
    return named.groupBy("doc_id", F.translate(F.upper("k"), "_-", "..").alias("so_number")).agg(F.count(F.lit(1)).alias("n"))


def parse_vn_numbers(spark: SparkSession, d: str) -> DataFrame:
    """How many amounts with dots between thousands every document names, and what they come to."""
    found = F.explode(F.regexp_extract_all("text", F.lit("([0-9]{1,3}(?:\\.[0-9]{3})+) đồng"), F.lit(1)))
    named = table(spark, d, "documents").select("doc_id", found.alias("k")).select("doc_id", amount(F.col("k")).alias("amount"))
    return named.groupBy("doc_id").agg(F.count("amount").alias("n"), F.sum("amount").cast("double").alias("amount"))


def html_strip(spark: SparkSession, d: str) -> DataFrame:
    """Product names set as a page and read back."""
    page = F.concat(F.lit("<html><style>p {}</style><body><p>"), "product_name", F.lit("</p><br/><b>"), F.coalesce("color", F.lit("&nbsp;")), F.lit("</b> &amp; more</body></html>"))
    return table(spark, d, "product").select("product_code", strip_html(page).alias("text"))


def text_quality(spark: SparkSession, d: str) -> DataFrame:
    """Documents per language and source: how many, how many without text, how long."""
    t = table(spark, d, "documents")
    return t.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("blank"), F.sum("n_chars").cast("double").alias("chars"), F.count_if(F.coalesce(F.length("text"), F.lit(0)) != F.col("n_chars")).alias("wrong_n_chars")
    )


QUERIES = {f.__name__: f for f in (normalize_text, color_standardize, color_sync, province_map, order_line_parse, order_header, error_groups, regex_extract_key, parse_vn_numbers, html_strip, text_quality)}


def _norm(c: str) -> str:
    return f"trim(regexp_replace(replace(lower(strip_accents(coalesce({c}, ''))), 'đ', 'd'), '[^a-z0-9]+', ' ', 'g'))"


_LIST = "[" + ", ".join(f"{{'size': {len(a)}, 'at': {-i}, 'alias': '{a}', 'name': '{n}'}}" for i, (a, n) in enumerate(COLORS.items())) + "]"


def _color(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace({_norm(c)}, '[0-9]+', ' ', 'g'), '{_NOISE}', ' ', 'g'), ' +', ' ', 'g'))"


def _alias(c: str) -> str:
    return f"list_max(list_filter({_LIST}, lambda x: contains(' ' || {_color(c)} || ' ', ' ' || x.alias || ' '))).name"


def _mapped(c: str) -> str:
    plain = f"case when lower(trim(coalesce({c}, ''))) in ('nan', 'none', 'null') then '' else {c} end"
    return _norm(f"({plain})")


_BARE = "regexp_replace(regexp_replace(regexp_replace({0}, '^tinh +', ''), '^thanh pho +', ''), '^tp +', '')"
_KEY = "nullif(upper(trim({0}, chr(32) || chr(9) || chr(13) || chr(10) || chr(11) || chr(12) || chr(160))), '')"
_COLORED = f"""c as (select {_KEY.format("product_code")} as product, min(product_name) as product_name, min(color) as color from product group by 1), s as (select product, color, {_alias("product_name")} as n, {_alias("color")} as o from c)"""


ORACLES = {
    "normalize_text": f"select product_code, {_norm('product_name')} as name, {_norm('color')} as color from product",
    "color_standardize": f"select product_code, color as color_old, coalesce(n, c) as color_new, case when n is not null then 'product_name' when c is not null then 'color_old' end as match_source, case when n is not null then 'MATCHED_FROM_NAME' when c is not null then 'FALLBACK_FROM_OLD_COLOR' else 'UNMAPPED' end as mapping_status from (select product_code, color, {_alias('product_name')} as n, {_alias('color')} as c from product) x",
    "color_sync": f"with {_COLORED} select coalesce(n, o, color) as color, count(*) as n_lines from tmp_order_line l join s on s.product = {_KEY.format('l.product_code')} group by 1",
    "province_map": f"""with names as (select province_id, province_name, region, {_BARE.format(_mapped('province_name'))} as alias, 'primary' as kind from province union all
            select p.province_id, province_name, region, {_BARE.format(_mapped('a.alias'))}, 'extra' from province p join province_alias a on a.province_id = p.province_id),
        al as (select province_id, province_name, region, alias, max(kind) as kind from names where length(alias) >= 4 or alias in ('hcm', 'hue') group by 1, 2, 3, 4),
        c as (select row_number() over () as row, customer_code, address, province_id as old, {_mapped('address')} as t from staging_customer),
        hits as (select row, al.*, case when contains(' ' || t || ' ', ' ' || alias || ' ') then 1 when kind = 'primary' then 2 else 3 end as pass from c join al on contains(t, alias)),
        won as (select * from (select *, row_number() over (partition by row order by pass, length(alias) desc, province_name, alias) as r from hits) x where r = 1)
        select customer_code, address, old as province_id_old, province_id, province_name, region, alias as matched_alias,
            case when t = '' then 'EMPTY_ADDRESS' when pass = 1 then 'MATCHED_REGEX' when pass = 2 then 'MATCHED_SUBSTRING_PRIMARY' when pass = 3 then 'MATCHED_SUBSTRING_EXTRA' else 'UNMAPPED' end as mapping_status from c left join won using (row)""",
    "order_line_parse": rf"""with l as (select fail_id, unnest(regexp_split_to_array(raw_line, '\r\n|\r|\n')) as line, generate_subscripts(regexp_split_to_array(raw_line, '\r\n|\r|\n'), 1) - 1 as line_no from extract_fail where record_type = 'order_line' and raw_line is not null),
        c as (select fail_id, line_no::int as line_no, trim(regexp_replace(line, '[\s\x{{A0}}]+', ' ', 'g')) as line from l),
        h as (select fail_id, line_no, regexp_extract(line, '{_LINE}', 1) as stt, upper(regexp_extract(line, '{_LINE}', 2)) as product_code, regexp_extract(line, '{_LINE}', 3) as rest from c where regexp_matches(line, '{_LINE}')),
        x as (select *, regexp_extract(rest, '{_REST}', 1) as u, regexp_extract_all(rest, '{_NUMBER}') as n from h),
        y as (select *, case when u <> '' then regexp_extract(rest, '{_REST}', 2) when len(n) >= 3 then n[len(n) - 2] end as q, case when u <> '' then regexp_extract(rest, '{_REST}', 3) when len(n) >= 3 then n[len(n) - 1] end as p,
            case when u <> '' then regexp_extract(rest, '{_REST}', 4) when len(n) >= 3 then n[len(n)] end as t from x),
        z as (select *, try_cast(replace(q, ',', '.') as decimal(15,3)) as qd, try_cast(regexp_replace(p, '[.,]', '', 'g') as decimal(18,0)) as pd, try_cast(regexp_replace(t, '[.,]', '', 'g') as decimal(18,0)) as td from y),
        e as (select *, case when q is null then 'TOO_FEW_NUMBERS' when qd is null or pd is null or td is null then 'NOT_A_NUMBER' end as parse_error, round(qd * pd, 0) as made from z)
        select fail_id, line_no, stt, product_code, nullif(u, '') as unit, case when parse_error is null then qd::double end as quantity, case when parse_error is null then pd::double end as unit_price,
            case when parse_error is null then (case when td <= 0 then made else td end)::double end as line_total, parse_error, case when parse_error is null and td <= 0 then 'TOTAL_FILLED' when parse_error is null and abs(td - made) > 1 then 'TOTAL_OFF' end as warning from e""",
    "order_header": r"with k as (select doc_id, translate(upper(nullif(regexp_extract(text, '(?i)BH[0-9]{2}[._-][0-9]{4,8}'), '')), '_-', '..') as so_number, nullif(regexp_extract(text, '(?i)\bMST\s*[:\-]?\s*([0-9]{8,15})\b', 1), '') as tax_code from documents where text is not null) select *, 'C' || substr(so_number, 3, 2) || 'TTN' as invoice_symbol from k where so_number is not null or tax_code is not null",
    "error_groups": "select case when trim(regexp_replace(coalesce(error, ''), '[\\s]+', ' ', 'g')) = '' then '' " + "".join(f"when contains(error, '{k}') then '{g}' " for k, g in ERROR_GROUPS.items()) + "else trim(regexp_replace(error, '[\\s]+', ' ', 'g')) end as error_group, count(*) as n from extract_fail group by 1",
    "regex_extract_key": "select doc_id, translate(upper(k), '_-', '..') as so_number, count(*) as n from (select doc_id, unnest(regexp_extract_all(text, '(?i)BH([0-9]{2})[._-]([0-9]{8})')) as k from documents where text is not null) x group by 1, 2",
    "parse_vn_numbers": "select doc_id, count(*) as n, sum(replace(k, '.', '')::decimal(15,0))::double as amount from (select doc_id, unnest(regexp_extract_all(text, '([0-9]{1,3}(?:\\.[0-9]{3})+) đồng', 1)) as k from documents where text is not null) x group by 1",
    "html_strip": "select product_code, product_name || chr(10) || case when color is null then '& more' else trim(color) || ' & more' end as text from product",
    "text_quality": "select lang, source, count(*) as n, count(*) filter (where coalesce(trim(text), '') = '') as blank, sum(n_chars)::double as chars, count(*) filter (where coalesce(length(text), 0) <> n_chars) as wrong_n_chars from documents group by 1, 2",
}
