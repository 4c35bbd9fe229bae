"""Text functions as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Letters with marks of the Latin blocks and the letters they stand for, from Unicode's decompositions."""
    marked, bare = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        if len(base) == 1 and base != c:
            marked.append(c)
            bare.append(base)
    return "".join(marked) + "đĐ", "".join(bare) + "dD"


MARKED, BARE = _accents()


def unaccent(text: Column) -> Column:
    """Latin letters without their marks, composed or not, đ as d."""
    return F.regexp_replace(F.translate(text, MARKED, BARE), "\\p{M}+", "")


def clean(text: Column) -> Column:
    """White space squeezed and trimmed; null as ''."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\s\\u00A0]+", " "))


def clean_lines(text: Column) -> Column:
    """Every line cleaned, empty ones dropped; null as ''."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\\r\\n|\\r|\\n"), clean)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def normalize(text: Column) -> Column:
    """Lower case, unaccented, all but a-z, 0-9 as one blank."""
    return F.trim(F.regexp_replace(F.lower(unaccent(F.coalesce(text, F.lit("")))), "[^a-z0-9]+", " "))


def normalized(text: str) -> str:
    """What ``normalize`` makes of a constant."""
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).replace("đ", "d").replace("Đ", "D")
    return re.sub("[^a-z0-9]+", " ", bare.lower()).strip()


# How files write that a value is missing.
MISSING = ("nan", "none", "null")


def mapped_text(text: Column) -> Column:
    """``normalize``, where the words for a missing value are none."""
    return F.when(F.lower(F.trim(text)).isin(*MISSING), "").otherwise(normalize(text))


def bare_province(text: Column) -> Column:
    """A normalized name without the word for a province or a city at its start."""
    for mark in ("tinh", "thanh pho", "tp"):
        text = F.regexp_replace(text, f"^{mark} +", "")
    return text


# What an error says and the group it belongs to; the first that it contains counts.
ERROR_GROUPS = {
    "Trùng so_number trong batch": "Trùng so_number trong batch",
    "Không tìm thấy PDF đính kèm": "Không tìm thấy PDF đính kèm",
    "Không trích xuất được so_number": "Không trích xuất được so_number",
    "Không lấy được order_date từ email header Date": "Không lấy được order_date từ email header Date",
    "Không trích xuất được MST": "Không trích xuất được MST",
    "Không trích xuất được customer_name": "Không trích xuất được customer_name từ email body",
    "Không tạo/lấy được customer_code": "Không tạo/lấy được customer_code",
    "product_code không tồn tại trong master": "product_code không tồn tại trong master data",
    "Không đủ 3 số cuối": "Không đủ 3 số cuối để lấy quantity, unit_price, line_total",
    "Lỗi parse số:": "Lỗi parse số",
    "Thiếu product_code": "Thiếu product_code",
    "Thiếu quantity": "Thiếu quantity",
    "quantity <= 0": "quantity <= 0",
    "Thiếu unit_price": "Thiếu unit_price",
    "unit_price < 0": "unit_price < 0",
    "Thiếu line_total": "Thiếu line_total",
    "line_total <= 0": "line_total <= 0",
    "line_total lệch calculated_total": "line_total lệch calculated_total",
    "Không trích xuất được dòng hàng nào từ PDF": "Không trích xuất được dòng hàng nào từ PDF",
    "Không còn order_line hợp lệ": "Không còn order_line hợp lệ",
    "Sales_order lỗi": "Sales_order lỗi",
}


def error_group(error: Column) -> Column:
    """The group of an error's text; the text itself, cleaned, where it is in none, '' for null."""
    said = clean(error)
    out = F.when(said == "", "")
    for part, group in ERROR_GROUPS.items():
        out = out.when(F.contains(said, F.lit(part)), group)
    return out.otherwise(said)


def moment(text: Column) -> Column:
    """A date and time as typed, null where it is none."""
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit("dd/MM/yyyy HH:mm:ss")), F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))


def fenced_json(text: Column, schema: str) -> Column:
    """The JSON in ``text``, with or without a code fence around it, as ``schema``; null where it is none."""
    bare = F.regexp_replace(F.trim(text), "(?s)^```(?:json)?\\s*|\\s*```$", "")
    return F.from_json(bare, schema, {"mode": "PERMISSIVE"})


def distinct_parts(text: Column, separator: str = ",") -> Column:
    """The parts of a list typed with ``separator``, trimmed, each once, in order, none empty."""
    parts = F.transform(F.split(text, f"\\Q{separator}\\E"), lambda x: F.trim(x))
    return F.filter(F.array_distinct(parts), lambda x: x != "")


def strip_html(html: Column) -> Column:
    """The text of a page: no scripts and styles, breaks and paragraphs as lines, tags as blanks."""
    x = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1>", " ")
    x = F.regexp_replace(x, "(?i)<br\\s*/?>|</p>|</div>", "\n")
    x = F.regexp_replace(x, "(?s)<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return clean_lines(x)


def amount(text: Column) -> Column:
    """A number as typed in Vietnamese, dots between thousands; null where it is none."""
    return F.regexp_replace(text, "[.,\\s]", "").try_cast("decimal(15,0)")


def quantity(text: Column) -> Column:
    return F.translate(text, ",", ".").try_cast("decimal(10,2)")


def longest_alias(text: Column, aliases: dict[str, str]) -> Column:
    """The name whose alias, the longest found between blanks in the normalized ``text``, stands in it; null where
    none does. Of equally long aliases the first in order wins. ``aliases`` is a fixed list: alias to name."""
    found = F.filter(F.array(*[F.struct(F.lit(len(a)).alias("size"), F.lit(-i).alias("at"), F.lit(a).alias("alias"), F.lit(n).alias("name")) for i, (a, n) in enumerate(aliases.items())]), lambda x: F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), x["alias"], F.lit(" "))))
    return F.array_max(found)["name"]


def parse_flag(text: Column, default: bool) -> Column:
    """true, 1, yes, y, t and their contraries; ``default`` for all else."""
    low = F.lower(F.trim(text))
    return F.when(low.isin("true", "1", "yes", "y", "t"), True).when(low.isin("false", "0", "no", "n", "f"), False).otherwise(default)


def first_match(texts: list[Column], pattern: str, group: int = 0) -> Column:
    """What ``pattern`` finds in the first of ``texts`` that has it; null where none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(t, pattern, group), F.lit("")) for t in texts])


def order_number(texts: list[Column]) -> Column:
    """The order number that the first of ``texts`` names, as BHyy.digits."""
    return F.translate(F.upper(first_match(texts, "(?i)BH[0-9]{2}[._-][0-9]{4,8}")), "_-", "..")


def tax_code(text: Column) -> Column:
    return first_match([text], "(?i)\\bMST\\s*[:\\-]?\\s*([0-9]{8,15})\\b", 1)


def labelled(text: Column, labels: list[str], stops: list[str]) -> Column:
    """The shortest text after one of ``labels`` and a colon, up to one of ``stops``, a line's end or the end; white
    space squeezed, null where there is none. Labels and stops are plain words, compared without case."""
    ends = "|".join([*(f"\\b{s}\\s*:" for s in stops), "\\n", "$"])
    found = F.array(*[F.nullif(clean(F.regexp_extract(text, f"(?iu)\\b{w}\\s*:\\s*(.*?)\\s*(?:{ends})", 1)), F.lit("")) for w in labels])
    return F.try_element_at(F.array_sort(F.filter(found, lambda x: x.isNotNull()), lambda a, b: F.length(a) - F.length(b)), F.lit(1))


def safe_filename(name: Column) -> Column:
    return F.regexp_replace(name, '[<>:"/\\\\|?*\\x00-\\x1f]', "_")


def money_text(value: Column) -> Column:
    """Rounded half up, thousands set off; '' for null."""
    return F.coalesce(F.format_number(F.round(value, 0).cast("decimal(38,0)"), 0), F.lit(""))


def records(*columns: str) -> Column:
    """An aggregate: the rows of a group as a JSON array of objects, ordered by their values. For small groups."""
    return F.to_json(F.array_sort(F.collect_list(F.struct(*columns))))
