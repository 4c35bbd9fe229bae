"""Rows that fail to parse: every column read as text, checked by rules, split by their error arrays."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("stt", "product_code", "name", "unit", "quantity", "unit_price", "line_total")

# The units that end a product name in a line of text.
UNITS = ("Chiếc", "Cái", "Bộ", "Cặp", "Thùng", "Hộp", "Cây")

#: White space and marks that are ignored around lines and values: Unicode's blanks and the byte-order mark.
_WS = "[\\s\\u0085\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF]"
#: Stand for a comma between values; a code point that is no character, so it is in no text.
_CUT = "￿"


def _strip(value: Column) -> Column:
    return F.regexp_replace(value, f"^{_WS}+|{_WS}+$", "")


def _units() -> list[str]:
    """Lower-case spellings of the units: composed, decomposed and without accents."""
    out = set()
    for unit in UNITS:
        low = unit.lower()
        split = unicodedata.normalize("NFD", low)
        out |= {low, split, "".join(c for c in split if not unicodedata.combining(c))}
    return sorted(out)


def csv_values(parts: Column) -> tuple[Column, Column]:
    """(broken quoting?, values) of one comma-separated record whose values may be quoted by ``"``.

    ``parts`` is the column that holds the text cut at its quotes, a column of its own so that it is cut once:
    pieces 1, 3, 5... are inside quotes, an empty piece between two of
    them is a doubled quote, and all other pieces outside must begin and end at a comma or the line's
    ends. So a line is read in one pass of array functions however long it is.
    """
    last = F.size(parts) - 1

    def outside_ok(x: Column, i: Column) -> Column:
        starts = (i == 0) | x.rlike(f"^{_WS}*,")
        ends = (i == last) | x.rlike(f",{_WS}*$")
        blank_end = ((i == 0) | (i == last)) & x.rlike(f"^{_WS}*$")
        return (last == 0) | blank_end | ((i > 0) & (i < last) & (x == "")) | (starts & ends)

    checked = F.transform(parts, lambda x, i: (i % 2 == 1) | outside_ok(x, i))
    broken = (last % 2 == 1) | F.exists(checked, lambda ok: ~ok)
    joined = F.array_join(
        F.transform(
            parts,
            lambda x, i: F.when(i % 2 == 1, x).when((i > 0) & (i < last) & (x == ""), F.lit('"')).otherwise(F.translate(x, ",", _CUT)),
        ),
        "",
    )
    return broken, F.transform(F.split(joined, _CUT, -1), _strip)


def last_unit(words: Column) -> Column:
    """The 1-based place of the last unit among ``words``; one after the last word where there is none."""
    flags = F.transform(words, lambda w: F.lower(w).isin(_units()))
    return F.size(words) - F.array_position(F.reverse(flags), True).cast("int") + 1


def text_values(words: Column, unit: Column) -> tuple[Column, Column]:
    """(wrong shape?, values) of one line of text, its words: stt, code, name of one or more words, unit, three values.
    ``unit`` is the column with the last unit's place, so that it is looked for once; one after the last word is none."""
    wrong = (unit < 4) | (F.size(words) - unit != 3)
    name = F.array_join(F.slice(words, F.lit(3), F.greatest(unit - 3, F.lit(0))), " ")
    return wrong, F.array(F.get(words, F.lit(0)), F.get(words, F.lit(1)), name, *[F.get(words, F.greatest(unit, F.lit(1)) - 1 + k) for k in range(4)])


#: Types of the loaded numbers: as wide as Spark has, since the rules bound neither stt nor an amount.
TYPES = {"stt": "decimal(38,0)", "quantity": "decimal(10,2)", "unit_price": "decimal(38,2)", "line_total": "decimal(38,2)"}
#: The kind of error of a valid value that its type cannot hold.
TOO_LONG = "TOO_LONG"


def casts(v: dict[str, Column]) -> dict[str, Column]:
    """The numbers among the fields, null where the type does not hold them; of valid values no other is null."""
    digits = {f: F.translate(v[f], ".", "") for f in ("stt", "unit_price", "line_total")}
    digits["quantity"] = F.translate(v["quantity"], ",", ".")
    return {f: digits[f].try_cast(t) for f, t in TYPES.items()}


def value_errors(v: dict[str, Column]) -> Column:
    """KIND:field of the fields whose value is invalid, in the order of the fields: BAD_VALUE where a rule fails or
    the value is null, TOO_LONG where only the cast does."""
    money = "^(?:[0-9]+|[0-9]{1,3}(?:\\.[0-9]{3})+)$"
    rules = {
        "stt": v["stt"].rlike("^0*[1-9][0-9]*$"),
        "product_code": v["product_code"].rlike("^[A-Z0-9.]{8,25}$"),
        "quantity": v["quantity"].rlike("^[0-9]{1,5}(?:[.,][0-9]{1,2})?$") & v["quantity"].rlike("[1-9]"),
        "unit_price": v["unit_price"].rlike(money),
        "line_total": v["line_total"].rlike(money) & v["line_total"].rlike("[1-9]"),
    }
    held = casts(v)
    bad = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(f"BAD_VALUE:{f}")) for f, ok in rules.items()])
    # a rule that holds bounds the digits of all but these three, so only they can be too long
    long = F.array(*[F.when(F.coalesce(rules[f], F.lit(False)) & (F.length(v[f]) > 36) & held[f].isNull(), F.lit(f"{TOO_LONG}:{f}")) for f in ("stt", "unit_price", "line_total")])
    return F.array_compact(F.concat(bad, long))


def read_lines(rows: DataFrame, raw: Column, is_csv: Column, keep: dict[str, Column]) -> DataFrame:
    """``keep``, the seven fields as text, ``errors`` and ``reason`` for every row of ``rows``.

    ``is_csv`` tells a comma-separated record from a line of text (null counts as text). ``errors`` is an
    array of reasons, in the order EMPTY, QUOTING, COLUMN_COUNT, BAD_VALUE:field..., TOO_LONG:field... (a valid
    number of more digits than ``TYPES`` can hold), empty for sound rows;
    ``reason`` is the first one without the field's name, null for sound rows. Later rules are not asked
    where EMPTY, QUOTING or COLUMN_COUNT holds. Rows are neither dropped nor merged; an empty input gives
    an empty result; columns of ``rows`` other than those in ``keep`` are left out.
    """
    base = rows.select(*[c.alias(f"k_{n}") for n, c in keep.items()], _strip(raw).alias("line"), F.coalesce(is_csv, F.lit(False)).alias("csv"))
    empty = F.coalesce(F.col("line"), F.lit("")) == ""
    cut = base.withColumns({"parts": F.when(F.col("csv"), F.split("line", '"', -1)), "words": F.when(~F.col("csv"), F.split("line", f"{_WS}+", -1))})
    quoting, csv = csv_values(F.col("parts"))
    wrong, words = text_values(F.col("words"), F.col("unit"))
    seen = cut.withColumn("unit", last_unit(F.col("words"))).withColumn("x", F.when(~empty & F.col("csv"), F.struct(quoting.alias("q"), csv.alias("v")))).withColumn(
        "t", F.when(~empty & ~F.col("csv"), F.struct(wrong.alias("w"), words.alias("v")))
    )
    shape = (
        F.when(empty, F.lit("EMPTY"))
        .when(F.col("csv") & F.col("x.q"), F.lit("QUOTING"))
        .when(F.col("csv") & (F.size("x.v") != len(FIELDS)), F.lit("COLUMN_COUNT"))
        .when(~F.col("csv") & F.col("t.w"), F.lit("COLUMN_COUNT"))
    )
    # A filter stops at a generated column and is not moved into the steps below, where it would read a line again
    # for each of its values.
    def held(**columns: Column) -> Column:
        return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))

    kept = [f"k_{n}" for n in keep]
    typed = seen.select(*kept, held(shape=shape, v=F.when(F.col("csv"), F.col("x.v")).otherwise(F.col("t.v"))))
    fields = {f: F.when(F.col("shape").isNull(), F.get(F.col("v"), F.lit(i))) for i, f in enumerate(FIELDS)}
    split = typed.select(*kept, "shape", *[c.alias(f) for f, c in fields.items()])
    errors = F.when(F.col("shape").isNotNull(), F.array("shape")).otherwise(value_errors({f: F.col(f) for f in FIELDS}))
    told = split.select(*kept, *FIELDS, held(errors=errors))
    return told.select(*[F.col(f"k_{n}").alias(n) for n in keep], *FIELDS, "errors", F.substring_index(F.get("errors", F.lit(0)), ":", 1).alias("reason"))


def split_rows(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound rows with typed values, broken rows with their errors) of what read_lines gave. The error array holds
    what the casts refuse, so no value of a sound row is lost."""
    sound = read.where(F.size("errors") == 0).withColumns(casts({f: F.col(f) for f in FIELDS})).drop("errors", "reason")
    return sound, read.where(F.size("errors") > 0)
