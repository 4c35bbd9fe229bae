"""Operators of the general problems on small cases with known results and against brute force."""

import datetime as dt
import decimal
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pedalmill.functions.keys import clean_key
from pedalmill.operators.broken_rows import read_lines, split_rows
from pedalmill.operators.even_totals import even_totals, frequent_keys
from pedalmill.operators.global_rank import global_quantiles, global_row_number, ntile, quantile_bin
from pedalmill.operators.orphan_refs import find_orphans, parent_runs
from pedalmill.operators.rolling_totals import rolling_totals

T = dt.datetime


def orphans(spark, refs, parents, dots=False):
    r = spark.createDataFrame(refs, "row_id bigint, k string, at timestamp_ntz, shape string, n int, runs string, block int")
    p = spark.createDataFrame(parents, "k string, a timestamp_ntz, b timestamp_ntz, spans string")
    runs = parent_runs(p, clean_key(F.col("k"), dots), F.col("a"), F.col("b"))
    return sorted((x.row_id, x.why) for x in find_orphans(r, F.col("row_id"), clean_key(F.col("k"), dots), F.col("at"), runs).collect())


def ref(i, k, at=T(2024, 5, 1)):
    return (i, k, at, "clash", 1, "clash", 2)


class TestOrphans:
    def test_lives(self, spark):
        parents = [("KH-01", T(2024, 1, 1), T(2024, 3, 1), ""), ("KH-01", T(2024, 6, 1), None, ""), ("kh-02 ", T(2024, 1, 1), None, ""), ("KH-15", T(2024, 1, 1), None, ""), ("KH-16", T(2024, 1, 1), None, "")]
        refs = [ref(1, "KH-01", T(2024, 1, 1)), ref(2, "KH-01", T(2024, 3, 1)), ref(3, "KH-01", T(2024, 7, 1)), ref(4, " kh-02"), ref(5, "KH-03"), ref(6, "KH-2"), ref(7, "KH-16"), ref(8, "KH-17"), ref(9, "KH-00"), ref(10, "X")]
        assert orphans(spark, refs, parents) == [(2, "not_live"), (5, "missing"), (6, "missing"), (8, "missing"), (9, "missing"), (10, "missing")]

    def test_nulls_blanks_repeats(self, spark):
        refs = [ref(1, None), ref(2, "   "), ref(3, "A1", None), ref(4, "A2"), ref(4, "A2"), ref(5, "q" * 5000 + "7")]
        assert orphans(spark, refs, [("A1", None, None, ""), (None, T(2020, 1, 1), None, "")]) == [(4, "missing"), (4, "missing"), (5, "missing")]

    def test_empty(self, spark):
        assert orphans(spark, [], [("A1", T(2020, 1, 1), None, "")]) == []
        assert orphans(spark, [ref(1, "A1")], []) == [(1, "missing")]

    def test_dots_and_long_numbers(self, spark):
        parents = [("BH24.00000001", T(2020, 1, 1), None, ""), ("9" * 30, T(2020, 1, 1), None, "")]
        assert orphans(spark, [ref(1, "bh24_00000001"), ref(2, "BH24-00000001"), ref(3, "9" * 30), ref(4, "9" * 29)], parents, True) == [(4, "missing")]

    def test_brute_force_with_a_hot_key(self, spark):
        rng = random.Random(3)
        day = lambda: T(2024, 1, 1) + dt.timedelta(days=rng.randrange(100))
        parents = []
        for _ in range(300):
            a = day()
            parents.append((f"P{rng.randrange(80):03d}", a, a + dt.timedelta(days=rng.randrange(60)) if rng.random() < 0.5 else None, ""))
        refs = [ref(i, "P007" if rng.random() < 0.4 else f"P{rng.randrange(100):03d}", day()) for i in range(3000)]
        live = lambda k, t: any(p[0] == k and p[1] <= t and (p[2] is None or t < p[2]) for p in parents)
        assert [i for i, _ in orphans(spark, refs, parents)] == [r[0] for r in refs if not live(r[1], r[2])]


class TestRolling:
    def run(self, spark, rows, lo, hi):
        a = spark.createDataFrame(rows, "c string, d date, m decimal(15,2), e string, day string, total int, run int")
        cal = spark.createDataFrame([(lo, hi)], "lo date, hi date")
        return {(r.c, r.d): r for r in rolling_totals(a, cal, "c", "d", "m").collect()}

    def test_brute_force(self, spark):
        rng = random.Random(5)
        lo, hi = dt.date(2024, 1, 1), dt.date(2024, 3, 31)
        rows = [(f"c{rng.randrange(4)}", lo + dt.timedelta(days=rng.randrange(91)), decimal.Decimal(rng.randrange(10**6)) / 100, "x", "y", 1, 2) for _ in range(200)]
        rows += [("c9", None, decimal.Decimal(5), "x", "y", 1, 2), (None, lo, decimal.Decimal(5), "x", "y", 1, 2), ("c1", hi, None, "x", "y", 1, 2), ("c1", dt.date(2023, 1, 1), decimal.Decimal(7), "x", "y", 1, 2)]
        got = self.run(spark, rows, lo, hi)
        assert len(got) == 5 * 91
        for (c, d), r in got.items():
            for n, s, a in ((7, r.sum_7d, r.avg_7d), (30, r.sum_30d, r.avg_30d)):
                want = sum(m or 0 for k, x, m, *_ in rows if k == c and x and lo <= x <= d and x > d - dt.timedelta(days=n))
                assert s == pytest.approx(float(want)) and a == pytest.approx(float(want) / n)

    def test_empty(self, spark):
        assert self.run(spark, [], dt.date(2024, 1, 1), dt.date(2024, 1, 2)) == {}
        assert self.run(spark, [("a", dt.date(2024, 1, 1), decimal.Decimal(1), "", "", 0, 0)], None, None) == {}


LINES = [
    ("t", None, "EMPTY"), ("t", "﻿  \t", "EMPTY"), ("c", "", "EMPTY"),
    ("t", "1 000119999 Xe đạp Chiếc 2 1.000 2.000", None), ("t", "1 000119999 Xe CHIEC 2,5 1000 2000", None), ("t", " 1\t000119999  Xe Bộ Bộ 2 1.000 2.000 ", None),
    ("t", "1 000119999 Chiếc 2 1.000 2.000", "COLUMN_COUNT"), ("t", "1 000119999 Xe Chiếc 2 1.000", "COLUMN_COUNT"), ("t", "1 000119999 Xe 2 1.000 2.000", "COLUMN_COUNT"), ("t", "Trang 2/3", "COLUMN_COUNT"),
    ("t", "0 000119999 Xe Chiếc 2 1.000 2.000", "BAD_VALUE"), ("t", "1 00011 Xe Chiếc 2 1.000 2.000", "BAD_VALUE"), ("t", "1 00011999a Xe Chiếc 2 1.000 2.000", "BAD_VALUE"),
    ("t", "1 000119999 Xe Chiếc 0,0 1.000 2.000", "BAD_VALUE"), ("t", "1 000119999 Xe Chiếc 123456 1.000 2.000", "BAD_VALUE"), ("t", "1 000119999 Xe Chiếc 2 1.00 2.000", "BAD_VALUE"), ("t", "1 000119999 Xe Chiếc 2 0 0.000", "BAD_VALUE"),
    ("c", "1,000119999,Xe,Cái,2,1.000,2.000", None), ("c", '"1" , "000119999","Xe ""26"", đỏ\nmới",Cái,"2,5",0,2000\r', None), ("c", "﻿1,000119999,,,2,1.000,2.000", None),
    ("c", '1,000119999,"Xe,Cái,2,1.000,2.000', "QUOTING"), ("c", '1,000119999,"Xe"x,Cái,2,1.000,2.000', "QUOTING"), ("c", '1,000119999,Xe 26",Cái,2,1.000,2.000', "QUOTING"), ("c", 'a"b', "QUOTING"),
    ("c", "1,000119999,Xe,Cái,2,1.000", "COLUMN_COUNT"), ("c", "1;2", "COLUMN_COUNT"), ("c", "1,000119999,Xe,Cái,,1.000,2.000", "BAD_VALUE"), ("c", '"",000119999,Xe,Cái,2,1.000,2.000', "BAD_VALUE"),
    ("c", "1,000119999," + "x" * 300_000 + ",Cái,2,1.000,2.000", None), ("c", '1,000119999,"' + 'a""' * 50_000 + '",Cái,2,1.000,2.000', None),
]


class TestBrokenRows:
    def read(self, spark, rows):
        df = spark.createDataFrame([(i, k, x, "clash", "clash") for i, (k, x, _) in enumerate(rows)], "i int, k string, raw string, stt string, errors string")
        return read_lines(df, F.col("raw"), F.col("k") == "c", {"i": F.col("i")})

    def test_reasons(self, spark):
        got = {r.i: r.reason for r in self.read(spark, LINES).collect()}
        assert got == {i: w for i, (_, _, w) in enumerate(LINES)}

    def test_values(self, spark):
        sound, broken = split_rows(self.read(spark, LINES))
        rows = {r.i: r for r in sound.collect()}
        assert set(rows) | {r.i for r in broken.collect()} == set(range(len(LINES)))
        r = rows[18]
        assert (r.stt, r["name"], r.unit, float(r.quantity), float(r.unit_price), float(r.line_total)) == (1, 'Xe "26", đỏ\nmới', "Cái", 2.5, 0, 2000)
        assert rows[5]["name"] == "Xe Bộ"

    def test_long_numbers_are_held_or_told(self, spark):
        lines = ["1 000119999 Xe Bộ 2 99999999999999 1", "12345678901234567890 000119999 Xe Bộ 2 1 99.999.999.999.999.999", f"{'9' * 38} 000119999 Xe Bộ 2 1 {'9' * 36}", f"{'9' * 39} 000119999 Xe Bộ 2 {'9' * 37} 1", f"{'0' * 60}7 000119999 Xe Bộ 2 1 1"]
        sound, broken = split_rows(self.read(spark, [("t", x, None) for x in lines]))
        rows = {r.i: r for r in sound.collect()}
        assert rows[0].unit_price == 99999999999999 and rows[1].stt == 12345678901234567890 and rows[1].line_total == 99999999999999999 and rows[2].stt == 10**38 - 1 and rows[4].stt == 7
        assert not any(v is None for r in rows.values() for v in r)
        assert {r.i: (r.errors, r.reason) for r in broken.collect()} == {3: (["TOO_LONG:stt", "TOO_LONG:unit_price"], "TOO_LONG")}

    def test_empty(self, spark):
        assert self.read(spark, []).count() == 0


class TestEvenTotals:
    def test_brute_force_and_small_dictionaries(self, spark):
        rng = random.Random(7)
        big = decimal.Decimal("9999999999999999.99")
        rows = [(rng.choice(["hot", "hot", None, "", *map(str, range(50))]), rng.choice([None, big, -big, decimal.Decimal("1.01")])) for _ in range(5000)]
        df = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "k string, v decimal(18,2), n int, h0 int").repartition(7)
        want = {}
        for k, v in rows:
            n, s = want.get(k, (0, decimal.Decimal(0)))
            want[k] = (n + 1, s + (v or 0))
        for size in (3, 1 << 18):
            got = even_totals(df, F.col("k"), {"v": F.col("v")}, dictionary=size)
            assert {r.k: (r.n_rows, r.v) for r in got.collect()} == want

    def test_frequent_counts_null_rows(self, spark):
        df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [(None,)] * 6, "k string")
        assert {r.k for r in frequent_keys(even_totals(df, F.col("k")), 0.3).collect()} == {"a"}

    def test_empty(self, spark):
        df = spark.createDataFrame([], "k string, v decimal(18,2)")
        t = even_totals(df, F.col("k"), {"v": F.col("v")})
        assert t.count() == 0 and frequent_keys(t, 0.1).count() == 0


class TestGlobalRank:
    def test_brute_force(self, spark):
        rng = random.Random(11)
        rows = [(rng.randrange(20), f"c{i:05d}") for i in range(3000)]
        df = spark.createDataFrame(rows, "v int, c string").repartition(5)
        for desc in (False, True):
            got = {r.c: r.rn for r in global_row_number(df, [("v", desc), ("c", False)], buckets=13).collect()}
            want = sorted(rows, key=lambda r: (-r[0] if desc else r[0], r[1]))
            assert got == {c: i + 1 for i, (_, c) in enumerate(want)}

    def test_tiles(self, spark):
        for n in (1, 4, 7, 12, 15):
            df = spark.range(1, n + 1).select(F.col("id").alias("rn"), F.lit(n).alias("n"))
            df.createOrReplaceTempView("t")
            want = [r.t for r in spark.sql("select ntile(5) over (order by rn) t from t order by rn").collect()]
            assert [r.t for r in df.orderBy("rn").select(ntile(F.col("rn"), F.col("n"), 5).alias("t")).collect()] == want
        bins = spark.range(1, 13).select(quantile_bin(F.col("id"), F.lit(12), 5).alias("b")).collect()
        assert sorted(r.b for r in bins) == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 5]

    def test_empty(self, spark):
        assert global_row_number(spark.createDataFrame([], "v int, c string"), [("v", False), ("c", False)]).count() == 0
        assert global_quantiles(spark.createDataFrame([], "v double"), "v", {"q": 0.5}).first().q is None

    def test_quantiles(self, spark):
        rng = random.Random(13)
        for n in (1, 2, 3, 10, 501):
            values = [rng.choice([1.5, 2.0, rng.random() * 100]) for _ in range(n)]
            df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(3)
            got = global_quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 1.0}).first()
            assert list(got) == pytest.approx(list(np.quantile(values, [0.25, 0.5, 1.0])))

    def test_nulls_have_ranks(self, spark):
        df = spark.createDataFrame([(None, "b"), (1, "a"), (None, "a")], "v int, c string")
        assert [(r.v, r.c) for r in global_row_number(df, [("v", False), ("c", False)]).orderBy("rn").collect()] == [(None, "a"), (None, "b"), (1, "a")]
