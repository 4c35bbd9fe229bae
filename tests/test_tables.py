"""Upserts, files, e-mails, versions and streams."""

from email.message import EmailMessage

import pytest
from pyspark.sql import functions as F

from pedalmill.functions.text import clean, clean_lines, labelled, money_text, normalize, order_number, parse_flag, records, safe_filename, strip_html, tax_code
from pedalmill.operators.upsert import dedup, delete_keys, duplicates, insert_ignore, update_from, upsert
from pedalmill.sources.csv_io import export_csv, read_csv, write_csv
from pedalmill.sources.mail import read_mail
from pedalmill.sources.store import TableStore
from pedalmill.streaming.files import Progress, upsert_into, watch, windowed_counts


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


class TestUpsert:
    def test_replaces_adds_keeps(self, spark):
        old = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, v string, id int")
        new = spark.createDataFrame([(2, "B", 99), (3, "c", 30), (None, "N", 7)], "k int, v string, id int")
        once = upsert(old, new, ["k"], keep=("id",))
        assert rows(once) == sorted([(1, "a", 10), (2, "B", 20), (3, "c", 30), (None, "N", 0)], key=str)
        assert rows(upsert(once, new, ["k"], keep=("id",))) == rows(once)

    def test_small_ones(self, spark):
        t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "z")], "k int, v string")
        assert rows(dedup(t, ["k"], [F.col("v")])) == [(1, "a"), (2, "c")]
        assert rows(duplicates(t, ["k"])) == [(1, 2)]
        assert rows(delete_keys(t, t.where("k = 1"), ["k"])) == [(2, "c"), (None, "z")]
        n = spark.createDataFrame([(2, "x"), (3, "y"), (3, "w")], "k int, v string")
        assert rows(insert_ignore(t.where("k = 2"), n, ["k"], [F.col("v")])) == [(2, "c"), (3, "w")]
        assert rows(update_from(t.where("k = 2"), n.where("k = 2"), ["k"], ["v"])) == [(2, "x")]

    def test_empty(self, spark):
        e = spark.createDataFrame([], "k int, v string")
        t = spark.createDataFrame([(1, "a")], "k int, v string")
        assert rows(upsert(t, e, ["k"])) == [(1, "a")] and rows(upsert(e, t, ["k"])) == [(1, "a")] and dedup(e, ["k"], [F.col("v")]).count() == 0


class TestFiles:
    def test_csv(self, spark, tmp_path):
        p = tmp_path / "a.csv"
        p.write_text('code, name \nK1,"a ""q"", b\nc"\n , x\n', encoding="utf-8-sig")
        df = read_csv(spark, str(p), ["code"])
        assert rows(df) == sorted([("K1", 'a "q", b\nc'), (None, "x")], key=str)
        with pytest.raises(ValueError, match="nope"):
            read_csv(spark, str(p), ["nope"])
        write_csv(df, str(tmp_path / "out"))
        assert rows(read_csv(spark, str(tmp_path / "out"))) == rows(df)
        assert export_csv(df, str(tmp_path / "one.csv")) == 2
        assert (tmp_path / "one.csv").read_bytes().startswith(b"\xef\xbb\xbf")
        with pytest.raises(ValueError):
            export_csv(df, str(tmp_path / "two.csv"), most_rows=1)

    def test_mail(self, spark, tmp_path):
        m = EmailMessage()
        m["From"], m["Subject"], m["Message-ID"], m["Date"] = "Đại lý <a@b.vn>", "Đơn BH24.00000001", "<1@x>", "Mon, 05 Aug 2024 10:00:00 +0700"
        m.set_content("Kính gửi\n\n  phòng kinh doanh")
        m.add_attachment(b"%PDF-1.4", maintype="application", subtype="pdf", filename="đơn.pdf")
        (tmp_path / "a.eml").write_bytes(m.as_bytes())
        h = EmailMessage()
        h.set_content("<p>Xin <b>chào</b></p><script>x()</script>", subtype="html")
        (tmp_path / "b.eml").write_bytes(h.as_bytes())
        (tmp_path / "c.eml").write_bytes(b"\xff\xfe broken")
        a, b, c = read_mail(spark, str(tmp_path)).orderBy("path").collect()
        assert (a.from_address, a.message_id, a.body, str(a.sent_at)) == ("a@b.vn", "<1@x>", "Kính gửi\nphòng kinh doanh", "2024-08-05 03:00:00")
        assert (a.attachments[0].filename, a.attachments[0].size_bytes) == ("đơn.pdf", 8)
        assert b.body == "Xin chào" and c.from_address is None

    def test_text_columns(self, spark):
        df = spark.createDataFrame([(" a \t b ", "x\r\n\n y  z", "Đường Sậy, 26\"", "<p>a&lt;b</p><br>c<style>d</style>", "YES"), (None,) * 5], "a string, b string, c string, d string, e string")
        one, two = df.select(clean(F.col("a")), clean_lines(F.col("b")), normalize(F.col("c")), strip_html(F.col("d")), parse_flag(F.col("e"), False)).collect()
        assert tuple(one) == ("a b", "x\ny z", "duong say 26", "a<b\nc", True)
        assert tuple(two) == ("", "", "", "", False)


    def test_extraction(self, spark):
        body = "Khách hàng: CTY  Nga Bách\nĐịa chỉ: 12 Loan Lộc, Hà Lam MST: 0101234567\nĐịa chỉ: Kho 12 Loan Lộc, Hà Lam"
        df = spark.createDataFrame([("Fwd: đơn", body, "bh24_00000012.pdf", 1234567.5), (None, None, None, None)], "subject string, body string, file string, m double")
        cols = [order_number([F.col("subject"), F.col("body"), F.col("file")]), tax_code(F.col("body")), labelled(F.col("body"), ["Khách hàng"], ["MST"]), labelled(F.col("body"), ["Địa chỉ", "Nơi nhận"], ["MST"]), money_text(F.col("m")), safe_filename(F.col("file"))]
        one, two = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()
        assert tuple(one) == ("BH24.00000012", "0101234567", "CTY Nga Bách", "12 Loan Lộc, Hà Lam", "1,234,568", "bh24_00000012.pdf")
        assert tuple(two) == (None, None, None, None, "", None)
        assert spark.range(2).agg(records("id").alias("j")).first().j == '[{"id":0},{"id":1}]'


class TestStore:
    def test_versions(self, spark, tmp_path):
        s = TableStore(spark, str(tmp_path / "s"))
        assert not s.exists("t") and s.snapshot() == {}
        with pytest.raises(KeyError):
            s.read("t")
        v1 = s.publish("t", spark.range(3))
        snap = s.snapshot()
        s.publish("t", spark.range(5))
        s.publish("t", spark.range(9), dry_run=True)

        def refuse(df):
            raise ValueError("no")

        with pytest.raises(ValueError):
            s.publish("t", spark.range(7), check=refuse)
        assert s.read("t").count() == 5 and len(s.versions("t")) == 2
        assert s.revert("t") == v1 and s.read("t").count() == 3
        s.restore(snap)
        assert s.current("t") == v1


class TestStreams:
    def test_files_are_applied_once(self, spark, tmp_path):
        src, store, said = tmp_path / "in", TableStore(spark, str(tmp_path / "s")), Progress(keep=5)
        bad = []
        said.listeners += [lambda e: 1 / 0, bad.append]
        spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string").write.parquet(str(src / "x1"))
        schema = spark.read.parquet(str(src / "x1")).schema
        for _ in range(2):
            watch(spark, str(src / "*"), schema, str(tmp_path / "cp"), upsert_into(store, "t", ["k"], ["o"], said), glob="*.parquet").awaitTermination()
        spark.createDataFrame([(2, 0, "old"), (3, 1, "d")], "k int, o int, v string").write.parquet(str(src / "x2"))
        watch(spark, str(src / "*"), schema, str(tmp_path / "cp"), upsert_into(store, "t", ["k"], ["o"], said), glob="*.parquet").awaitTermination()
        assert rows(store.read("t")) == [(1, 2, "b"), (2, 1, "c"), (3, 1, "d")]
        assert len(said.listeners) == 1 and len(bad) == len(said.history) == 2

    def test_windows_as_stream(self, spark, tmp_path):
        df = spark.createDataFrame([("2024-01-01 10:00:00", "a", 1.5), ("2024-01-01 12:00:00", "a", 2.0), ("2024-01-02 00:00:00", "b", 1.0)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.write.parquet(str(tmp_path / "e"))
        stream = windowed_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "e")))
        q = stream.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
        q.awaitTermination()
        assert rows(spark.table("w")) == rows(windowed_counts(df))




@pytest.mark.parametrize("name", ["sku_month_panel", "sku_yoy", "sku_lags", "forecast_monthly", "top20_sku", "actual_plus_forecast"])
def test_reports_read_the_lines_once(spark, monkeypatch, name):
    """What the query's own plan and the plans it writes on its way read of the lines, together."""
    from pedalmill.plans import features, forecast

    scans = []

    def counted(df, eager=True):
        scans.append(df._jdf.queryExecution().sparkPlan().toString().count("l_orderkey"))
        return cut(df, eager)

    cut = features.cut
    for module in (features, forecast):
        monkeypatch.setattr(module, "cut", counted)
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    reads = [p for p in [*scans] if p]
    assert len(reads) == 1 and "l_orderkey" not in plan


class TestTexts:
    def test_order_lines(self, spark):
        from pedalmill.plans.texts import order_lines_of

        text = "Trang 1\n1 000119999 Xe đạp Bộ 2 1.000 2.000\r\n 2  vm0582063.x Xe Chiếc 2,5 1.000 0\n3 000119999 Xe 26 4 1.000 4.500\n4 000119999 Xe 26 4\n5 000119999 Xe Cái 1.000.5 1 1\n6 000119999 Xe Cái 1 1 2"
        df = spark.createDataFrame([(1, text, "clash"), (2, None, "x"), (3, "", "y")], "i int, t string, stt string")
        got = {(r.i, r.stt): (r.line_no, r.product_code, r.unit, r.quantity, r.unit_price, r.line_total, r.parse_error, r.warning) for r in order_lines_of(df, ["i"], "t").collect()}
        assert got == {
            (1, "1"): (1, "000119999", "Bộ", 2, 1000, 2000, None, None), (1, "2"): (2, "VM0582063.X", "Chiếc", 2.5, 1000, 2500, None, "TOTAL_FILLED"), (1, "3"): (3, "000119999", None, 4, 1000, 4500, None, "TOTAL_OFF"),
            (1, "4"): (4, "000119999", None, None, None, None, "TOO_FEW_NUMBERS", None), (1, "5"): (5, "000119999", "Cái", None, None, None, "NOT_A_NUMBER", None), (1, "6"): (6, "000119999", "Cái", 1, 1, 2, None, None),
        }
        assert order_lines_of(df.limit(0), ["i"], "t").count() == 0

    def test_colors(self, spark):
        from pedalmill.plans.texts import standard_colors

        rows = [("Xe đạp MTB Xanh dương 26-21", None, "Xanh Dương"), ("Xe Xanh Pro Mint", "đỏ", "Xanh Mint"), ("Xe Batman", "ĐỎ ", "Đỏ"), ("Xe", None, None), (None, None, None), ("Xe Tím than", None, "Tím"), ("Xe xám", None, "Ghi")]
        df = spark.createDataFrame([(n, c, w, "clash") for n, c, w in rows], "product_name string, color string, want string, color_new string")
        assert all(r.color_new == r.want for r in standard_colors(df).collect())

    def test_moments_json_lists(self, spark):
        from pedalmill.functions.text import bare_province, distinct_parts, error_group, fenced_json, mapped_text, moment

        one = lambda c: spark.range(1).select(c.alias("x")).first().x
        assert [str(one(moment(F.lit(t)))) for t in ("2024-05-06 07:08:09", "06/05/2024", "x", None)] == ["2024-05-06 07:08:09", "2024-05-06 00:00:00", "None", "None"]
        assert [one(fenced_json(F.lit(t), "a int"))["a"] for t in ('{"a": 1}', '```json\n{"a": 2}\n```', "```\n{\"a\": 3}```", "x")] == [1, 2, 3, None]
        assert one(distinct_parts(F.lit("a, b,,a ,c"))) == ["a", "b", "c"] and one(distinct_parts(F.lit("a|b|a"), "|")) == ["a", "b"]
        assert [one(mapped_text(F.lit(t))) for t in ("NaN", " null ", "Hà Nội-1", None)] == ["", "", "ha noi 1", ""]
        assert [one(bare_province(F.lit(t))) for t in ("tinh ha tinh", "tp hue", "ha tinh", "thanh pho x")] == ["ha tinh", "hue", "ha tinh", "x"]
        assert [one(error_group(F.lit(t))) for t in ("dòng 3: Thiếu quantity | Thiếu unit_price", "  khác  lạ ", None)] == ["Thiếu quantity", "khác lạ", ""]
