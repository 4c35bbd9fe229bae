"""Fitted models and forecasts by what must hold whatever the fit."""

import pytest
from pyspark.sql import functions as F

from pedalmill.operators import bgnbd
from pedalmill.plans import bi, forecast, scoring
from pedalmill.plans.features import weekly_summary

DATA = "/root/testdata/sf0.001"


def test_segments(spark):
    rows = scoring.rfm_segment_names(spark, DATA).collect()
    assert sorted(r.segment for r in rows) == sorted(scoring.SEGMENTS)
    by = {r.segment: r.value_score for r in rows}
    assert by["VIP"] == max(by.values()) and by["Low Value"] == min(by.values())
    assert sum(r.customers for r in rows) == spark.read.parquet(f"{DATA}/customer.parquet").count()


def test_churn_model(spark):
    df = scoring.churn_model(spark, DATA)
    lo, hi, n = df.agg(F.min("churn_probability"), F.max("churn_probability"), F.count("*")).first()
    assert 0 <= lo <= hi <= 1 and n > 0 and df.select("method").distinct().count() == 1


def test_bgnbd(spark):
    df = scoring.bgnbd_forecast(spark, DATA)
    assert df.where("p_alive < 0 or p_alive > 1 or expected_30 < 0 or expected_7 > expected_30 + 1e-6").count() == 0
    s = spark.createDataFrame([("a", 0, 0, 30), ("b", 5, 29, 30), ("c", 5, 10, 30)] * 9, "customer_code string, frequency int, recency int, age int")
    got = {r.customer_code: r for r in bgnbd.forecast(s, 10).collect()}
    assert got["a"].p_alive == 1 and got["b"].p_alive > got["c"].p_alive and got["b"].expected > got["c"].expected
    assert bgnbd.forecast(s.limit(0), 10).count() == 0


def test_weeks(spark):
    o = spark.createDataFrame([("a", "1", "2024-01-01"), ("a", "2", "2024-01-07"), ("a", "3", "2024-01-08"), ("a", "4", "2024-03-01"), ("b", "5", "2024-02-01")], "customer_code string, so_number string, d string").withColumn("order_date", F.col("d").cast("date"))
    rows = {r.customer_code: (r.frequency, r.recency, r.age, r.n_orders) for r in weekly_summary(o, "2024-01-31").collect()}
    assert rows == {"a": (1, 1, 4, 3)}


def test_scenarios(spark):
    s = forecast.scenarios(spark, DATA)
    r = s.where("forecast_qty_base > 0").agg(F.max(F.abs(F.col("forecast_qty_conservative") + F.col("forecast_qty_optimistic") - 2 * F.col("forecast_qty_base")))).first()[0]
    assert r < 1e-6
    c = forecast.group_calibration(spark, DATA).where("factor < 0.9 or factor > 1.1").count()
    assert c == 0
    share = forecast.forecast_group(spark, DATA).agg(F.sum("revenue_share")).first()[0]
    assert share == pytest.approx(1, abs=1e-3)
    assert bi.bi_product_analysis(spark, DATA).agg(F.sum("revenue_share")).first()[0] == pytest.approx(1, abs=1e-4)


def test_metrics_by_hand(spark):
    rows = spark.createDataFrame([("m", 10.0, 8.0), ("m", 0.0, 2.0), ("m", 5.0, 5.0), ("z", 0.0, 0.0)], "model string, actual double, pred double")
    got = {r.model: r for r in forecast.metrics(rows).collect()}
    m = got["m"]
    assert (m.mae, m.rmse, m.mape, m.wmape, m.bias_pct) == (pytest.approx(1.3333, abs=1e-4), pytest.approx(1.633, abs=1e-4), 10.0, pytest.approx(26.6667, abs=1e-4), 0.0)
    assert m.smape == pytest.approx((20 / 9 * 10 + 200) / 3, abs=1e-3) and m.r2 == pytest.approx(1 - 8 / 50, abs=1e-6)
    assert (got["z"].wmape, got["z"].smape, got["z"].r2) == (0, 0, 0)
