"""Trees over counted cells against Spark's own over rows, and the cells against the panel."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from pedalmill.operators import trees
from pedalmill.plans import scoring
from pedalmill.plans.fact import fact_sales
from pedalmill.plans.features import by_sku, panel, sku_monthly, sku_sold
from pedalmill.session import cut

DATA = "/root/testdata/sf0.001"


def test_cut_points(spark):
    rng = np.random.default_rng(1)
    columns = [rng.geometric(0.02, 4000) * 1.0, np.where(rng.random(4000) < 0.7, 0.0, rng.normal(size=4000)), rng.integers(0, 9, 4000) * 1.0, np.zeros(4000)]
    got = trees.cut_points(spark.createDataFrame([(c, float(v), 1) for c, x in enumerate(columns) for v in x], "c int, v double, n bigint"))
    for c, x in enumerate(columns):
        v, n = np.unique(x, return_counts=True)
        want = list((v[1:] + v[:-1]) / 2)
        if len(v) > trees.BINS:
            want, target, now = [], len(x) / trees.BINS, n[0]
            for i in range(1, len(v)):
                before, now = now, now + n[i]
                if abs(before - target) < abs(now - target):
                    want.append((v[i - 1] + v[i]) / 2)
                    target += len(x) / trees.BINS
        assert list(got[c]) == want


def test_trees_as_spark(spark):
    rng = np.random.default_rng(2)
    n = 3000
    x, g = [rng.geometric(0.1, n) * 1.0, np.round(rng.normal(size=n), 2), rng.integers(1, 13, n) * 1.0], rng.integers(0, 4, n)
    y = np.round(3 * x[0] + 20 * (x[1] > 0.3) + 15 * (g == 2) + 5 * (g == 1) * x[2] + 20 * rng.normal(size=n))
    rows = [(*map(float, (*r, *(k == i for i in range(4)), label)),) for *r, k, label in zip(*x, g, y, strict=True)]
    names = ["x0", "x1", "x2", "g0", "g1", "g2", "g3"]
    vectors = cut(VectorAssembler(inputCols=names, outputCol="features").transform(spark.createDataFrame(rows, [*names, "label"])))
    cuts = trees.cut_points(spark.createDataFrame([(c, float(v), 1) for c in range(3) for v in x[c]], "c int, v double, n bigint"))
    codes = np.array([*[np.searchsorted(cuts[c], x[c]) for c in range(3)], g], np.int32)
    shape = trees.Shape((*(len(cuts[c]) + 1 for c in range(3)), 4), 3)

    def read(batch):
        i = batch.column(0).to_numpy()
        yield codes[:, i], y[i]

    cells = cut(spark.range(n, numPartitions=3).mapInArrow(lambda b: trees.pack(b, shape, read), trees.CELLS))
    assert cells.agg(F.sum("n")).first()[0] <= n
    one = trees.Job(trees.Tree(5), 5, 0)
    trees.grow(cells, shape, [one])
    boost = trees.boosted(cells, shape, 4, 3, 5, 0.1, 0)
    for model, mine in ((DecisionTreeRegressor(maxDepth=5, minInstancesPerNode=5), one.tree), (GBTRegressor(maxIter=4, maxDepth=3, minInstancesPerNode=5, stepSize=0.1), boost)):
        want = [r.prediction for r in model.fit(vectors).transform(vectors).select("prediction").collect()]
        labels = [r.label for r in vectors.select("label").collect()]
        assert labels == list(y)
        assert mine.predict(codes, shape) == pytest.approx(np.array(want), abs=1e-9)
    jobs = trees.forest(20, 5, 5, 7, 3)
    trees.grow(cells, shape, jobs)
    guess = trees.mean_of(jobs).predict(codes, shape)
    assert len({tuple(j.tree.column) for j in jobs}) > 10 and ((guess - y) ** 2).mean() < 0.6 * y.var()


def test_draws():
    rows = np.array([1, 1, 2, 50] * 5000)
    got = trees.drawn(rows, 3, 4)
    assert (got == trees.drawn(rows, 3, 4)).all() and (got != trees.drawn(rows, 3, 5)).any()
    for k in (1, 2, 50):
        assert got[rows == k].mean() == pytest.approx(k, rel=0.05) and got[rows == k].var() == pytest.approx(k, rel=0.1)


def laid_out(products, months, test):
    out = []
    for batch in products.toArrow().to_batches():
        for b, features, label in scoring.demand_rows(batch, months, test):
            wide = [np.repeat(np.array(b.column(c).to_pylist()), label.shape[1]) for c in ("group_name", "color")]
            out += list(zip(*wide, *[x.ravel() for x in features], label.ravel(), strict=True))
    return sorted((str(g), str(k), *map(float, x)) for g, k, *x in out)


def test_sold_without_counts(spark):
    f = fact_sales(spark, DATA)
    kept = ["product_code", "fiscal_year", "fiscal_month", "qty", "revenue", "group_name", "color"]
    rows = [df.select(*kept, F.expr("aggregate(prices, 0L, (a, x) -> a + x.n)").alias("n"), F.array_sort(F.array_distinct("prices.price")).alias("p")) for df in (sku_monthly(f), sku_sold(f))]
    assert rows[0].exceptAll(rows[1]).isEmpty() and rows[1].exceptAll(rows[0]).isEmpty() and rows[0].count() > 0


def test_demand_rows_are_the_panel(spark):
    w = by_sku()
    mean = lambda k: F.coalesce(F.avg("qty").over(w.rowsBetween(-k, -1)), F.lit(0.0))
    p = panel(spark, DATA).withColumns({"lag_1": F.coalesce(F.lag("qty").over(w), F.lit(0.0)), "mean_2": mean(2), "mean_3": mean(3), "label": F.lead("qty").over(w)}).where("label is not null")
    p = cut(p.na.fill("Unknown", ["group_name", "color"]))
    products, months = scoring.demand_frame(spark, DATA)
    for test in (False, True):
        held = p.where((F.col("fiscal_month") == scoring.TEST_MONTH) == F.lit(test)).select("group_name", "color", *scoring.DEMAND_FEATURES, "label").collect()
        want = sorted((r[0], r[1], *map(float, r[2:])) for r in held)
        assert laid_out(products, months, test) == want and want


def test_copies_make_no_new_cells(spark):
    """Rows that are alike are counted, not kept: more products of the same kind cost no more passes over them."""
    products, months = scoring.demand_frame(spark, DATA)
    alike = ["group_name", "color", "price"]
    thrice = cut(products.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("i").repartition(4, *alike).sortWithinPartitions(*alike))
    once, many = (scoring.demand_cells(p, months) for p in (cut(products.repartition(4, *alike).sortWithinPartitions(*alike)), thrice))
    assert once[2] == many[2]
    for a, b in zip(once[:2], many[:2], strict=True):
        rows = lambda c: sum(int(w.sum()) for *_, w in trees.unpacked(c.toArrow().to_batches(), 8))
        assert a.agg(F.sum("n")).first() == b.agg(F.sum("n")).first() and 3 * rows(a) == rows(b)


def test_zoo(spark):
    rows = {r.model: r for r in scoring.demand_model_zoo(spark, DATA).collect()}
    assert sorted(rows) == sorted(scoring.FULL)
    products, months = scoring.demand_frame(spark, DATA)
    actual = sum(r[-1] for r in laid_out(products, months, True))
    assert all(r.actual_total == pytest.approx(actual) and 0 < r.pred_total < 3 * actual for r in rows.values())
