"""Churn scores, customer segments and fitted models."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalmill.operators import bgnbd, trees
from pedalmill.operators.global_rank import global_quantiles
from pedalmill.plans.fact import fact_sales, orders
from pedalmill.plans.features import ORACLES as FEATURES_SQL
from pedalmill.plans.features import SCORED_SQL, bgnbd_summary, priced_products, rfm_features, scored_customers, sku_sold
from pedalmill.plans.forecast import TEST_MONTH, metrics
from pedalmill.session import cut

# Clusters and their names by falling value.
CLUSTERS, SEED = 4, 42
#: Starts of k-means and the most clusters that the elbow looks at.
STARTS, MOST_CLUSTERS = 10, 10
SEGMENTS = ("VIP", "Active", "At Risk", "Low Value")


def clip(c: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), c))


# Weights of the parts of the churn score, and where recency, frequency and RFM score count in full.
RECENCY_WEIGHT, FREQUENCY_WEIGHT, TREND_WEIGHT, RFM_WEIGHT = 0.55, 0.20, 0.20, 0.05
RECENCY_DAYS, FREQUENCY_ORDERS, RFM_FULL = 180, 6, 15


def churn_score() -> Column:
    """0 to 1 from recency, frequency, a falling trend and the RFM score."""
    falling = F.when(F.col("revenue_trend") < 0, clip(F.abs("revenue_trend")) * TREND_WEIGHT).otherwise(0.0)
    late = clip(F.col("days_since_last_order") / RECENCY_DAYS) * RECENCY_WEIGHT
    seldom = (1 - clip(F.col("order_frequency") / FREQUENCY_ORDERS)) * FREQUENCY_WEIGHT
    return clip(late + seldom + falling + (1 - clip(F.col("rfm_score") / RFM_FULL)) * RFM_WEIGHT)


def churn_heuristic(spark: SparkSession, d: str) -> DataFrame:
    return scored_customers(spark, d).select("customer_code", F.round(churn_score(), 6).alias("churn_probability"))


def churn_priority(spark: SparkSession, d: str) -> DataFrame:
    """Customers at high risk first by probability, revenue and score; the fifty first."""
    p = F.round(churn_score(), 6)
    score = F.round(p * F.log1p(F.greatest(F.col("total_revenue"), F.lit(0.0))) * clip(F.col("rfm_score").cast("double"), 1.0, 15.0), 4)
    s = scored_customers(spark, d).select("customer_code", p.alias("churn_probability"), score.alias("priority_score"))
    return s.where("churn_probability >= 0.6").orderBy(F.col("priority_score").desc(), "customer_code").limit(50)


def kmeans_frame(spark: SparkSession, d: str, k: int = CLUSTERS, starts: int = STARTS) -> tuple[DataFrame, float]:
    """(customers with their cluster, silhouette); fails where there are fewer customers than clusters."""
    z = [f"z_{c}" for c in ("recency_days", "log_frequency", "log_monetary")]
    frame = cut(VectorAssembler(inputCols=z, outputCol="features").transform(rfm_features(spark, d).na.fill(0.0, z)))
    if frame.limit(k).count() < k:
        raise ValueError(f"fewer customers than the {k} clusters asked for")
    model = min((KMeans(k=k, seed=SEED + i, featuresCol="features", predictionCol="cluster").fit(frame) for i in range(starts)), key=lambda m: m.summary.trainingCost)
    out = model.transform(frame)
    return out, ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(out)


def rfm_kmeans(spark: SparkSession, d: str) -> DataFrame:
    out, silhouette = kmeans_frame(spark, d)
    return out.select("customer_code", "cluster", F.lit(round(silhouette, 6)).alias("silhouette"))


def rfm_segment_names(spark: SparkSession, d: str) -> DataFrame:
    """Clusters named by the sum of their ranks: large and frequent and recent is VIP."""
    out, _ = kmeans_frame(spark, d)
    profile = out.groupBy("cluster").agg(F.count(F.lit(1)).alias("customers"), F.avg("recency_days").alias("r"), F.avg("log_frequency").alias("f"), F.avg("log_monetary").alias("m"))
    rank = lambda c: F.dense_rank().over(Window.orderBy(c))  # noqa: E731  one row per cluster
    scored = profile.withColumn("value_score", rank(F.col("m")) + rank(F.col("f")) + rank(F.col("r").desc()))
    place = F.row_number().over(Window.orderBy(F.col("value_score").desc(), "cluster"))
    return scored.withColumn("segment", F.element_at(F.array(*map(F.lit, SEGMENTS)), place)).select("cluster", "segment", "customers", "value_score")


def elbow(spark: SparkSession, d: str, most: int = MOST_CLUSTERS) -> DataFrame:
    """Cost by number of clusters, 2 to ``most``, and the knee: the point furthest from the line between the ends."""
    z = [f"z_{c}" for c in ("recency_days", "log_frequency", "log_monetary")]
    frame = cut(VectorAssembler(inputCols=z, outputCol="features").transform(rfm_features(spark, d).na.fill(0.0, z)))
    costs = [(k, float(KMeans(k=k, seed=SEED).fit(frame).summary.trainingCost)) for k in range(2, most + 1)]
    (x0, y0), (x1, y1) = costs[0], costs[-1]
    far = [abs((y1 - y0) * x - (x1 - x0) * y + x1 * y0 - y1 * x0) for x, y in costs]
    knee = costs[far.index(max(far))][0]
    return spark.createDataFrame([(k, c, k == knee) for k, c in costs], "k int, cost double, knee boolean")


def rfm_pca(spark: SparkSession, d: str) -> DataFrame:
    """Customers on the three principal axes of their scaled features."""
    z = [f"z_{c}" for c in ("recency_days", "log_frequency", "log_monetary")]
    frame = cut(VectorAssembler(inputCols=z, outputCol="features").transform(rfm_features(spark, d).na.fill(0.0, z)))
    axes = vector_to_array("pc")
    return PCA(k=3, inputCol="features", outputCol="pc").fit(frame).transform(frame).select("customer_code", *[axes[i].alias(f"pc{i + 1}") for i in range(3)])


def churn_model(spark: SparkSession, d: str, trees: int = 300) -> DataFrame:
    """Probability of no order in 30 days. The label is a function of one feature, as in the practice this
    follows, so the model tells how features go with recency and no more."""
    cols = ["days_since_last_order", "order_frequency", "total_revenue", "revenue_trend", "recent_90d_revenue", "rfm_score"]
    c = cut(VectorAssembler(inputCols=cols, outputCol="raw").transform(scored_customers(spark, d).withColumn("label", (F.col("days_since_last_order") > 30).cast("double"))))
    counts = {r.label: r["count"] for r in c.groupBy("label").count().collect()}
    if len(counts) < 2 or sum(counts.values()) < 50:
        return c.select("customer_code", churn_score().alias("churn_probability"), F.lit("heuristic").alias("method"))
    n = sum(counts.values())
    weighted = c.withColumn("w", F.when(F.col("label") == 1, n / (2.0 * counts[1.0])).otherwise(n / (2.0 * counts[0.0])))
    # a quarter of each class by the hash of its codes is held out
    train = weighted.where(F.pmod(F.xxhash64("customer_code"), F.lit(4)) != 0)
    small = n < 200
    last = LogisticRegression(featuresCol="features", weightCol="w", maxIter=100) if small else RandomForestClassifier(featuresCol="features", weightCol="w", numTrees=trees, minInstancesPerNode=5, seed=SEED)
    model = Pipeline(stages=[StandardScaler(inputCol="raw", outputCol="features", withMean=True), last]).fit(train)
    return model.transform(weighted).select("customer_code", vector_to_array("probability")[1].alias("churn_probability"), F.lit(type(last).__name__).alias("method"))


#: Sizes of the tree models: trees or rounds, depth, rows of a leaf, and the step of boosting. FULL is what the
#: forecasts were made with; SHORT, for a quick look, takes a fraction of the trees.
FULL = {"decision_tree": (1, 8, 5), "random_forest": (500, 10, 3), "forest_all_features": (500, 12, 3), "gradient_boosting": (300, 3, 5, 0.03)}
SHORT = {"decision_tree": (1, 8, 5), "random_forest": (20, 8, 3), "forest_all_features": (10, 8, 3), "gradient_boosting": (15, 3, 5, 0.1)}


def demand_model_zoo(spark: SparkSession, d: str) -> DataFrame:
    return demand_models(spark, d, SHORT)


#: Ordered features of the demand models, in order; group and colour follow, one feature per value.
DEMAND_FEATURES = ("qty", "lag_1", "mean_2", "mean_3", "avg_unit_price", "fiscal_month")
#: Product months that are laid out at once.
LAID_OUT = 1 << 19


def demand_rows(batch: pa.RecordBatch, months: np.ndarray, test: bool) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
    """(products, features as products x months, next month's quantity) of the panel's months that have a next one: the
    held-out ones or the others. ``months`` are the observed ones as 12 * year + month, going up."""
    step = max(1, LAID_OUT // len(months))
    for start in range(0, batch.num_rows, step):
        b = batch.slice(start, step)
        n = np.repeat(np.arange(b.num_rows), b.column("month").value_lengths().to_numpy(zero_copy_only=False))
        at = np.searchsorted(months, b.column("month").flatten().to_numpy())
        qty, revenue = np.zeros((b.num_rows, len(months))), np.zeros((b.num_rows, len(months)))
        qty[n, at], revenue[n, at] = b.column("qty").flatten().to_numpy(), b.column("revenue").flatten().to_numpy()
        before = [np.pad(qty, ((0, 0), (k, 0)))[:, : len(months)] for k in (1, 2, 3)]  # k months before; 0 where there is none
        known = np.arange(len(months))
        mean_2 = (before[1] + before[0]) / np.clip(known, 1, 2)
        mean_3 = (before[2] + before[1] + before[0]) / np.clip(known, 1, 3)
        price = np.where(qty > 0, revenue / np.where(qty > 0, qty, 1.0), b.column("price").to_numpy()[:, None])
        month = np.broadcast_to((months - 1) % 12 + 1.0, qty.shape)
        kept = np.flatnonzero(((months[:-1] - 1) % 12 + 1 == TEST_MONTH) == test)
        yield b, [x[:, kept] for x in (qty, before[0], mean_2, mean_3, price, month)], qty[:, kept + 1]


def demand_values(batches: Iterable[pa.RecordBatch], months: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(feature's place, value, rows) of the rows to learn from."""
    for batch in batches:
        for _, features, _ in demand_rows(batch, months, False):
            for c, x in enumerate(features):
                v, n = np.unique(x, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), c, np.int32)), pa.array(v), pa.array(n, pa.int64())], names=["c", "v", "n"])


def demand_codes(batch: pa.RecordBatch, months: np.ndarray, cuts: list[np.ndarray], labels: list[list[str]], test: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bins of the features, group and colour as columns x rows, next month's quantity)."""
    for b, features, label in demand_rows(batch, months, test):
        wide = [pc.index_in(b.column(k), pa.array(v, pa.string())).to_numpy(zero_copy_only=False) for k, v in zip(("group_name", "color"), labels, strict=True)]
        codes = [np.searchsorted(e, x.ravel()) for e, x in zip(cuts, features, strict=True)] + [np.repeat(x, label.shape[1]) for x in wide]
        yield np.array(codes, np.int32), label.ravel()


def demand_frame(spark: SparkSession, d: str) -> tuple[DataFrame, np.ndarray]:
    """(products with what they sold by month, as arrays, and their fallback price; observed months). A row holds a product's
    panel, so no months without sales are stored; products alike in group, colour and price come after one another."""
    sold = cut(sku_sold(fact_sales(spark, d))).withColumn("month", (F.col("fiscal_year") * 12 + F.col("fiscal_month")).cast("bigint"))
    months = np.array(sorted(r.month for r in sold.select("month").distinct().collect()))  # at most 12 per year of history
    products, every = priced_products(sold, F.collect_list(F.struct("month", "qty", "revenue")).alias("x"))
    alike = ["group_name", "color", "price"]
    label = {c: F.coalesce(c, F.lit("Unknown")) for c in alike[:2]}
    price = F.coalesce("own_price", "all_price", F.lit(0.0))
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    laid = products.crossJoin(F.broadcast(every)).withColumns(label | {"price": price}).select(*alike, *[F.col(f"x.{c}").alias(c) for c in ("month", "qty", "revenue")])  # every: one row
    return cut(laid.repartition(parts, *alike).sortWithinPartitions(*alike)), months


def demand_cells(products: DataFrame, months: np.ndarray) -> tuple[DataFrame, DataFrame, trees.Shape]:
    """(cells to learn from, held-out cells, shape of their codes). Groups and colours are in the order of StringIndexer."""
    values = products.mapInArrow(lambda batches: demand_values(batches, months), "c int, v double, n bigint")
    found = trees.cut_points(values)
    cuts = [found.get(c, np.array([])) for c in range(len(DEMAND_FEATURES))]
    labels = [[r[c] for r in products.groupBy(c).count().orderBy(F.col("count").desc(), c).collect()] for c in ("group_name", "color")]
    shape = trees.Shape((*(len(e) + 1 for e in cuts), *map(len, labels)), len(cuts))
    cells = lambda test: cut(products.mapInArrow(lambda batches: trees.pack(batches, shape, lambda b: demand_codes(b, months, cuts, labels, test)), trees.CELLS))
    return trees.gathered(cells(False)), trees.gathered(cells(True)), shape


def demand_models(spark: SparkSession, d: str, sizes: dict[str, tuple] = FULL) -> DataFrame:
    """Errors of tree models of next month's quantity on the held-out month. Randomised trees have no
    counterpart here; a forest that looks at all features stands beside them under its own name."""
    products, months = demand_frame(spark, d)
    if len(months) < 2:
        raise ValueError("demand models need two months with sales")
    train, test, shape = demand_cells(products, months)
    if train.isEmpty():
        raise ValueError("demand models need a month besides the held-out one")
    (_, deep, leaf), (number, deep_f, leaf_f), (number_a, deep_a, leaf_a), (rounds, deep_g, leaf_g, pace) = (sizes[m] for m in FULL)
    third = None if number == 1 else -(-shape.features // 3)
    grown = {
        "decision_tree": [trees.Job(trees.Tree(deep), leaf, SEED)],
        "random_forest": trees.forest(number, deep_f, leaf_f, SEED, third),
        "forest_all_features": trees.forest(number_a, deep_a, leaf_a, SEED + 1, None),
    }
    trees.grow(train, shape, [j for jobs in grown.values() for j in jobs])
    models = {n: trees.mean_of(jobs) for n, jobs in grown.items()}
    models["gradient_boosting"] = trees.boosted(train, shape, rounds, deep_g, leaf_g, pace, SEED)

    def predicted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, codes, label, rows in trees.unpacked(batches, len(shape.bins)):
            for name, model in models.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(label)), pa.array(label), pa.array(model.predict(codes, shape)), pa.array(rows)], names=["model", "actual", "pred", "n"])

    scored = test.mapInArrow(predicted, "model string, actual double, pred double, n bigint")
    # a row for each product and year again
    return metrics(scored.select("model", "actual", F.greatest("pred", F.lit(0.0)).alias("pred"), F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))))


#: The last day of the time by which a dealer must have ordered not to be new.
CALIBRATED_UNTIL = "2000-06-30"
# Groups of dealers and the least P(alive) and expected purchases of each, the first that holds counts.
NEW_DEALER, LOST_DEALER = "New Dealer", "Likely Churned"
DEALER_GROUPS = (("Likely to Buy", 0.7, 1.0), ("Monitor High", 0.5, 0.5), ("Monitor Low", 0.5, 0.0), ("At Risk", 0.3, 0.0))


def dealer_group(new: Column, alive: Column, expected: Column) -> Column:
    out = F.when(new, NEW_DEALER)
    for name, least, orders_ in DEALER_GROUPS:
        out = out.when((alive >= least) & (expected >= orders_), name)
    return out.otherwise(LOST_DEALER)


def new_dealers(spark: SparkSession, d: str, until: str = CALIBRATED_UNTIL) -> DataFrame:
    """Every customer with orders, their first one, and whether it came after ``until``."""
    first = orders(spark, d).groupBy(F.col("o_custkey").cast("string").alias("customer_code")).agg(F.min("order_date").alias("first_order_date"))
    return first.withColumn("is_new_dealer", F.col("first_order_date") > F.lit(until).cast("date"))


def new_dealer_flag(spark: SparkSession, d: str) -> DataFrame:
    return new_dealers(spark, d)


def bgnbd_forecast(spark: SparkSession, d: str) -> DataFrame:
    """P(alive), purchases expected in 30 and 7 weeks, group and priority; what a dealer has no history for is 0."""
    s = bgnbd_summary(spark, d)
    month, week = bgnbd.forecast(s, 30), bgnbd.forecast(s, 7)
    both = month.withColumnRenamed("expected", "expected_30").join(week.select("customer_code", F.col("expected").alias("expected_7")), "customer_code")
    three = {c: F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)) for c in ("p_alive", "expected_30", "expected_7")}
    both = both.withColumns(three).join(new_dealers(spark, d).select("customer_code", "is_new_dealer"), "customer_code")
    p, e = F.col("p_alive"), F.col("expected_30")
    group = dealer_group(F.col("is_new_dealer"), p, e)
    return both.select("customer_code", "is_new_dealer", F.round("p_alive", 6).alias("p_alive"), F.round("expected_30", 6).alias("expected_30"), F.round("expected_7", 6).alias("expected_7"), group.alias("segment"), F.bround(p * e, 4).alias("priority"))


def rfm_describe(spark: SparkSession, d: str) -> DataFrame:
    """Count, mean, deviation, least, quartiles and largest of the customer features, a row each."""
    f = cut(rfm_features(spark, d))  # ranged once per feature
    out = []
    for c in ("recency_days", "log_frequency", "log_monetary"):
        x = F.col(c).cast("double")
        plain = f.agg(F.count(x).alias("n"), F.round(F.avg(x), 4).alias("mean"), F.round(F.stddev_samp(x), 4).alias("std"), F.min(x).alias("least"), F.max(x).alias("largest"))
        q = global_quantiles(f, c, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
        out.append(plain.crossJoin(q).select(F.lit(c).alias("feature"), "n", "mean", "std", "least", *[F.round(k, 6).alias(k) for k in ("q25", "q50", "q75")], "largest"))  # one row each
    return reduce(DataFrame.unionByName, out)


QUERIES = {f.__name__: f for f in (churn_heuristic, churn_priority, rfm_kmeans, rfm_segment_names, elbow, rfm_pca, churn_model, demand_model_zoo, bgnbd_forecast, new_dealer_flag, rfm_describe)}

_SCORE = """round(least(1, greatest(0, least(1, greatest(0, days_since_last_order / 180)) * 0.55::double + (1 - least(1, greatest(0, order_frequency / 6))) * 0.20::double
    + case when revenue_trend < 0 then least(1, abs(revenue_trend)) * 0.20::double else 0 end + (1 - least(1, greatest(0, rfm_score / 15))) * 0.05::double)), 6)"""

ORACLES = {
    "new_dealer_flag": f"select o_custkey::varchar as customer_code, min(o_orderdate)::date as first_order_date, min(o_orderdate)::date > date '{CALIBRATED_UNTIL}' as is_new_dealer from orders group by 1",
    "rfm_describe": f"with f as ({FEATURES_SQL['rfm_features']}) " + " union all ".join(f"select '{c}' as feature, count({c}) as n, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, min({c})::double as least, " + ", ".join(f"round(quantile_cont({c}::double, {q}), 6) as q{int(q * 100)}" for q in (0.25, 0.5, 0.75)) + f", max({c})::double as largest from f" for c in ("recency_days", "log_frequency", "log_monetary")),
    "churn_heuristic": f"with {SCORED_SQL} select customer_code, {_SCORE} as churn_probability from scored",
    "churn_priority": f"with {SCORED_SQL}, p as (select *, {_SCORE} as churn_probability from scored) select customer_code, churn_probability, round(churn_probability * ln(1 + greatest(total_revenue, 0)) * least(15, greatest(1, rfm_score)), 4) as priority_score from p where churn_probability >= 0.6 order by priority_score desc, customer_code limit 50",
}
