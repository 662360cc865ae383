import hashlib
import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from rxlake.models import adherence, isolation, metrics
from rxlake.operators import prices


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(7)
    n = 400
    x = rng.normal(size=(n, 3)) * [1.0, 10.0, 0.1]
    z = 1.5 * x[:, 0] - 0.1 * x[:, 1] + rng.normal(size=n)
    rows = [(f"p{i}", *map(float, x[i]), int(z[i] > 0.8)) for i in range(n)]
    return spark.createDataFrame(
        rows, "beneficiary_id string, a double, b double, c double, low_adherence int"
    )


FEATURES = ["a", "b", "c"]


def test_split_is_exact_and_repeatable(training, partitions):
    def split(n):
        rows = adherence.with_part(training.repartition(n)).collect()
        return {r["beneficiary_id"]: (r["low_adherence"], r["_part"]) for r in rows}

    results = partitions(split)
    assert results[0] == results[1] == results[2]
    for label in (0, 1):
        mine = [part for y, part in results[0].values() if y == label]
        assert mine.count("train") == math.floor(0.75 * len(mine) + 0.5)
    train, test = adherence.stratified_split(training)
    assert train.count() + test.count() == 400
    assert train.join(test, "beneficiary_id").count() == 0
    other = {r["beneficiary_id"]: r["_part"] for r in
             adherence.with_part(training, seed=1).collect()}
    assert other != {k: p for k, (_, p) in results[0].items()}


def test_split_of_one_row_per_class(spark):
    df = spark.createDataFrame([("x", 0), ("y", 1)], "beneficiary_id string, low_adherence int")
    assert {r["_part"] for r in adherence.with_part(df).collect()} == {"train"}


def newton(x, y, weight, ridge, steps=60):
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (weight * (p - y)) + penalty @ w
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + penalty
        w = w - np.linalg.solve(hessian, gradient)
    return w


def test_logistic_regression_against_newton(training):
    model = adherence.fit_adherence_lr(training, FEATURES)
    data = training.toPandas()
    x = data[FEATURES].to_numpy()
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    y = data["low_adherence"].to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    expected = newton(x, y, weight, ridge=1.0)
    got = model.stages[-1]
    assert got.coefficients.toArray() == pytest.approx(expected[:3], abs=1e-3)
    assert got.intercept == pytest.approx(expected[3], abs=1e-3)
    table = adherence.lr_coefficients(model, FEATURES).collect()
    sizes = [r["abs_coef"] for r in table]
    assert sizes == sorted(sizes, reverse=True)


def test_scores_and_tiers(training):
    model = adherence.fit_adherence_lr(training, FEATURES)
    scored = adherence.risk_tiers(adherence.score_adherence(model, training), 0.8, 0.5)
    rows = scored.collect()
    assert len(rows) == 400
    for r in rows:
        assert r["prediction"] == int(r["probability"] > 0.5)
        p = r["probability"]
        assert r["risk_tier"] == ("high" if p >= 0.8 else "medium" if p >= 0.5 else "low")
    assert metrics.roc_auc(scored) > 0.8


def test_boosted_trees(training):
    model = adherence.fit_adherence_gbt(training, FEATURES, trees=5)
    assert metrics.roc_auc(adherence.score_adherence(model, training)) > 0.8
    table = adherence.feature_importance(model, FEATURES).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)
    assert table[0]["feature"] == "a"


def test_metrics_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(2), rng.randrange(2), rng.choice([0.1, 0.4, 0.4, 0.9]))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "low_adherence int, prediction int, probability double")
    got = {r["class"]: r for r in metrics.classification_metrics(df).collect()}
    for c in (0, 1):
        tp = sum(y == p == c for y, p, _ in rows)
        precision = tp / sum(p == c for _, p, _ in rows)
        recall = tp / sum(y == c for y, _, _ in rows)
        assert got[c]["precision"] == pytest.approx(precision)
        assert got[c]["recall"] == pytest.approx(recall)
        assert got[c]["f1"] == pytest.approx(2 * precision * recall / (precision + recall))
    ones = [s for y, _, s in rows if y]
    zeros = [s for y, _, s in rows if not y]
    wins = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
    assert metrics.roc_auc(df) == pytest.approx(wins / len(ones) / len(zeros))


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "low_adherence int, prediction int")
    got = {r["class"]: r for r in metrics.classification_metrics(df).collect()}
    assert got[1]["precision"] == got[1]["f1"] == 0.0 and got[1]["support"] == 1


def test_auc_of_a_single_class(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.6)], "low_adherence int, probability double")
    assert metrics.roc_auc(df) is None
    assert metrics.roc_auc_frame(df).first()["roc_auc"] is None


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, 2))
    x[:6] = [[9, 9], [-8, 9], [10, -9], [-9, -9], [12, 0], [0, -12]]
    rows = [(f"d{i:03d}", float(a), float(b)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows + [("gap", None, 1.0)], "ndc string, a double, b double")


def test_isolation_forest(points, partitions):
    def run(n):
        rows = isolation.isolation_forest(points.repartition(n), ["a", "b"], trees=40).collect()
        return {r["ndc"]: (round(r["anomaly_raw_score"], 9), r["is_anomaly"], r["anomaly_score"])
                for r in rows}

    results = partitions(run, widths=(1, 4))
    assert results[0] == results[1]
    got = results[0]
    assert len(got) == 600 and "gap" not in got
    assert sum(flag for _, flag, _ in got.values()) == 30
    assert all(got[f"d{i:03d}"][1] == 1 for i in range(6))
    assert all((s < 0) == bool(f) == (label == -1) for s, f, label in got.values())


def plain_forest(rows, trees, sample_size, seed):
    """Mean path of every (key, values) row in a forest grown node by node."""

    def digest(*parts):
        return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()

    def expected(m):
        return 0.0 if m <= 1 else 1.0 if m == 2 else 2 * (math.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m

    prime, limit = 2**31 - 1, math.ceil(math.log2(max(min(sample_size, len(rows)), 2)))
    paths = {key: 0.0 for key, _ in rows}
    for tree in range(trees):
        d = digest(seed, tree)
        slope, offset = 1 + int(d[:8], 16) % (prime - 1), int(d[8:16], 16) % prime

        def place(row):
            return ((slope * (int(digest(seed, row[0])[:12], 16) % prime) + offset) % prime, row[0])

        def descend(sample, everyone, node, depth):
            varied = [i for i in range(len(rows[0][1])) if len({v[i] for _, v in sample}) > 1]
            if depth == limit or not varied:
                for key, _ in everyone:
                    paths[key] += depth + expected(len(sample))
                return
            d = digest(seed, tree, node)
            feature = varied[int(d[6:12], 16) % len(varied)]
            low, high = min(v[feature] for _, v in sample), max(v[feature] for _, v in sample)
            split = low + (int(d[:6], 16) + 0.5) / 2**24 * (high - low)
            for side in (0, 1):
                parts = [[r for r in x if (r[1][feature] > split) == side] for x in (sample, everyone)]
                descend(*parts, 2 * node + side, depth + 1)

        descend(sorted(rows, key=place)[:sample_size], rows, 1, 0)
    return {key: total / trees for key, total in paths.items()}


def test_forest_scores_against_a_plain_forest(points):
    values = "_values"
    ready = isolation.with_values(points.na.drop(), ["a", "b"], values)
    rows = [(r["ndc"], tuple(r[values])) for r in ready.collect()]
    samples = isolation.tree_samples(ready, 600, 10, 64, 5, "ndc", values)
    sizes = {r["tree"]: r["count"] for r in samples.groupBy("tree").count().collect()}
    assert sizes == {t: 64 for t in range(10)}
    nodes = isolation.grow_trees(samples, 64, 5, values, 2).cache()
    per_tree = nodes.groupBy("tree").count().collect()
    assert len(per_tree) == 10 and max(r["count"] for r in per_tree) <= 127
    assert {r["n"] for r in nodes.filter("feature < 0").groupBy("tree").agg(F.sum("size").alias("n")).collect()} == {64}

    want = plain_forest(rows, 10, 64, 5)
    norm = 2 * (math.log(63) + np.euler_gamma) - 2 * 63 / 64
    scored = isolation.score_rows(ready, nodes, 10, 64, values, "ndc").collect()
    assert len(scored) == 600
    for r in scored:
        assert r["_path"] / 1e9 / 10 == pytest.approx(want[r["ndc"]])
        assert r["_score"] == pytest.approx(-(2 ** (-want[r["ndc"]] / norm)))


def test_forest_of_equal_rows_and_of_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0)] * 3 + [("b", 1.0, 2.0)], "ndc string, x double, y double")
    rows = isolation.isolation_forest(df, ["x", "y"], trees=5).collect()
    assert len(rows) == 4 and {(r["anomaly_raw_score"], r["is_anomaly"]) for r in rows} == {(0.0, 0)}
    one = isolation.isolation_forest(df.limit(1), ["x", "y"], trees=5).collect()
    assert [r["is_anomaly"] for r in one] == [0]
    with pytest.raises(ValueError, match="no complete rows"):
        isolation.isolation_forest(df.limit(0), ["x", "y"])


def test_forest_needs_no_python_on_executors(points):
    values = "_values"
    ready = isolation.with_values(points.na.drop(), ["a", "b"], values)
    samples = isolation.tree_samples(ready, 600, 5, 64, 5, "ndc", values)
    nodes = isolation.grow_trees(samples, 64, 5, values, 2)
    grown = nodes._jdf.queryExecution().toString()
    walked = isolation.score_rows(ready, nodes, 5, 64, values, "ndc")._jdf.queryExecution().toString()
    for plan in (grown, walked):
        assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_small_forest(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.1), ("c", 50.0)], "ndc string, x double")
    rows = isolation.isolation_forest(df, ["x"], trees=20, contamination=0.3).collect()
    assert {r["ndc"] for r in rows if r["is_anomaly"]} == {"c"}


def test_anomaly_reports(spark):
    names = [*prices.ANOMALY_FEATURES, "latest_price"]
    rows = [("a", *[1.0] * 6, -0.2, 1), ("b", *[2.0] * 6, -0.1, 1), ("c", *[3.0] * 6, 0.1, 0)]
    df = spark.createDataFrame(
        rows,
        "ndc string, " + ", ".join(f"{n} double" for n in names)
        + ", anomaly_raw_score double, is_anomaly int",
    )
    dim = spark.createDataFrame(
        [("a", "g" * 50, None, None)],
        "ndc string, generic_name string, brand_name string, labeler_name string",
    )
    top = isolation.top_anomalies(df, dim, 1).collect()
    assert [(r["ndc"], r["drug_name"]) for r in top] == [("a", "g" * 33)]
    assert tuple(isolation.anomaly_share(df).first()) == (2, 66.7)
    profile = {r["is_anomaly"]: r for r in isolation.anomaly_profile(df).collect()}
    assert profile[1]["avg_mean_price"] == 1.5 and profile[0]["count"] == 1


def test_training_set(spark):
    use = spark.createDataFrame(
        [("p", *range(11), 5.0, 6.0), ("q", *range(11), 5.0, None), ("r", *range(11), 5.0, 6.0)],
        "beneficiary_id string, "
        + ", ".join(f"{c} int" for c in adherence.FEATURES if not c.startswith("refill_"))
        .replace("total_medical_spend int", "total_medical_spend double")
        .replace("rx_share_of_total_spend int", "rx_share_of_total_spend double"),
    )
    stats = spark.createDataFrame(
        [("p", 30.0, 0.6), ("q", 30.0, 0.1), ("z", 30.0, 0.1)],
        "beneficiary_id string, avg_days_supply double, historical_refill_rate double",
    )
    rows = adherence.adherence_training_set(use, stats).collect()
    assert [(r["beneficiary_id"], r["low_adherence"]) for r in rows] == [("p", 0)]
    assert rows[0]["refill_avg_days_supply"] == 30.0
    rate = adherence.target_rate(adherence.adherence_training_set(use, stats, 0.61)).first()
    assert tuple(rate) == (1, 1.0)
