import math
import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from metricspark.operators import (
    assemble_features,
    cluster_profile,
    distance_to_center,
    fit_kmeans,
    prepare_points,
    scale_features,
    silhouette,
    sweep_k,
)
from metricspark.operators import clustering
from metricspark.plans import cluster_report

from frame_rows import rows

# The published yearly carbon intensities in download order, each
# with the group, center and distance published for it.
PUBLISHED = [
    ("Austria", 100.1, 5, 98.7, 1.4),
    ("Belgium", 109.93, 5, 98.7, 11.23),
    ("France", 18.4, 1, 25.12, 6.72),
    ("Finland", 43.35, 1, 25.12, 18.23),
    ("Germany", 276.61, 3, 290.29, 13.68),
    ("Great Britain", 106.68, 5, 98.7, 7.98),
    ("Ireland", 322.48, 7, 332.72, 10.24),
    ("Italy", 210.41, 6, 209.07, 1.34),
    ("Norway", 8.78, 1, 25.12, 16.34),
    ("Poland", 643.02, 0, 617.91, 25.11),
    ("Czechia", 439.39, 4, 451.78, 12.39),
    ("Slovenia", 207.72, 6, 209.07, 1.35),
    ("Spain", 88.95, 5, 98.7, 9.75),
    ("Sweden", 4.09, 1, 25.12, 21.03),
    ("Switzerland", 18.63, 1, 25.12, 6.49),
    ("USA", 332.84, 7, 332.72, 0.12),
    ("United Arab Emirates", 285.44, 3, 290.29, 4.85),
    ("China", 480.48, 4, 451.78, 28.7),
    ("Mainland India", 605.69, 0, 617.91, 12.22),
    ("Japan", 382.18, 2, 369.84, 12.34),
    ("Brazil", 57.45, 1, 25.12, 32.33),
    ("Mexico", 296.31, 3, 290.29, 6.02),
    ("Canada", 87.85, 5, 98.7, 10.85),
    ("Australia", 435.48, 4, 451.78, 16.3),
    ("South Africa", 655.89, 0, 617.91, 37.98),
    ("South Korea", 360.97, 2, 369.84, 8.87),
    ("Indonesia", 567.04, 0, 617.91, 50.87),
    ("Singapore", 366.37, 2, 369.84, 3.47),
    ("Argentina", 302.79, 3, 290.29, 12.5),
    ("Egypt", 342.83, 7, 332.72, 10.11),
]


@pytest.fixture(scope="module")
def countries(spark):
    data = [(name, value) for name, value, *_ in PUBLISHED]
    return spark.createDataFrame(data, "country string, `carbon-intensity` double").coalesce(1).cache()


def _points(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, v double")


def test_published_clusters(countries):
    with prepare_points(countries, ["carbon-intensity"]) as points:
        assert (points.n_distinct, points.n_rows) == (30, 30)
        assert 1 / points.factors[0] == pytest.approx(199.1339487862263, rel=1e-12)
        sweep = sweep_k(points)
    assert sweep.best_k == 8
    scores = {r["k"]: r for r in sweep.scores.collect()}
    assert sorted(scores) == list(range(2, 31))
    assert scores[8]["silhouette"] == pytest.approx(0.8425, abs=5e-5)
    # A fit may end with fewer centers than asked for; the score counts the real ones.
    assert all(r["n_clusters"] <= k for k, r in scores.items())


def test_a_fit_may_end_with_fewer_centers_than_k(countries):
    with prepare_points(countries, ["carbon-intensity"]) as points:
        sweep = sweep_k(points, min_k=8, max_k=30)
    assert sweep.best_k == 8
    assert sweep.scores.where("k = 30").first()["n_clusters"] == 29


def test_center_of_a_constant_feature_is_its_value(spark):
    frame = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 10.0, 5.0), (4, 11.0, 5.0)], "id int, x double, y double")
    with prepare_points(frame, ["x", "y"], order="value") as points:
        model = sweep_k(points, max_k=2).model
    assert sorted(r["center_x"] for r in model.centers(spark).collect()) == pytest.approx([1.5, 10.5])
    assigned = model.assign(frame).collect()
    assert {r["center_y"] for r in assigned} == {5.0}
    assert {r["distance_from_center"] for r in assigned} == {0.5}


def test_published_report(countries):
    report = cluster_report(countries)
    assert report.columns == ["country", "carbon-intensity", "cluster_id", "cluster_center", "distance_from_center"]
    found = {r["country"]: r for r in report.collect()}
    assert len(found) == len(PUBLISHED)
    groups, published = {}, {}
    for name, _, group, center, distance in PUBLISHED:
        assert (found[name]["cluster_center"], found[name]["distance_from_center"]) == (center, distance)
        groups.setdefault(found[name]["cluster_id"], set()).add(name)
        published.setdefault(group, set()).add(name)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, published.values()))


def test_scaling_is_by_sample_deviation(spark):
    values = [1.0, 4.0, 4.0, 9.0]
    deviation = math.sqrt(sum((v - 4.5) ** 2 for v in values) / 3)
    frame = scale_features(assemble_features(_points(spark, values), ["v"]))
    assert rows(frame.select(vector_to_array("features")[0])) == [
        (pytest.approx(v / deviation),) for v in values
    ]
    with prepare_points(_points(spark, values), ["v"]) as points:
        assert points.n_rows == 4
        assert points.factors[0] == pytest.approx(1 / deviation)
        assert rows(points.frame, "_w") == [(1.0,), (1.0,), (2.0,)]


def test_null_features(spark):
    frame = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0), (4, float("nan"))], "id int, v double")
    with pytest.raises(ValueError, match="'v'"):
        with prepare_points(frame, ["v"]):
            pass
    with pytest.raises(Exception, match="VectorAssembler|null"):
        assemble_features(frame, ["v"]).collect()
    assert assemble_features(frame, ["v"], handle_invalid="skip").count() == 2
    with prepare_points(frame, ["v"], handle_invalid="skip") as points:
        assert points.n_rows == 2


def test_one_distinct_point_is_an_error(spark):
    with prepare_points(_points(spark, [3.0] * 5), ["v"]) as points:
        with pytest.raises(ValueError, match="2 distinct points, found 1"):
            sweep_k(points)


def test_points_are_released(spark):
    with prepare_points(_points(spark, [1, 2, 3]), ["v"]) as points:
        points.frame.count()
        assert points.frame.storageLevel.useMemory
    assert not points.frame.storageLevel.useMemory


def test_layout_does_not_matter_when_ordered_by_value(spark):
    rng = random.Random(3)
    values = [rng.choice([10, 20, 50]) + rng.randint(0, 9) for _ in range(300)]
    first = _points(spark, values)
    found = []
    for frame in (first.coalesce(1), first.repartition(5), first.orderBy(F.desc("v"))):
        with prepare_points(frame, ["v"], order="value", rows_per_partition=10) as points:
            found.append([tuple(map(float, c)) for c in fit_kmeans(points, 3).kmeans.clusterCenters()])
    for centers in found[1:]:
        assert sorted(c[0] for c in centers) == pytest.approx(sorted(c[0] for c in found[0]))


def test_silhouette_against_all_pairs(spark):
    rng = random.Random(11)
    data = [(i, rng.gauss(3 * (i % 3), 1), rng.random(), "abc"[i % 3]) for i in range(60)]
    data += [(60, 50.0, 0.5, "alone"), (61, 0.0, 0.0, None)]

    def square(p, q):
        return (p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2

    scores = []
    labelled = [p for p in data if p[3] is not None]
    for p in labelled:
        means = {}
        for c in {q[3] for q in labelled}:
            others = [square(p, q) for q in labelled if q[3] == c and q[0] != p[0]]
            means[c] = sum(others) / len(others) if others else None
        own = means.pop(p[3])
        near = min(m for m in means.values() if m is not None)
        scores.append(0.0 if own is None else (near - own) / max(near, own))
    frame = spark.createDataFrame(data, "id int, x double, y double, c string")
    found = silhouette(frame, ["x", "y"], "c").first()
    assert found["n_clusters"] == 4
    assert found["silhouette"] == pytest.approx(sum(scores) / len(scores), rel=1e-9)


def test_silhouette_of_repeated_points_is_that_of_the_rows(spark):
    rng = random.Random(4)
    values = [rng.choice([1, 1, 1, 2, 8, 9, 30]) for _ in range(80)]
    frame = _points(spark, values)
    with prepare_points(frame, ["v"], order="value") as points:
        model = fit_kmeans(points, 3)
        weighted = silhouette(model.kmeans.transform(points.frame), points.columns, "prediction", weight="_w").first()
    assigned = model.predict(frame)
    vectors = VectorAssembler(inputCols=["v"], outputCol="features").transform(assigned)
    expected = ClusteringEvaluator(predictionCol="cluster_id").evaluate(vectors)
    assert weighted["silhouette"] == pytest.approx(expected, rel=1e-9)


def test_silhouettes_of_several_clusterings_at_once(spark):
    frame = _points(spark, [0, 1, 2, 10, 11, 12]).selectExpr("v", "cast(v > 5 as int) as a", "cast(v % 2 as int) as b")
    long = frame.unpivot(["v"], ["a", "b"], "by", "c")
    both = {r["by"]: r["silhouette"] for r in silhouette(long, ["v"], "c", labelling="by").collect()}
    for name in "ab":
        assert both[name] == pytest.approx(silhouette(frame, ["v"], name).first()["silhouette"])
    assert -1 <= both["b"] < both["a"] <= 1
    alone = silhouette(frame.withColumn("c", F.lit(1)), ["v"], "c").first()
    assert (alone["n_clusters"], alone["silhouette"]) == (1, None)


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_silhouette_is_the_same_in_chunks_of_clusters(spark, chunk):
    rng = random.Random(chunk)
    frame = spark.createDataFrame([(rng.random() * 9, rng.random()) for _ in range(80)], "v double, u double")
    frame = frame.withColumn("c", F.floor("v").cast("int"))
    whole, cut = (silhouette(frame, ["v", "u"], "c", **kw).first() for kw in ({}, {"chunk": chunk}))
    assert cut["n_clusters"] == whole["n_clusters"] == 9
    assert cut["silhouette"] == pytest.approx(whole["silhouette"])


def test_scores_are_the_same_in_batches(spark, monkeypatch):
    frame = _points(spark, [1, 2, 3, 10, 11, 12, 30, 31])
    with prepare_points(frame, ["v"], order="value") as points:
        whole = rows(sweep_k(points, parallelism=1).scores)
        real = clustering._batches
        monkeypatch.setattr(clustering, "_batches", lambda ks: real(ks, clusters=5))
        assert list(real([2, 3, 4], clusters=5)) == [[2, 3], [4]]
        split = rows(sweep_k(points).scores)
    for a, b in zip(whole, split, strict=True):
        assert a == pytest.approx(b)


def test_rows_lie_with_their_nearest_center_and_centers_are_means(spark):
    rng = random.Random(8)
    data = [(i, rng.choice([0.0, 100.0, 300.0]) + rng.random(), rng.choice([1.0, 9.0]) + rng.random()) for i in range(200)]
    frame = spark.createDataFrame(data, "id int, x double, y double").repartition(4)
    with prepare_points(frame, ["x", "y"], order="value") as points:
        sweep = sweep_k(points, max_k=8)
    model = sweep.model
    centers = {r["cluster_id"]: (r["center_x"], r["center_y"]) for r in model.centers(spark).collect()}
    fx, fy = model.factors
    assigned = model.assign(frame).collect()
    assert len(assigned) == 200

    def scaled(r, c):
        return ((r["x"] - c[0]) * fx) ** 2 + ((r["y"] - c[1]) * fy) ** 2

    for r in assigned:
        own = centers[r["cluster_id"]]
        assert scaled(r, own) <= min(scaled(r, c) for c in centers.values()) + 1e-9
        assert (r["center_x"], r["center_y"]) == pytest.approx(own, abs=0.0051)
        gap = math.hypot(r["x"] - r["center_x"], r["y"] - r["center_y"])
        assert r["distance_from_center"] == pytest.approx(gap, abs=0.0051)
    for feature, i in (("x", 0), ("y", 1)):
        for p in cluster_profile(model.predict(frame), feature).collect():
            assert p["mean"] == pytest.approx(centers[p["cluster_id"]][i], abs=1e-5)
            assert p["min"] <= p["mean"] <= p["max"]


def test_weights_give_the_fit_of_the_repeated_rows(spark):
    values = [1.0] * 40 + [2.0] * 10 + [50.0] * 30 + [60.0] * 20
    frame = _points(spark, values)
    with prepare_points(frame, ["v"], order="value") as points:
        model = fit_kmeans(points, 2)
    plain = KMeans(k=2, seed=30).fit(assemble_features(frame, ["v"], output="features"))
    expected = sorted(float(c[0]) for c in plain.clusterCenters())
    assert sorted(r["center_v"] for r in model.centers(spark).collect()) == pytest.approx(expected)


def test_row_without_center_gets_zero(spark):
    assigned = spark.createDataFrame([(1, 5.0), (2, -7.5)], "cluster_id int, v double")
    centers = spark.createDataFrame([(1, 4.004)], "cluster_id int, center_v double")
    for known in (None, 1):
        found = distance_to_center(assigned, centers, ["v"], n_centers=known)
        assert rows(found) == [(1, 5.0, 4.0, 1.0), (2, -7.5, 0.0, 7.5)]


def test_silhouette_with_fifty_thousand_clusters(spark):
    """Clusters far more than a chunk holds, against the nearest of each row's 41 neighbours in order."""
    k, each = 50_000, 3
    frame = spark.range(k * each).select(
        (F.col("id") % k).alias("c"), ((F.col("id") % k) + F.pmod(F.xxhash64("id"), F.lit(1000)) / 2500.0).alias("v")
    )
    found = silhouette(frame, ["v"], "c").first()
    values = np.array([r["v"] for r in frame.orderBy("c", "v").collect()]).reshape(k, each)
    mean, square = values.mean(axis=1), (values**2).mean(axis=1)
    best = np.full((k, each), np.inf)
    for step in [*range(-20, 0), *range(1, 21)]:
        other = np.arange(k) + step
        known = (other >= 0) & (other < k)
        x, m, q = values[known], mean[other[known], None], square[other[known], None]
        best[known] = np.minimum(best[known], x * x - 2 * x * m + q)
    own = (values**2 - 2 * values * mean[:, None] + square[:, None]) * each / (each - 1)
    assert found["n_clusters"] == k
    assert found["silhouette"] == pytest.approx(((best - own) / np.maximum(best, own)).mean(), rel=1e-4)


def test_sweep_against_single_fits_and_the_library_s_evaluator(spark):
    """Every k's score and cost, and so the choice of k, are those of single fits."""
    rng = random.Random(21)
    frame = spark.createDataFrame(
        [(rng.gauss(10 * (i % 4), 1.0), rng.gauss(7 * (i % 3), 1.0)) for i in range(400)] * 2, "v double, u double"
    )
    with prepare_points(frame, ["v", "u"], order="value") as points:
        sweep = sweep_k(points, max_k=14)
        single = {k: fit_kmeans(points, k) for k in range(2, 15)}
        expected = {}
        for k, model in single.items():
            assigned = model.kmeans.transform(points.frame.union(points.frame))  # every point occurs twice
            expected[k] = ClusteringEvaluator().evaluate(assigned), model.kmeans.summary.trainingCost
    got = {r["k"]: r for r in sweep.scores.collect()}
    assert set(got) == set(expected)
    for k, (score, cost) in expected.items():
        assert got[k]["silhouette"] == pytest.approx(score, rel=1e-6)
        # the library's cost is that before its last step
        assert got[k]["wssse"] <= cost * (1 + 1e-9) and got[k]["wssse"] == pytest.approx(cost, rel=0.02)
    assert sweep.best_k == max(expected, key=lambda k: expected[k][0])
    assert sweep.model.n_clusters == single[sweep.best_k].n_clusters


def test_settled_centers_are_the_library_s(spark):
    rng = random.Random(5)
    with prepare_points(_points(spark, [rng.gauss(20 * (i % 5), 2) for i in range(300)]), ["v"], order="value") as points:
        starts = {
            k: np.array(KMeans(featuresCol="features", weightCol="_w", k=k, seed=30, solver="row", maxIter=0).fit(points.frame).clusterCenters())
            for k in (2, 5, 9)
        }
        settled = clustering.settle_centers(points.frame.select("_x0", "_w"), ["_x0"], starts)
        for k, centers in settled.items():
            assert centers[:, 0] == pytest.approx([c[0] for c in fit_kmeans(points, k).kmeans.clusterCenters()], rel=1e-9)
