"""Layout-free KMeans: same model on any layout, exact statistics, quality against the library."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplens.operators import kmeans, ml
from shoplens.plans import catalog

COLUMNS = ml.RFM_COLUMNS


def blobs(spark, n=900):
    rng = np.random.default_rng(7)
    centres = np.array([[10, 2, 50.0], [400, 1, 20.0], [30, 40, 900.0], [200, 10, 5000.0]])
    rows = []
    for i in range(n):
        c = centres[i % 4] * (1 + 0.05 * rng.standard_normal(3))
        rows.append((f"c{i:05d}", int(c[0]), max(1, int(c[1])), round(float(c[2]), 2)))
    return spark.createDataFrame(rows, "customer_id string, recency int, frequency long, monetary double")


def centres_of(model):
    return np.array(model.stages[-1].clusterCenters())


def test_same_clusters_on_1_16_and_200_partitions(spark):
    rfm = catalog.rfm_filled(spark, SF_SMALL).checkpoint()
    found = []
    for layout in (rfm.coalesce(1), rfm.repartition(16), rfm.repartition(200), rfm.orderBy(F.desc("monetary"))):
        model, segments = ml.customer_segments(layout, k=5)
        found.append((centres_of(model).tolist(), model.stages[1].std.toArray().tolist(), sorted(tuple(r) for r in segments.collect())))
    assert found[0] == found[1] == found[2] == found[3]
    assert len(found[0][0]) == 5 and len({c for _, c in found[0][2]}) == 5


def test_deviations_equal_numpy(spark):
    rows = blobs(spark)
    x = np.array([[r[c] for c in COLUMNS] for r in rows.collect()], float)
    means, scale, n = kmeans.deviations(rows, COLUMNS)
    assert n == len(x) and np.allclose(means, x.mean(axis=0)) and np.allclose(scale, x.std(axis=0, ddof=1))


def test_finds_the_groups_and_no_worse_than_the_library(spark):
    rows = blobs(spark).checkpoint()
    model, segments = ml.customer_segments(rows, k=4)
    of = {r["customer_id"]: r["cluster"] for r in segments.collect()}
    assert all(len({of[f"c{i:05d}"] for i in range(g, 900, 4)}) == 1 for g in range(4)) and len(set(of.values())) == 4
    library = Pipeline(stages=[VectorAssembler(inputCols=COLUMNS, outputCol="features"), StandardScaler(inputCol="features", outputCol="scaled_features"),
                               KMeans(k=4, featuresCol="scaled_features", predictionCol="cluster", seed=42)]).fit(rows)
    x = np.array([r["scaled_features"].toArray() for r in library.transform(rows).collect()])
    cost = lambda m: min((((x[:, None, :] - centres_of(m)[None]) ** 2).sum(-1).min(1)).sum(), np.inf)
    assert cost(model) <= 1.05 * cost(library)
    assert np.allclose(model.stages[1].std.toArray(), library.stages[1].std.toArray())


def test_centres_are_the_means_of_their_rows(spark):
    rows = blobs(spark).checkpoint()
    model, _ = ml.customer_segments(rows, k=3)
    got = model.transform(rows).select("cluster", "scaled_features").collect()
    for i, c in enumerate(centres_of(model)):
        own = np.array([r["scaled_features"].toArray() for r in got if r["cluster"] == i])
        assert np.allclose(own.mean(axis=0), c, atol=2e-3)


def test_few_and_constant_rows(spark):
    same = spark.createDataFrame([(f"c{i}", 3, 1, 2.5) for i in range(10)], "customer_id string, recency int, frequency long, monetary double")
    _, segments = ml.customer_segments(same, k=5)
    assert {r["cluster"] for r in segments.collect()} == {0}
    two = same.unionByName(spark.createDataFrame([("x", 90, 8, 100.0)], same.schema))
    assert ml.customer_segments(two, k=5)[1].select("cluster").distinct().count() == 2
    with pytest.raises(ValueError):
        ml.customer_segments(same.limit(0), k=5)


def test_hot_row_values_do_not_change_the_rest(spark):
    rows = blobs(spark, 400)
    hot = rows.unionByName(spark.createDataFrame([(f"h{i}", 10, 2, 50.0) for i in range(400)], rows.schema)).checkpoint()
    a = sorted(tuple(r) for r in ml.customer_segments(hot.repartition(7), k=4)[1].collect())
    assert a == sorted(tuple(r) for r in ml.customer_segments(hot.repartition(1), k=4)[1].collect())
    assert len({c for i, c in a if i.startswith("h")}) == 1
