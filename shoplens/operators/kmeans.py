"""KMeans whose result does not hang on the row layout (ML3).

Everything that adds up over rows is exact: features are taken as decimals of
ten places, so that sums, and with them deviations, centres and sampling
probabilities, are the same for any partitioning and order. A row's cluster
depends on the row and the centres only, and seeds are drawn by a hash of the
row's content. Each step is one DataFrame aggregate with partial aggregation; a
cluster that holds most rows costs its task no more than any other.

The result is an ordinary ``pyspark.ml`` pipeline model (assembler, scaler,
KMeans), which saves, loads and transforms like a fitted one.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Features are exact to ten places; squares and sums keep 38 digits.
EXACT, SUM = "decimal(28,10)", "decimal(38,10)"
#: Seeding turns and candidates a turn, as multiples of k (k-means||), turns of Lloyd's rule and the step that ends it.
SEED_TURNS, OVERSAMPLE, MAX_ITER, TOLERANCE = 2, 2, 20, 1e-4


def _fraction(x) -> Fraction:
    return Fraction(x) if x is not None else Fraction(0)


def deviations(rows: DataFrame, columns: list[str]) -> tuple[list[float], list[float], int]:
    """(means, sample standard deviations, rows) of the columns, from exact sums."""
    c = [F.col(x).cast(EXACT) for x in columns]
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(x.cast(SUM)).alias(f"s{i}") for i, x in enumerate(c)]).first()
    n = first["n"]
    if not n:
        return [0.0] * len(columns), [0.0] * len(columns), 0
    sums = [_fraction(first[f"s{i}"]) for i in range(len(columns))]
    # squares of the distance from a whole number near the mean, so that they stay small and exact
    middle = [int(s / n) for s in sums]
    away = [(x - F.lit(m).cast("decimal(18,0)")).cast("decimal(28,10)") for x, m in zip(c, middle, strict=True)]
    second = rows.agg(*[F.sum((a.cast("double") * a.cast("double")).cast("decimal(38,6)")).alias(f"q{i}") for i, a in enumerate(away)]).first()
    out = []
    for i, s in enumerate(sums):
        d = s - n * middle[i]
        variance = (_fraction(second[f"q{i}"]) - d * d / n) / (n - 1) if n > 1 else Fraction(0)
        out.append(float(max(variance, Fraction(0))) ** 0.5)
    return [float(s / n) for s in sums], out, n


def _scaled(columns: list[str], scale: list[float]) -> list[Column]:
    """Features over their deviation; a constant feature counts nothing (as the scaler has it)."""
    return [F.col(c).cast("double") * F.lit(1.0 / s if s else 0.0) for c, s in zip(columns, scale, strict=True)]


def _squares(point: list[Column], centres: np.ndarray) -> list[Column]:
    out = []
    for centre in centres:
        total = F.lit(0.0)
        for x, m in zip(point, centre, strict=True):
            total = total + (x - F.lit(float(m))) * (x - F.lit(float(m)))
        out.append(total)
    return out


def _nearest(point: list[Column], centres: np.ndarray) -> tuple[Column, Column]:
    """(number of the nearest centre, its squared distance); ties to the smaller number."""
    both = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(_squares(point, centres))]))
    return both["i"], both["d"]


def _draw(columns: list[str], key: str, seed: int, turn: int) -> Column:
    """A number in [0, 1) from the row's content."""
    h = F.xxhash64(F.lit(seed), F.lit(turn), F.col(key), *[F.col(c) for c in columns])
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def seed_candidates(rows: DataFrame, columns: list[str], key: str, scale: list[float], k: int, seed: int) -> np.ndarray:
    """Scaled candidate centres: the row of smallest hash, then rows drawn in proportion to their squared distance.

    ``SEED_TURNS`` turns of about ``OVERSAMPLE`` x k rows each (k-means||), so
    what reaches the driver is bounded by k. Drawing is by the hash of a row.
    """
    point = _scaled(columns, scale)
    values = [p.alias(f"f{i}") for i, p in enumerate(point)]
    names = [f"f{i}" for i in range(len(columns))]
    first = rows.select(*values, _draw(columns, key, seed, 0).alias("u")).orderBy("u", *names).limit(1).collect()
    centres = np.array([[r[c] for c in names] for r in first], float).reshape(-1, len(columns))
    for turn in range(1, SEED_TURNS + 1):
        _, d = _nearest(point, centres)
        cost = float(rows.agg(F.sum(d.cast("decimal(38,6)")).alias("c")).first()["c"] or 0)
        if cost <= 0:
            break
        wanted = _draw(columns, key, seed, turn) * F.lit(cost) < F.lit(float(OVERSAMPLE * k)) * d
        drawn = rows.where(wanted).select(*values).distinct().orderBy(*names).collect()
        new = np.array([[r[c] for c in names] for r in drawn], float).reshape(-1, len(columns))
        centres = np.vstack([centres, new])
    return np.unique(centres, axis=0)


def choose_seeds(rows: DataFrame, columns: list[str], key: str, scale: list[float], k: int, seed: int) -> np.ndarray:
    """At most k start centres: k-means++ over the candidates, weighted by the rows nearest to each."""
    candidates = seed_candidates(rows, columns, key, scale, k, seed)
    if len(candidates) <= k:
        return candidates
    which, _ = _nearest(_scaled(columns, scale), candidates)
    weight = np.zeros(len(candidates))
    for r in rows.groupBy(which.alias("i")).agg(F.count(F.lit(1)).alias("n")).collect():
        weight[r["i"]] = r["n"]
    rng = np.random.default_rng(seed)
    chosen = [int(np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), side="right"))]
    distance = ((candidates - candidates[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k and (weight * distance).sum() > 0:
        share = np.cumsum(weight * distance)
        chosen.append(min(int(np.searchsorted(share, rng.random() * share[-1], side="right")), len(candidates) - 1))
        distance = np.minimum(distance, ((candidates - candidates[chosen[-1]]) ** 2).sum(axis=1))
    return candidates[chosen]


def lloyd(rows: DataFrame, columns: list[str], scale: list[float], centres: np.ndarray, max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> np.ndarray:
    """Centres after Lloyd's rule; a centre is the exact mean of its rows, one without rows stays."""
    point = _scaled(columns, scale)
    for _ in range(max_iter):
        which, _ = _nearest(point, centres)
        sums = rows.groupBy(which.alias("i")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast(SUM)).alias(f"s{j}") for j, c in enumerate(columns)]).collect()
        moved = centres.copy()
        for r in sums:
            with localcontext() as ctx:
                ctx.prec = 60
                moved[r["i"]] = [float(Decimal(r[f"s{j}"]) / r["n"]) * (1.0 / s if s else 0.0) for j, s in enumerate(scale)]
        step = np.sqrt(((moved - centres) ** 2).sum(axis=1)).max()
        centres = moved
        if step <= tolerance:
            break
    return centres


def pipeline_model(spark: SparkSession, columns: list[str], means: list[float], scale: list[float], centres: np.ndarray, prediction: str = "cluster") -> PipelineModel:
    """The fitted stages as ``pyspark.ml`` models: assembler, scaler to unit deviation (no centring), KMeans."""
    jvm = spark.sparkContext._jvm
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID
    old, new = jvm.org.apache.spark.mllib.linalg.Vectors, jvm.org.apache.spark.ml.linalg.Vectors

    def dense(make, values):
        array = spark.sparkContext._gateway.new_array(jvm.double, len(values))
        for i, v in enumerate(values):
            array[i] = float(v)
        return make.dense(array)

    scaler = StandardScalerModel(jvm.org.apache.spark.ml.feature.StandardScalerModel(uid("stdScal"), dense(new, scale), dense(new, means)))
    scaler._set(inputCol="features", outputCol="scaled_features", withStd=True, withMean=False)
    scaler._transfer_params_to_java()
    listed = jvm.java.util.ArrayList()
    for c in centres:
        listed.add(dense(old, c))
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(uid("kmeans"), jvm.org.apache.spark.mllib.clustering.KMeansModel(listed)))
    model._set(featuresCol="scaled_features", predictionCol=prediction, k=max(2, len(centres)))
    model._transfer_params_to_java()
    return PipelineModel([VectorAssembler(inputCols=columns, outputCol="features"), scaler, model])


def fit_segments(rows: DataFrame, columns: list[str], key: str, k: int = 5, seed: int = 42, max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> PipelineModel:
    """Fit scaler and KMeans on ``rows`` (stored or checkpointed: they are read several times).

    The columns are numeric without nulls; values that are no decimals of
    18 digits before the point raise. With fewer than k distinct rows there are
    as many clusters as rows. Without rows ValueError is raised.
    """
    means, scale, n = deviations(rows, columns)
    if not n:
        raise ValueError("no rows to fit")
    centres = choose_seeds(rows, columns, key, scale, k, seed)
    centres = lloyd(rows, columns, scale, centres, max_iter, tolerance)
    return pipeline_model(rows.sparkSession, columns, means, scale, centres)
