"""The unsupervised study: scaled predictors, choice of k, and cluster profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.session import side_by_side

SCALED = "features_scaled"


def scale(
    sample: DataFrame, columns: Sequence[str] = v.CLUSTER_FEATURES
) -> tuple[DataFrame, StandardScalerModel]:
    """Adds ``features_scaled``: the columns with mean 0 and sample deviation 1."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="__raw")
    scaler = StandardScaler(inputCol="__raw", outputCol=SCALED, withMean=True, withStd=True)
    model = Pipeline(stages=[assembler, scaler]).fit(sample)
    return model.transform(sample).drop("__raw"), model.stages[-1]


def scaled_columns(
    scaled: DataFrame, keep: Sequence[str], columns: Sequence[str] = v.CLUSTER_FEATURES
) -> DataFrame:
    """The scaled vector as one ``<name>_scaled`` column per predictor."""
    values = vector_to_array(SCALED)
    return scaled.select(
        *keep, *[F.get(values, F.lit(i)).alias(f"{c}_scaled") for i, c in enumerate(columns)]
    )


def fit_clusters(scaled: DataFrame, k: int, iterations: int, seed: int = v.SEED) -> KMeansModel:
    return KMeans(featuresCol=SCALED, k=k, seed=seed, maxIter=iterations).fit(scaled)


def silhouette(clustered: DataFrame) -> float:
    evaluator = ClusteringEvaluator(
        featuresCol=SCALED, metricName="silhouette", distanceMeasure="squaredEuclidean"
    )
    return evaluator.evaluate(clustered)


def sweep(
    scaled: DataFrame,
    counts: Sequence[int] = v.CLUSTER_COUNTS,
    iterations: int = v.CLUSTER_SWEEP_ITERATIONS,
    seed: int = v.SEED,
) -> DataFrame:
    """Cost and silhouette for each number of clusters. ``scaled`` should be persisted."""

    def measure(k: int) -> tuple[int, float, float]:
        model = fit_clusters(scaled, k, iterations, seed)
        cost = float(model.summary.trainingCost)
        return k, cost, float(silhouette(model.transform(scaled)))

    spark = scaled.sparkSession
    rows = side_by_side(spark, measure, counts)
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def best_count(results: DataFrame) -> int:
    """The k with the largest silhouette, the smaller one if equal."""
    return results.agg(F.min_by("k", F.struct(-F.col("silhouette"), "k"))).first()[0]


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    """Rows and percent per cluster; the window runs over one row per cluster."""
    total = F.sum("count").over(Window.partitionBy())
    return (
        clustered.groupBy("prediction")
        .count()
        .withColumn("pct", F.col("count") / total * 100)
        .orderBy("prediction")
    )


def centroids(
    model: KMeansModel,
    scaler: StandardScalerModel,
    sizes: DataFrame,
    columns: Sequence[str] = v.CLUSTER_FEATURES,
) -> DataFrame:
    """Cluster centres on the original scale, with the size of each cluster."""
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    schema = "cluster int, " + ", ".join(f"{c} double" for c in columns)
    centres = sizes.sparkSession.createDataFrame(rows, schema)
    original = [
        (F.col(c) * float(std) + float(mean)).alias(c)
        for c, std, mean in zip(columns, scaler.std, scaler.mean, strict=True)
    ]
    return (
        centres.select("cluster", *original)
        .join(sizes.withColumnRenamed("prediction", "cluster"), "cluster")
        .orderBy("cluster")
    )


def composition(
    clustered: DataFrame,
    strata: Sequence[str],
    row: str = "prediction",
    column: str = "partition_id",
    percent: bool = False,
) -> DataFrame:
    """Rows per cluster, one column per stratum; with ``percent`` each row adds up to 100."""
    return composition_of(clustered.groupBy(row, column).count(), strata, row, column, percent)


def composition_of(
    cells: DataFrame,
    strata: Sequence[str],
    row: str = "prediction",
    column: str = "partition_id",
    percent: bool = False,
) -> DataFrame:
    """``composition`` of counted cells: ``row``, ``column`` and ``count``."""
    value = F.first("count")
    if percent:
        of_row = F.sum("count").over(Window.partitionBy(row))
        cells = cells.withColumn("share", F.col("count") / of_row * 100)
        value = F.first("share")
    return cells.groupBy(row).pivot(column, list(strata)).agg(value).na.fill(0).orderBy(row)


def assign(rows: DataFrame, centres: Sequence[Sequence[float]], columns: Sequence[str]) -> DataFrame:
    """Adds ``prediction``, the nearest of the given centres (the first of equally near), and ``distance``,
    the squared distance to it. Rows with a NULL coordinate get NULL for both."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    choices = []
    for i, centre in enumerate(centres):
        parts = [(F.col(c) - float(x)) * (F.col(c) - float(x)) for c, x in zip(columns, centre, strict=True)]
        choices.append(F.struct(sum(parts[1:], parts[0]).alias("distance"), F.lit(i).alias("prediction")))
    nearest = F.least(*choices) if len(choices) > 1 else choices[0]
    return rows.withColumn("__nearest", F.when(known, nearest)).select(
        "*", F.col("__nearest.prediction").alias("prediction"), F.col("__nearest.distance").alias("distance")
    ).drop("__nearest")


def cluster_moments(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per cluster: rows, ``cost``, the sum of each coordinate, and the sum of all squares; one pass, mergeable."""
    squares = [F.col(c) * F.col(c) for c in columns]
    return assigned.filter(F.col("prediction").isNotNull()).groupBy("prediction").agg(
        F.count("*").alias("count"),
        F.sum("distance").alias("cost"),
        F.sum(sum(squares[1:], squares[0])).alias("squares"),
        *[F.sum(c).alias(f"sum_{c}") for c in columns],
    )


def silhouette_column(moments: Sequence, columns: Sequence[str]) -> Column:
    """The silhouette of a row with squared distances, from the moments of all clusters.

    The mean squared distance of a row to a cluster follows from the cluster's count, sums and squares, so no
    two rows meet. ``moments`` are the collected rows of ``cluster_moments``, one per cluster. 0 for the
    only row of a cluster, as is usual; NULL where there is one cluster.
    """
    own = {c: F.col(c) for c in columns}
    norm = sum((own[c] * own[c] for c in columns[1:]), own[columns[0]] * own[columns[0]])
    mean = {}
    for m in moments:
        dot = F.lit(0.0)
        for c in columns:
            dot = dot + own[c] * float(m[f"sum_{c}"])
        mean[m["prediction"]] = norm + (float(m["squares"]) - 2.0 * dot) / float(m["count"])
    result = F.lit(None).cast("double")
    for m in moments:
        k, n = m["prediction"], float(m["count"])
        others = [mean[j] for j in mean if j != k]
        if not others:
            continue
        if n == 1:
            value = F.lit(0.0)
        else:
            inside = mean[k] * (n / (n - 1))
            nearest = F.least(*others) if len(others) > 1 else others[0]
            value = F.coalesce(F.try_divide(nearest - inside, F.greatest(nearest, inside)), F.lit(0.0))
        result = F.when(F.col("prediction") == k, value).otherwise(result)
    return result


def profile_clusters(
    rows: DataFrame, centres: Sequence[Sequence[float]], columns: Sequence[str], original: Sequence[str] = ()
) -> DataFrame:
    """Per cluster of the given centres: size, percent, cost, mean silhouette, and the means of ``original``.

    ``rows`` is read once for the moments, of which the driver gets one row per cluster, and once for the rest.
    """
    assigned = assign(rows, centres, columns)
    moments = cluster_moments(assigned, columns).orderBy("prediction").collect()
    total = F.sum("count").over(Window.partitionBy())
    return (
        assigned.filter(F.col("prediction").isNotNull())
        .withColumn("__silhouette", silhouette_column(moments, columns))
        .groupBy("prediction")
        .agg(
            F.count("*").alias("count"),
            F.sum("distance").alias("cost"),
            F.avg("__silhouette").alias("silhouette"),
            *[F.avg(c).alias(c) for c in original],
        )
        .withColumn("pct", F.col("count") / total * 100)
    )


def score_clusters(profile: DataFrame) -> DataFrame:
    """One row of the whole clustering: clusters that have rows, cost, and the mean silhouette of all rows."""
    rows = F.sum("count")
    return profile.agg(
        F.count("*").alias("k"),
        F.sum("cost").alias("inertia"),
        F.try_divide(F.sum(F.col("silhouette") * F.col("count")), rows).alias("silhouette"),
    )


@dataclass
class Clusters:
    """The final clustering and its tables."""

    k: int
    sweep: DataFrame
    sizes: DataFrame
    centroids: DataFrame
    clustered: DataFrame
    silhouette: float
    inertia: float


def cluster(
    scaled: DataFrame,
    scaler: StandardScalerModel,
    counts: Sequence[int] = v.CLUSTER_COUNTS,
    sweep_iterations: int = v.CLUSTER_SWEEP_ITERATIONS,
    iterations: int = v.CLUSTER_FINAL_ITERATIONS,
    seed: int = v.SEED,
) -> Clusters:
    """Choose k by silhouette and fit it longer. ``scaled`` should be persisted."""
    results = sweep(scaled, counts, sweep_iterations, seed)
    k = best_count(results)
    model = fit_clusters(scaled, k, iterations, seed)
    clustered = model.transform(scaled)
    sizes = cluster_sizes(clustered)
    return Clusters(
        k=k,
        sweep=results,
        sizes=sizes,
        centroids=centroids(model, scaler, sizes),
        clustered=clustered,
        silhouette=silhouette(clustered),
        inertia=float(model.summary.trainingCost),
    )
