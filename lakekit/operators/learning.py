"""Feature preparation, clustering and projection with Spark ML."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce
from itertools import product

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.operators.centers import Setting, fit_all, label_of, silhouettes
from lakekit.operators.changes import unique_rows
from lakekit.operators.cleaning import bool_to_int, drop_all_null_columns, empty_to_null, fill_missing_category
from lakekit.operators.history import write_version
from lakekit.operators.joins import broadcast_if_small
from lakekit.operators.ranking import global_position
from lakekit.sources.workspace import fresh_dir, written

# Cluster means compared at a time: bounds the memory for their distances, not their number.
MEANS_PER_BLOCK = 1_000

def prepare_features(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Chosen columns with gaps closed: '' is NULL, booleans are 0/1, empty columns go, NULL categories are named."""
    chosen = empty_to_null(df.select(*columns))
    return fill_missing_category(drop_all_null_columns(bool_to_int(chosen), keep=[key]), key)


def one_hot(df: DataFrame, key: str, output: str = "features") -> DataFrame:
    """All text columns but the key as 0/1 columns of one vector, next to the numeric ones.

    The vector's metadata names its columns; feature_names reads them back. For few categories: their names go through the
    driver. `one_hot_by_dictionary` has no such limit.
    """
    texts, numbers = _text_columns(df, key), _number_columns(df, key)
    indexed, encoded = [f"_{c}_index" for c in texts], [f"_{c}_hot" for c in texts]
    stages = [
        StringIndexer(inputCols=texts, outputCols=indexed, stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=False),
        VectorAssembler(inputCols=[*numbers, *encoded], outputCol=output),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop(*indexed, *encoded)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    attributes = df.schema[column].metadata["ml_attr"]["attrs"]
    named = [a for group in attributes.values() for a in group]
    return [a["name"].replace("_hot_", "=").lstrip("_") for a in sorted(named, key=lambda a: a["idx"])]


def one_hot_dictionary(df: DataFrame, key: str) -> DataFrame:
    """(column, value, feature, position) of every 0/1 column that `one_hot_by_dictionary` makes of a table.

    Positions follow the columns' order and the values' order within them, after the numeric columns, which come first under
    their own names. Values are made distinct where they are, then numbered by a distributed sort.
    """
    texts, numbers = _text_columns(df, key), _number_columns(df, key)
    found = [
        df.where(F.col(f"`{c}`").isNotNull()).select(F.lit(i).alias("_i"), F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")).distinct()
        for i, c in enumerate(texts)
    ]
    named = df.sparkSession.createDataFrame(
        [(i, c, None, c) for i, c in enumerate(numbers)], "position long, column string, value string, feature string"
    )
    columns = ("column", "value", "feature", "position")
    if not found:
        return written(named.select(*columns), "one-hot-dictionary")
    placed = global_position(reduce(DataFrame.unionByName, found), [F.col("_i"), F.col("value")], "position")
    hot = placed.select(
        "column", "value", F.concat("column", F.lit("="), "value").alias("feature"), (F.col("position") + len(numbers)).alias("position")
    )
    return written(named.select(*columns).unionByName(hot), "one-hot-dictionary")


def one_hot_by_dictionary(df: DataFrame, key: str, output: str = "features") -> tuple[DataFrame, DataFrame]:
    """As `one_hot`, for columns with any number of values: (the rows with a sparse vector, the dictionary of its places).

    Each text column looks up its position in the dictionary, which is a table; only the number of places reaches the driver.
    NULL values set nothing. The rows are stored once, as that gives the vectors their type without a Python function.
    """
    texts, numbers = _text_columns(df, key), _number_columns(df, key)
    dictionary = one_hot_dictionary(df, key)
    places = dictionary.count()
    found = df
    for i, c in enumerate(texts):
        own = dictionary.where((F.col("column") == c) & F.col("value").isNotNull()).select(
            F.col("value").alias("_value"), F.col("position").cast("int").alias(f"_place_{i}")
        )
        found = found.join(broadcast_if_small(own), F.col(f"`{c}`") == F.col("_value"), "left").drop("_value")
    cells = [F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(numbers)]
    cells += [F.struct(F.col(f"_place_{i}").alias("i"), F.lit(1.0).alias("v")) for i in range(len(texts))]
    kept = F.filter(F.array(*cells), lambda x: x["i"].isNotNull() & x["v"].isNotNull() & (x["v"] != 0))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(places).alias("size"),
        F.transform(kept, lambda x: x["i"]).alias("indices"),
        F.transform(kept, lambda x: x["v"]).alias("values"),
    )
    shaped = found.select(*[F.col(f"`{c}`") for c in df.columns], vector.alias(output))
    path = fresh_dir(df.sparkSession, "one-hot")
    shaped.write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(output, VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path), dictionary


def _text_columns(df: DataFrame, key: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != key]


def _number_columns(df: DataFrame, key: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != key]


def array_features(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    """An array of floats as a vector column."""
    return df.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


def cluster_search(
    df: DataFrame,
    algorithms: Iterable[str],
    cluster_counts: Iterable[int],
    seeds: Iterable[int] = (42,),
    features: str = "features",
) -> tuple[DataFrame, DataFrame]:
    """Try every setting; returns (one row per setting with its silhouette, rows labelled by the best one).

    All settings are trained by the same passes over the rows, and scored by two more, so the number of passes doesn't grow
    with that of settings.
    """
    settings = [Setting(a, k, seed) for a, k, seed in product(algorithms, cluster_counts, seeds)]
    vectors = df.select(vector_to_array(features).alias("v")).persist()
    try:
        fitted = fit_all(vectors, settings)
        scores = silhouettes(vectors, fitted)
    finally:
        vectors.unpersist()
    best = max(range(len(scores)), key=lambda i: scores[i][1])
    report = df.sparkSession.createDataFrame(
        [(s.algorithm, s.k, s.seed, *scores[i], i == best) for i, s in enumerate(settings)],
        "algorithm string, k int, seed int, clusters int, silhouette double, best boolean",
    )
    return report, df.withColumn("label", label_of(vector_to_array(features), fitted[best]))


def cluster_quality(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """Silhouette, Calinski-Harabasz and Davies-Bouldin of a labelling, one row.

    Two passes: cluster means, then distances to them. Only the means (one row per cluster) reach the driver. The
    silhouette uses squared distances. A single cluster scores -1, 0 and infinity.
    """
    spark = df.sparkSession
    schema = "clusters int, silhouette double, calinski_harabasz double, davies_bouldin double"
    means = (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("_n"), vector_to_array(Summarizer.mean(F.col(features))).alias("_mean"))
        .collect()
    )
    if len(means) < 2:
        return spark.createDataFrame([(len(means), -1.0, 0.0, float("inf"))], schema)
    centers = spark.createDataFrame(
        [(m[label], m["_mean"]) for m in means],
        T.StructType([df.schema[label], T.StructField("_mean", T.ArrayType(T.DoubleType()))]),
    )
    squares = F.zip_with(vector_to_array(features), F.col("_mean"), lambda x, m: (x - m) * (x - m))
    squared = F.aggregate(squares, F.lit(0.0), lambda total, s: total + s)
    spread = {
        r[label]: (r["_within"], r["_spread"])
        for r in df.join(centers, label)
        .select(label, squared.alias("_d2"))
        .groupBy(label)
        .agg(F.sum("_d2").alias("_within"), F.avg(F.sqrt("_d2")).alias("_spread"))
        .collect()
    }
    labels = [m[label] for m in means]
    counts = np.array([m["_n"] for m in means], dtype=float)
    points = np.array([m["_mean"] for m in means])
    within = np.array([spread[x][0] for x in labels]).sum()
    spreads = np.array([spread[x][1] for x in labels])
    rows, clusters = counts.sum(), len(labels)
    middle = (points * counts[:, None]).sum(axis=0) / rows
    between = (counts * ((points - middle) ** 2).sum(axis=1)).sum()
    ch = (between / (clusters - 1)) / (within / (rows - clusters)) if within > 0 else 1.0
    db = np.concatenate([_worst(points, spreads, a) for a in range(0, clusters, MEANS_PER_BLOCK)]).mean()
    silhouette = ClusteringEvaluator(featuresCol=features, predictionCol=label).evaluate(df)
    return spark.createDataFrame([(clusters, float(silhouette), float(ch), float(db))], schema)


def _worst(points: np.ndarray, spreads: np.ndarray, start: int) -> np.ndarray:
    """For a block of clusters, the largest ratio of spreads to distance to any other cluster."""
    block = points[start : start + MEANS_PER_BLOCK]
    apart = np.zeros((len(block), len(points)))
    for i in range(points.shape[1]):
        apart += (block[:, i, None] - points[None, :, i]) ** 2
    apart = np.sqrt(apart)
    own = np.arange(len(block))
    apart[own, start + own] = np.inf
    with np.errstate(divide="ignore", invalid="ignore"):
        similar = (spreads[start : start + len(block), None] + spreads[None, :]) / apart
    return np.nan_to_num(similar, nan=0.0).max(axis=1)


def project_2d(df: DataFrame, features: str = "features", x: str = "TSNE_X", y: str = "TSNE_Y") -> DataFrame:
    """Two coordinates per row: its first two principal components.

    A component's sign is arbitrary; it is chosen so that the largest loading is positive.
    """
    model = PCA(k=2, inputCol=features, outputCol="_pc").fit(df)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.abs(loadings[:, i]).argmax(), i])) for i in range(2)]
    parts = vector_to_array("_pc")
    return model.transform(df).withColumns({x: parts[0] * signs[0], y: parts[1] * signs[1]}).drop("_pc")


def cluster_table(df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Published form of a clustering: coordinates as decimals, label as long; the key is unique."""
    shaped = df.select(
        F.col("TSNE_X").cast("decimal(38,18)").alias("TSNE_X"),
        F.col("TSNE_Y").cast("decimal(38,18)").alias("TSNE_Y"),
        F.col(label).cast("bigint").alias("labels"),
        F.col(key),
    )
    return unique_rows(shaped, [key])


def publish_clusters(
    df: DataFrame, key: str, path: str, version: int, committed_at: datetime, label: str = "label"
) -> None:
    """Store a clustering as the next version of its history table: after the first one, the rows that have changed."""
    write_version(cluster_table(df, key, label), path, version, "CLUSTER", committed_at, [key])
