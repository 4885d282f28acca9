from __future__ import annotations

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from lakekit.operators import joins, learning


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_LIMIT])
def test_same_vectors_as_the_encoder(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", limit)
    df = spark.range(300).select(
        F.col("id").cast("string").alias("key"),
        (F.col("id") % 7).alias("n"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 41)).alias("b c"),
        F.chr(F.col("id") % 5 + 97).alias("a"),
    )
    encoded, dictionary = learning.one_hot_by_dictionary(df, "key")
    usual = learning.one_hot(df, "key")
    assert [r.feature for r in dictionary.orderBy("position").collect()] == learning.feature_names(usual)
    assert encoded.columns == usual.columns
    vectors = {r.key: r.features for r in encoded.collect()}
    assert all(v.size == dictionary.count() for v in vectors.values())
    assert {k: list(v.toArray()) for k, v in vectors.items()} == {r.key: list(r.features.toArray()) for r in usual.collect()}
    assert len(KMeans(k=2, seed=1).fit(encoded).clusterCenters()) == 2  # Spark ML takes them


def test_many_values_null_and_empty(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") > 0, F.col("id").cast("string")).alias("c"), F.lit(None).cast("double").alias("n"))
    encoded, dictionary = learning.one_hot_by_dictionary(df, "k")
    assert dictionary.count() == 20_000  # one numeric column, 19,999 values
    first = encoded.where("k = 0").first().features
    assert first.size == 20_000 and first.numNonzeros() == 0
    assert encoded.where("k = 7").first().features.numNonzeros() == 1
    assert dictionary.select("position").distinct().count() == 20_000
    empty, names = learning.one_hot_by_dictionary(df.limit(0), "k")
    assert empty.count() == 0 and names.count() == 1
    only_numbers, names = learning.one_hot_by_dictionary(df.select("k", (F.col("k") * 2).alias("x")), "k")
    assert names.count() == 1 and only_numbers.where("k = 4").first().features.toArray().tolist() == [8.0]
