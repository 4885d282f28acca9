from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lakekit.operators import enrich, history, learning
from lakekit.registry.inputs import CLOCK


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    points = [
        (int(i), int(i % 3), [float(x) for x in rng.normal(10 * (i % 3), 0.5, 4)])
        for i in range(90)
    ]
    df = spark.createDataFrame(points, "id int, label int, v array<double>")
    return df.withColumn("features", array_to_vector("v")).drop("v").cache()


def test_search_finds_the_blobs(blobs):
    report, labelled = learning.cluster_search(blobs.drop("label"), ("kmeans", "bisecting"), (2, 3), (1,))
    best = report.where("best").first()
    assert report.count() == 4 and best.k == 3 and best.silhouette > 0.9
    assert labelled.groupBy((F.col("id") % 3).alias("true"), "label").count().count() == 3


def test_quality_against_numpy(blobs):
    got = learning.cluster_quality(blobs).first()
    data = blobs.select("label", vector_to_array("features").alias("v")).toPandas()
    points, labels = np.array(data.v.tolist()), data.label.to_numpy()
    centers = np.array([points[labels == i].mean(axis=0) for i in range(3)])
    inside = sum(((points[labels == i] - centers[i]) ** 2).sum() for i in range(3))
    between = sum((labels == i).sum() * ((centers[i] - points.mean(axis=0)) ** 2).sum() for i in range(3))
    spread = [np.sqrt(((points[labels == i] - centers[i]) ** 2).sum(axis=1)).mean() for i in range(3)]
    db = np.mean(
        [max((spread[i] + spread[j]) / np.linalg.norm(centers[i] - centers[j]) for j in range(3) if j != i) for i in range(3)]
    )
    assert got.calinski_harabasz == pytest.approx((between / 2) / (inside / 87))
    assert got.davies_bouldin == pytest.approx(db)
    assert got.silhouette > 0.9


def test_single_cluster(blobs):
    one = learning.cluster_quality(blobs.withColumn("label", F.lit(0))).first()
    assert (one.silhouette, one.calinski_harabasz, one.davies_bouldin) == (-1.0, 0.0, float("inf"))


def test_projection_is_principal_components(blobs):
    got = learning.project_2d(blobs).orderBy("id").toPandas()
    points = np.array(blobs.orderBy("id").select(vector_to_array("features").alias("v")).toPandas().v.tolist())
    _, _, axes = np.linalg.svd(points - points.mean(axis=0), full_matrices=False)
    for column, axis in zip(("TSNE_X", "TSNE_Y"), axes):
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert np.allclose(got[column], points @ axis)


def test_published_clusters_are_unique_by_key(spark, blobs, tmp_path):
    projected = learning.project_2d(blobs)
    learning.publish_clusters(projected, "id", str(tmp_path / "c"), 0, CLOCK)
    stored = history.snapshot_as_of(spark, str(tmp_path / "c"), 0)
    assert dict(stored.dtypes)["TSNE_X"] == "decimal(38,18)" and dict(stored.dtypes)["labels"] == "bigint"
    with pytest.raises(Exception, match="duplicate key"):
        learning.cluster_table(projected.unionByName(projected), "id").collect()


def test_features(spark):
    df = spark.createDataFrame(
        [("k1", "", True, None, "x"), ("k2", "a", False, None, None)], "key string, c string, b boolean, empty string, d string"
    )
    ready = learning.prepare_features(df, df.columns, "key")
    assert rows(ready) == [("k1", "Noc", 1, "x"), ("k2", "a", 0, "Nod")]
    encoded = learning.one_hot(ready, "key")
    assert learning.feature_names(encoded) == ["b", "c=Noc", "c=a", "d=Nod", "d=x"]
    cells = {r.key: list(r.features.toArray()) for r in encoded.collect()}
    assert cells == {"k1": [1, 1, 0, 0, 1], "k2": [0, 0, 1, 1, 0]}


def test_many_categories(spark):
    df = spark.range(10_500).select(F.col("id").cast("string").alias("key"), F.col("id").cast("string").alias("c"))
    encoded = learning.one_hot(df, "key")
    assert encoded.first().features.size == 10_500


def test_quality_of_many_clusters(spark, monkeypatch):
    df = spark.range(4_400).select(
        (F.col("id") % 2_200).alias("label"), F.array(F.col("id") % 2_200 * 1.0, F.col("id") * 0.001).alias("e")
    )
    vectors = learning.array_features(df, "e").drop("e")
    blocks = learning.cluster_quality(vectors).first()
    monkeypatch.setattr(learning, "MEANS_PER_BLOCK", 10_000)
    assert blocks.clusters == 2_200 and blocks == learning.cluster_quality(vectors).first()


def test_model_is_loaded_once_per_task(spark):
    def load():
        import os
        import uuid

        loaded = f"{os.getpid()}-{uuid.uuid4()}"

        def score(texts: pd.Series) -> pd.Series:
            return texts.str.upper() + "|" + loaded

        return score

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 100, 1, 2).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"))
        out = [r.o for r in enrich.enrich_with_model(df, "t", "o", load).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out[7].startswith("T7|")
    assert len({o.split("|")[1] for o in out}) == 2


def test_only_open_keys_are_enriched(spark):
    source = spark.createDataFrame([(1, "pago"), (2, "sueldo"), (3, None)], "k int, t string")
    done = spark.createDataFrame([(1,)], "k int")
    score = lambda todo: enrich.with_category(todo, "t", "categoria_ia")
    new = enrich.enrich_incremental(source, done, ["k"], "t", score, "rules", CLOCK)
    assert rows(new) == [(2, "sueldo", "Nómina", "rules", CLOCK)]
    again = enrich.enrich_incremental(source, done.unionByName(new.select("k")), ["k"], "t", score, "rules")
    assert again.count() == 0


def test_summary_keeps_order_and_limit(spark):
    text = "Solar power grows. Wind turns. Solar power and wind power grow! Nothing here"
    df = spark.createDataFrame([(1, text), (2, "One very long sentence that is longer than the limit")], "k int, t string")
    found = {r.k: r.summary for r in enrich.summarise_extract(df, "k", "t", 9).collect()}
    assert found[1] == "Solar power grows. Solar power and wind power grow"
    assert found[2].startswith("One very long")


def test_texts_without_words_keep_their_row(spark):
    df = spark.createDataFrame([(1, "12 34. 56"), (2, None), (3, ""), (4, "A word")], "k int, t string")
    found = {r.k: r.summary for r in enrich.summarise_extract(df, "k", "t", 9).collect()}
    assert found == {1: None, 2: None, 3: None, 4: "A word"}


def test_long_documents_are_one_row(spark):
    df = spark.range(25).select(F.lit("d").alias("doc"), F.col("id").alias("pos"), F.col("id").cast("string").alias("t"))
    found = enrich.document_text(df, "doc", "pos", "t", rows_per_part=10).collect()
    assert [r.document_text.split("\n") for r in found] == [[str(i) for i in range(25)]]


def test_parsed_document(spark):
    tree = '{"document": {"elements": [{"content": "a"}, {"content": "b"}]}}'
    df = spark.createDataFrame([(tree,)], "j string").select(
        enrich.variant_document_text(F.parse_json("j")).alias("t")
    )
    assert df.first().t == "a\nb"
