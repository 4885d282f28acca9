"""Registered queries: features, clustering and projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.operators import history, learning
from lakekit.registry import inputs
from lakekit.sources import erp
from lakekit.sources.workspace import fresh_dir


def _vectors(spark, d):
    table = erp.read_table(spark, d, "embeddings")
    return learning.array_features(table, "embedding").drop("embedding")


def _one_hot(spark, d):
    """Every encoded value that is set, by name."""
    customers = erp.kna1(spark, d).select("KUNNR", "LAND1", "BRSCH", "ORT01")
    encoded, dictionary = learning.one_hot_by_dictionary(customers, "KUNNR")
    vector = F.unwrap_udt("features")
    cells = encoded.select("KUNNR", F.explode(F.arrays_zip(vector["indices"].alias("i"), vector["values"].alias("v"))).alias("cell"))
    names = dictionary.select("feature", F.col("position").cast("int").alias("i"))
    return cells.select("KUNNR", F.col("cell.i").alias("i"), F.col("cell.v").alias("value")).join(names, "i").select("KUNNR", "feature", "value")


def _search(spark, d):
    report, _ = learning.cluster_search(
        _vectors(spark, d).select("vec_id", "features"), ("kmeans", "bisecting"), (5, 10), (42,)
    )
    return report


def _published(spark, d):
    """Given labels with their projection, stored as a version and read back."""
    path = fresh_dir(spark, "clusters")
    projected = learning.project_2d(_vectors(spark, d))
    learning.publish_clusters(projected, "vec_id", path, 0, inputs.COMMIT_TIMES[0])
    return history.snapshot_as_of(spark, path, 0)


def _quality(spark, d):
    scores = learning.cluster_quality(_vectors(spark, d))
    return scores.select(
        "clusters", *[F.round(c, 6).alias(c) for c in ("silhouette", "calinski_harabasz", "davies_bouldin")]
    )


QUERIES = {
    "one_hot": _one_hot,
    "cluster_search": _search,
    "cluster_quality": _quality,
    "project_2d": lambda s, d: learning.project_2d(_vectors(s, d)).select("vec_id", "label", "TSNE_X", "TSNE_Y"),
    "publish_clusters": _published,
}

ORACLES = {
    "one_hot": " UNION ALL ".join(
        f"SELECT KUNNR, '{c}=' || {c} AS feature, 1.0::DOUBLE AS value FROM kna1" for c in ("LAND1", "BRSCH", "ORT01")
    ),
    "cluster_quality": """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v,
            generate_subscripts(embedding, 1) AS i FROM embeddings),
        sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
        means AS (SELECT label, i, avg(v) AS m FROM x GROUP BY label, i),
        middle AS (SELECT i, avg(v) AS m FROM x GROUP BY i),
        far AS (SELECT x.vec_id, x.label, sum((v - m) * (v - m)) AS d2 FROM x JOIN means USING (label, i) GROUP BY 1, 2),
        spread AS (SELECT label, sum(d2) AS w, avg(sqrt(d2)) AS s FROM far GROUP BY label),
        totals AS (SELECT count(*) AS k, sum(n) AS n FROM sizes),
        between_ss AS (SELECT sum(n * (a.m - b.m) * (a.m - b.m)) AS b
            FROM means a JOIN middle b USING (i) JOIN sizes USING (label)),
        apart AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS d
            FROM means a JOIN means b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2),
        db AS (SELECT avg(r) AS db FROM (SELECT la, max((p.s + q.s) / d) AS r FROM apart
            JOIN spread p ON p.label = la JOIN spread q ON q.label = lb GROUP BY la)),
        pair AS (SELECT a.vec_id, a.label AS la, b.label AS lb, avg(sq) AS d FROM
            (SELECT a.vec_id, a.label, b.vec_id AS other, b.label AS lb0,
                list_sum(list_transform(range(1, 65), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE)
                    * (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE))) AS sq
             FROM embeddings a JOIN embeddings b ON TRUE) a JOIN (SELECT vec_id, label FROM embeddings) b
            ON a.other = b.vec_id GROUP BY 1, 2, 3),
        sil AS (SELECT vec_id, max(CASE WHEN la = lb THEN d * n / nullif(n - 1, 0) END) AS near,
            min(CASE WHEN la <> lb THEN d END) AS next, max(CASE WHEN la = lb THEN n END) AS n
            FROM pair JOIN sizes ON sizes.label = lb GROUP BY vec_id)
        SELECT CAST(k AS INTEGER) AS clusters,
            round((SELECT avg(CASE WHEN n = 1 THEN 0 ELSE (next - near) / greatest(next, near) END) FROM sil), 6)
                AS silhouette,
            round((b / (k - 1)) / ((SELECT sum(w) FROM spread) / (n - k)), 6) AS calinski_harabasz,
            round(db, 6) AS davies_bouldin FROM totals, between_ss, db""",
}
