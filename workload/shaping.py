"""Queries on scaling, encoding, neighbours, balancing and clustering."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from meridia.functions.blocks import dense_blocks
from meridia.operators import balance, cluster, encode, lloyd, neighbors, prep, split, wide_pca

from . import views
from .judging import _SPLIT_SQL
from .registry import fix, fix_sql, fixed, fixed_sql, query

_SCALED = prep.NUMERIC_FEATURES


def _split(spark, sf_dir):
    return split.stratified_split(views.labeled(spark, sf_dir), prep.TARGET, "row_id")


_STATS_SQL = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _SCALED)
_SCALED_SQL = ", ".join(
    fixed_sql(f"(l.{c} - {c}_m) / CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END", 6) + f" AS {c}" for c in _SCALED
)


@query(
    "standard_scale",
    f"""WITH {_SPLIT_SQL},
    joined AS (SELECT labeled.*, split FROM labeled JOIN split USING (row_id)),
    learned AS (SELECT {_STATS_SQL} FROM joined WHERE split = 'train')
    SELECT row_id, split, {_SCALED_SQL} FROM joined l, learned""",
)
def standard_scale(spark, sf_dir):
    rows = _split(spark, sf_dir).select("row_id", "split", *_SCALED).persist()
    scaling = encode.fit_scaling(rows.where("split = 'train'"), _SCALED)
    return fix(scaling.apply(rows), _SCALED, 6)


@query(
    "one_hot",
    f"""WITH {views.READINGS_SQL}
    SELECT row_id, {", ".join(f"CASE WHEN data_source = '{v}' THEN 1 ELSE 0 END AS data_source_{v}" for v in "ANR")},
           CASE WHEN data_estimation_method = 'MODEL' THEN 1 ELSE 0 END AS "data_estimation_method_MODEL"
    FROM readings""",
)
def one_hot(spark, sf_dir):
    rows = views.readings(spark, sf_dir).select("row_id", "data_source", "data_estimation_method")
    for c in ("data_source", "data_estimation_method"):
        rows = encode.one_hot(rows, c, encode.levels(rows, c))
    return rows.drop("data_source", "data_estimation_method")


_NUM_STATS_SQL = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in prep.NUMERIC_FEATURES)
_SLOTS_SQL = " UNION ALL ".join(
    [
        f"SELECT row_id, split, 'numeric__{c}' AS feature,"
        f" (l.{c} - {c}_m) / CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END AS value FROM joined l, learned"
        for c in prep.NUMERIC_FEATURES
    ]
    + [
        f"SELECT row_id, split, 'categorical__{c}_' || v AS feature, ({c} = v)::int::double AS value FROM joined,"
        f" (SELECT DISTINCT {c} AS v FROM joined WHERE split = 'train')"
        for c in prep.TEXTS
    ]
)


@query(
    "preprocess",
    f"""WITH {_SPLIT_SQL},
    joined AS (SELECT labeled.*, split FROM labeled JOIN split USING (row_id)),
    learned AS (SELECT {_NUM_STATS_SQL} FROM joined WHERE split = 'train'),
    slots AS ({_SLOTS_SQL})
    SELECT row_id, split, feature, {fixed_sql("value", 6)} AS value FROM slots""",
)
def preprocess(spark, sf_dir):
    """Every slot of the prepared vector of every row, learned on the training side only."""
    rows = _split(spark, sf_dir).persist()
    numeric, texts = encode.typed_columns(rows.select(*prep.FEATURE_ORDER))
    prepared = encode.fit_preprocessor(rows.where("split = 'train'"), numeric, texts)
    values = prepared.apply(rows).select("row_id", "split", encode.slots("features", prepared.names))
    return fix(values, ["value"], 6)


# --- neighbours and balance --------------------------------------------------------------------


@query(
    "knn_join",
    f"""WITH {views.VECTORS_SQL},
    pairs AS (SELECT a.row_id, b.row_id AS neighbor, list_distance(a.x, b.x) AS distance
              FROM vectors a JOIN vectors b ON a.row_id <> b.row_id),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY row_id ORDER BY distance, neighbor) AS int) AS rank
               FROM pairs)
    SELECT {fix_sql(["distance"], 6)} FROM ranked WHERE rank <= 5""",
)
def knn_join(spark, sf_dir):
    return fix(neighbors.knn_join(views.vectors(spark, sf_dir), "row_id", "x", 5), ["distance"], 6)


@query(
    "balance_decision",
    f"""WITH counts AS (SELECT lang, toxic, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY ALL),
    least AS (SELECT lang, min(n) AS min_count, sum(n)::bigint AS row_count, max(n) AS max_count,
                     min(n) / sum(n) AS min_share FROM counts GROUP BY lang)
    SELECT * REPLACE ({fixed_sql("min_share", 6)} AS min_share),
           CASE WHEN min_share >= 0.2 THEN 'Skipped (already balanced)' WHEN min_count < 6 THEN 'ADASYN'
                ELSE 'SMOTE' END AS strategy FROM least""",
)
def balance_decision(spark, sf_dir):
    labels = views.table(spark, sf_dir, "labels")
    langs = views.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return fix(balance.balance_decision(labels.join(langs, "doc_id"), "toxic", by=["lang"]), ["min_share"], 6)


_SMOTE_SQL = f"""{views.VECTORS_SQL},
sizes AS (SELECT label, count(*) AS n FROM vectors GROUP BY label),
ranked AS (SELECT v.*, n, (SELECT max(n) FROM sizes) - n AS need,
                  row_number() OVER (PARTITION BY label ORDER BY md5('42:' || row_id), row_id) AS r
           FROM vectors v JOIN sizes USING (label)),
dealt AS (SELECT *, need // n + CASE WHEN r <= need % n THEN 1 ELSE 0 END AS copies FROM ranked WHERE need > 0),
near AS (SELECT row_id, list(neighbor ORDER BY rank) AS near FROM (
           SELECT a.row_id, b.row_id AS neighbor,
                  row_number() OVER (PARTITION BY a.row_id ORDER BY list_distance(a.x, b.x), b.row_id) AS rank
           FROM vectors a JOIN vectors b ON a.label = b.label AND a.row_id <> b.row_id)
         WHERE rank <= 5 GROUP BY row_id),
draws AS (SELECT row_id, label, x, near, unnest(range(1, copies + 1)) AS copy FROM dealt JOIN near USING (row_id)),
hashed AS (SELECT *, md5('42:' || row_id || ':' || copy) AS h FROM draws),
chosen AS (SELECT row_id, label, x, copy, near[('0x' || substr(h, 1, 8))::bigint % len(near) + 1] AS neighbor,
                  ('0x' || substr(h, 9, 8))::bigint / 4294967296.0::double AS step FROM hashed),
made AS (SELECT c.row_id || '#' || copy AS synthetic_id, c.row_id AS base, neighbor, copy, c.label,
                c.x AS x0, d.x AS x1, step FROM chosen c JOIN vectors d ON d.row_id = c.neighbor),
slots AS (SELECT unnest(range(1, {views.DIMENSIONS + 1})) AS i, * FROM made)"""


@query(
    "smote",
    f"""WITH {_SMOTE_SQL}
    SELECT synthetic_id, base, neighbor, label, CAST(i - 1 AS int) AS slot,
           {fixed_sql("x0[i] + step * (x1[i] - x0[i])", 8)} AS value FROM slots""",
)
def smote(spark, sf_dir):
    made = balance.smote(views.vectors(spark, sf_dir), "label", "row_id", "x")
    long = made.select("synthetic_id", "base", "neighbor", "label", F.posexplode("x").alias("slot", "value"))
    return fix(long, ["value"], 8)


@query(
    "class_balance_compare",
    f"""WITH {_SMOTE_SQL},
    stages AS (SELECT 'before' AS stage, label FROM vectors UNION ALL SELECT 'after', label FROM vectors
               UNION ALL SELECT 'after', label FROM made)
    SELECT stage, label, count(*) AS row_count,
           {fixed_sql("count(*) / sum(count(*)) OVER (PARTITION BY stage)", 6)} AS share
    FROM stages GROUP BY stage, label""",
)
def class_balance_compare(spark, sf_dir):
    vectors = views.vectors(spark, sf_dir)
    made = balance.smote(vectors, "label", "row_id", "x")
    after = vectors.select("label").unionByName(made.select("label"))
    return fix(prep.class_balance_compare(vectors, after, "label"), ["share"], 6)


_ADASYN = ["other_share", "weight"]
_ADASYN_SQL = f"""{views.CUSTOMERS_SQL},
sizes AS (SELECT label, count(*) AS n FROM customers GROUP BY label),
near AS (SELECT * FROM (
           SELECT a.row_id, a.label, b.label AS theirs,
                  row_number() OVER (PARTITION BY a.row_id ORDER BY list_distance(a.x, b.x), b.row_id) AS rank
           FROM customers a JOIN customers b ON a.row_id <> b.row_id) WHERE rank <= 5),
shares AS (SELECT row_id, label, count(*) FILTER (theirs <> label) / 5 AS other_share FROM near
           WHERE label IN (SELECT label FROM sizes WHERE n < (SELECT max(n) FROM sizes)) GROUP BY ALL),
weights AS (SELECT *, other_share / sum(other_share) OVER (PARTITION BY label) AS weight FROM shares)"""


@query(
    "adasyn_weights",
    f"""WITH {_ADASYN_SQL}
    SELECT row_id, label, {fixed_sql("other_share", 8)} AS other_share, {fixed_sql("weight", 8)} AS weight,
           CAST(round_even(weight * ((SELECT max(n) FROM sizes) - n), 0) AS int) AS copies
    FROM weights JOIN sizes USING (label)""",
)
def adasyn_weights(spark, sf_dir):
    return fix(balance.adasyn_weights(views.customers(spark, sf_dir), "label", "row_id", "x"), _ADASYN, 8)


@query(
    "adasyn",
    f"""WITH {_ADASYN_SQL},
    dealt AS (SELECT row_id, label, CAST(round_even(weight * ((SELECT max(n) FROM sizes) - n), 0) AS int) AS copies
              FROM weights JOIN sizes USING (label)),
    own AS (SELECT row_id, list(neighbor ORDER BY rank) AS near FROM (
              SELECT a.row_id, b.row_id AS neighbor,
                     row_number() OVER (PARTITION BY a.row_id ORDER BY list_distance(a.x, b.x), b.row_id) AS rank
              FROM customers a JOIN customers b ON a.label = b.label AND a.row_id <> b.row_id
              WHERE a.label IN (SELECT label FROM dealt)) WHERE rank <= 5 GROUP BY row_id),
    draws AS (SELECT row_id, label, near, unnest(range(1, copies + 1)) AS copy FROM dealt JOIN own USING (row_id)),
    hashed AS (SELECT *, md5('42:' || row_id || ':' || copy) AS h FROM draws),
    chosen AS (SELECT row_id AS base, label, copy, near[('0x' || substr(h, 1, 8))::bigint % len(near) + 1] AS neighbor,
                      ('0x' || substr(h, 9, 8))::bigint / 4294967296.0::double AS step FROM hashed),
    made AS (SELECT base || '#' || copy AS synthetic_id, base, neighbor, c.label, a.x AS x0, b.x AS x1, step
             FROM chosen c JOIN customers a ON a.row_id = base JOIN customers b ON b.row_id = neighbor)
    SELECT synthetic_id, base, neighbor, label, CAST(i - 1 AS int) AS slot, {fixed_sql("x0[i] + step * (x1[i] - x0[i])", 8)} AS value
    FROM (SELECT unnest(range(1, 3)) AS i, * FROM made)""",
)
def adasyn(spark, sf_dir):
    made = balance.adasyn(views.customers(spark, sf_dir), "label", "row_id", "x")
    long = made.select("synthetic_id", "base", "neighbor", "label", F.posexplode("x").alias("slot", "value"))
    return fix(long, ["value"], 8)


# --- clusters ----------------------------------------------------------------------------------

_CENTERS_SQL = f"""{views.VECTORS_SQL},
slots AS (SELECT row_id, label, x, unnest(range(1, {views.DIMENSIONS + 1})) AS i FROM vectors),
center AS (SELECT label AS cluster, i, avg(x[i]) AS c FROM slots GROUP BY ALL),
reach AS (SELECT row_id, label, cluster, sum((x[s.i] - c) * (x[s.i] - c)) AS d2
          FROM slots s JOIN center USING (i) GROUP BY ALL),
assigned AS (SELECT row_id, label, cluster, d2 AS squared_distance FROM (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d2, cluster) AS rn FROM reach) WHERE rn = 1)"""


def _assigned(spark, sf_dir):
    vectors = views.vectors(spark, sf_dir)
    return cluster.assign_to_centers(vectors, cluster.class_centers(vectors, "label", "x"), "x")


@query(
    "kmeans_assign",
    f"""WITH {_CENTERS_SQL} SELECT row_id, cluster, {fixed_sql("squared_distance", 8)} AS squared_distance
        FROM assigned""",
)
def kmeans_assign(spark, sf_dir):
    return fix(_assigned(spark, sf_dir).select("row_id", "cluster", "squared_distance"), ["squared_distance"], 8)


@query(
    "kmeans_inertia",
    f"""WITH {_CENTERS_SQL} SELECT {fixed_sql("sum(squared_distance)", 6)} AS inertia, count(*) AS row_count
        FROM assigned""",
)
def kmeans_inertia(spark, sf_dir):
    return fix(cluster.inertia(_assigned(spark, sf_dir)), ["inertia"], 6)


def _silhouette_sql(distance: str) -> str:
    return f"""{views.VECTORS_SQL},
sizes AS (SELECT label, count(*) AS n FROM vectors GROUP BY label),
sums AS (SELECT a.row_id, a.label, b.label AS other, sum({distance}) AS total FROM vectors a, vectors b GROUP BY ALL),
means AS (SELECT s.row_id, s.label, max(total / (n - 1)) FILTER (s.label = other) AS a,
                 min(total / n) FILTER (s.label <> other) AS b
          FROM sums s JOIN sizes z ON z.label = other GROUP BY ALL),
each AS (SELECT *, (b - a) / greatest(a, b) AS silhouette FROM means)"""


@query(
    "silhouette_exact",
    f"""WITH {_silhouette_sql("list_distance(a.x, b.x)")}
    SELECT row_id, label, {fixed_sql("a", 6)} AS a, {fixed_sql("b", 6)} AS b, {fixed_sql("silhouette", 6)} AS silhouette
    FROM each""",
)
def silhouette_exact(spark, sf_dir):
    each = cluster.silhouette_euclidean(views.vectors(spark, sf_dir), "row_id", "x", "label")
    return fix(each, ["a", "b", "silhouette"], 6)


@query(
    "silhouette_fast",
    f"""WITH {_silhouette_sql("pow(list_distance(a.x, b.x), 2)")}
    SELECT {fixed_sql("avg(silhouette)", 6)} AS silhouette FROM each""",
)
def silhouette_fast(spark, sf_dir):
    vectors = cluster.as_vectors(views.vectors(spark, sf_dir), "x")
    value = cluster.silhouette_squared(vectors, cluster="label")
    return spark.range(1).select(fixed(F.lit(value), 6).alias("silhouette"))


@query(
    "covariance_matrix",
    f"""WITH {views.VECTORS_SQL}, d AS (SELECT unnest(range(1, {views.DIMENSIONS + 1})) AS i)
    SELECT CAST(p.i - 1 AS int) AS i, CAST(q.i - 1 AS int) AS j, {fixed_sql("covar_pop(x[p.i], x[q.i])", 8)} AS covariance
    FROM vectors, d p, d q WHERE p.i <= q.i GROUP BY p.i, q.i""",
)
def covariance_matrix(spark, sf_dir):
    return fix(cluster.covariance_matrix(views.vectors(spark, sf_dir), "x"), ["covariance"], 8)


@query("pca_project", "SELECT vec_id AS row_id, label, true AS centred, true AS apart, true AS first_is_larger FROM embeddings")
def pca_project(spark, sf_dir):
    vectors = cluster.as_vectors(views.vectors(spark, sf_dir), "x")
    projected, shares = cluster.pca_project(vectors)
    facts = projected.agg(
        ((F.abs(F.avg("pc1")) < 1e-6) & (F.abs(F.avg("pc2")) < 1e-6)).alias("centred"),
        (F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("apart"),
        ((F.var_samp("pc1") >= F.var_samp("pc2")) & F.lit(shares[0] >= shares[1] > 0)).alias("first_is_larger"),
    )
    return projected.select("row_id", "label").crossJoin(F.broadcast(facts))


@query(
    "pca_wide",
    f"""WITH {views.VECTORS_SQL}, d AS (SELECT unnest(range(1, {views.DIMENSIONS + 1})) AS i),
    slots AS (SELECT i, var_samp(x[i]) AS v FROM vectors, d GROUP BY i)
    SELECT c.component, (SELECT count(*) FROM vectors) AS row_count,
           (SELECT {fixed_sql("sum(v)", 6)} FROM slots) AS total_variance, true AS share_is_spread, true AS share_is_exact
    FROM (SELECT unnest([1, 2, 3]) AS component) c""",
)
def pca_wide(spark, sf_dir):
    """Shares of three components against the projections' own spread and against the exact decomposition."""
    vectors = views.vectors(spark, sf_dir)
    made = wide_pca.fit(vectors, 3, "x")
    exact = cluster.pca_project(cluster.as_vectors(vectors, "x"), 3)[1]
    long = made.apply(vectors, "x").select(F.posexplode(F.array("pc1", "pc2", "pc3")).alias("at", "pc"))
    known = F.get(F.lit(made.shares), "at")
    return long.groupBy("at").agg(F.count("pc").alias("row_count"), F.var_samp("pc").alias("spread")).select(
        (F.col("at") + 1).alias("component"),
        "row_count",
        fixed(F.lit(made.variance), 6).alias("total_variance"),
        (F.abs(F.col("spread") / made.variance - known) < 1e-8).alias("share_is_spread"),
        (F.abs(known - F.get(F.lit(exact), "at")) < 1e-6).alias("share_is_exact"),
    )


@query(
    "kmeans",
    "SELECT vec_id AS row_id, label, true AS nearest_center, true AS inertia_adds_up FROM embeddings",
)
def kmeans(spark, sf_dir):
    vectors = cluster.as_vectors(views.vectors(spark, sf_dir), "x")
    made, cost, placed = cluster.kmeans(vectors, 3)
    centers = {i: [float(v) for v in c] for i, c in enumerate(made.clusterCenters())}
    again = cluster.assign_to_centers(placed, centers, "x", out="nearest")
    facts = again.agg((F.abs(F.sum("squared_distance") / F.lit(float(cost)) - 1) < 1e-3).alias("inertia_adds_up"))
    return again.select("row_id", "label", (F.col("nearest") == F.col("cluster")).alias("nearest_center")).crossJoin(
        F.broadcast(facts)
    )


@query(
    "lloyd_step",
    f"""WITH {_CENTERS_SQL}, members AS (SELECT a.cluster, a.squared_distance, v.x FROM assigned a JOIN vectors v USING (row_id)),
    cost AS (SELECT sum(squared_distance) AS inertia FROM members),
    dims AS (SELECT unnest(range(1, {views.DIMENSIONS + 1})) AS i)
    SELECT cluster, CAST(i - 1 AS int) AS dimension, count(*) AS row_count, {fixed_sql("avg(x[i])", 8)} AS center,
           (SELECT {fixed_sql("inertia", 6)} FROM cost) AS inertia
    FROM members, dims GROUP BY cluster, i""",
)
def lloyd_step(spark, sf_dir):
    """One step from the class means, beside a second run that does not change it."""
    vectors = views.vectors(spark, sf_dir)
    centers = cluster.class_centers(vectors, "label", "x")
    start = np.array(list(centers.values()))
    with dense_blocks(vectors, "x") as blocks:
        counts, sums, costs = lloyd.step(blocks, [start, start[:1]], start.mean(0))
    rows = [
        (name, d, int(n), float(total[d] / n), float(costs[0]))
        for name, n, total in zip(centers, counts[0], sums[0], strict=True)
        if n
        for d in range(len(total))
    ]
    kind = vectors.schema["label"].dataType.simpleString()
    made = spark.createDataFrame(
        rows, f"cluster {kind}, dimension int, row_count long, center double, inertia double"
    )
    return fix(fix(made, ["center"], 8), ["inertia"], 6)


@query("hierarchical_cluster", "SELECT vec_id AS row_id, label, 3::BIGINT AS clusters FROM embeddings")
def hierarchical_cluster(spark, sf_dir):
    vectors = views.vectors(spark, sf_dir)
    placed = cluster.hierarchical(vectors, 3, "x", "row_id", micro=100)
    number = placed.agg(F.count_distinct("cluster").alias("clusters"))
    return placed.select("row_id", "label").crossJoin(F.broadcast(number))


@query(
    "elbow_sweep",
    "SELECT k, true AS inertia_falls, true AS silhouette_in_bounds FROM (SELECT CAST(unnest(range(2, 9)) AS int) AS k)",
)
def elbow_sweep(spark, sf_dir):
    made = cluster.elbow_sweep(views.vectors(spark, sf_dir), range(2, 9), "x", "row_id")
    before = F.lag("inertia").over(Window.orderBy("k"))
    return made.select(
        "k",
        F.coalesce(F.col("inertia") < before * 1.02, F.lit(True)).alias("inertia_falls"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_bounds"),
    )
