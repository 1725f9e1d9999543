from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridia.functions import blocks
from meridia.operators import balance, cluster, neighbors


def _table(spark, x, labels=None):
    labels = labels if labels is not None else ["a"] * len(x)
    rows = [(i, [float(v) for v in r], str(c)) for i, (r, c) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, "id long, x array<double>, label string").repartition(5)


def _brute(x, k, labels=None):
    out = {}
    for i in range(len(x)):
        others = [j for j in range(len(x)) if j != i and (labels is None or labels[j] == labels[i])]
        d = {j: float(np.sqrt(((x[i] - x[j]) ** 2).sum())) for j in others}
        out[i] = sorted(d, key=lambda j: (d[j], j))[:k]
    return out


def _got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], {})[r["rank"]] = r["neighbor"]
    return {i: [n[k] for k in sorted(n)] for i, n in out.items()}


@pytest.mark.parametrize("block_rows, pivots", [(1000, 1), (16, 9)])
def test_knn_is_exact_with_a_third_of_all_rows_alike(spark, block_rows, pivots):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(150, 2)), 1)
    x[::3] = [0.3, 0.3]
    got = _got(neighbors.knn_join(_table(spark, x), "id", "x", 4, block_rows=block_rows, pivots=pivots))
    assert got == _brute(x, 4)


def test_knn_within_groups(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 3))
    labels = ["a" if i % 3 else "b" for i in range(120)]
    got = _got(neighbors.knn_join(_table(spark, x, labels), "id", "x", 3, group="label", block_rows=20, pivots=5))
    assert got == _brute(x, 3, labels)


def test_far_cells_do_not_meet(spark):
    x = np.concatenate([np.random.default_rng(i).normal(100 * i, 1, size=(40, 2)) for i in range(4)])
    df = _table(spark, x)
    sites = neighbors.merge_copies(df.withColumn("g", F.lit(0)), "id", "x", "g", 4)
    pivots = np.array([[100.0 * i, 100.0 * i] for i in range(4)])
    placed = neighbors._nearest_pivot(sites, pivots)
    plan = neighbors._meeting_plan(placed, placed, pivots, 3, 1000)
    assert all([c for c, _, _ in cells] == [q] for (_, q), (_, cells) in plan.items())


def test_fewer_points_than_neighbours(spark):
    x = np.array([[0.0], [1.0], [3.0]])
    assert _got(neighbors.knn_join(_table(spark, x), "id", "x", 5)) == {0: [1, 2], 1: [0, 2], 2: [1, 0]}


def test_text_groups_with_meetings_that_one_side_misses(spark):
    rng = np.random.default_rng(21)
    x = np.round(rng.normal(size=(240, 2)), 2)
    labels = ["many" if i % 4 else "few" for i in range(240)]
    got = _got(neighbors.knn_join(_table(spark, x, labels), "id", "x", 3, group="label", block_rows=3, pivots=30))
    assert got == _brute(x, 3, labels)


def test_wide_vectors_far_from_zero_with_copies(spark):
    rng = np.random.default_rng(22)
    x = np.round(rng.normal(size=(200, 16)), 1) + 1e6
    x[::10] = x[0]
    x[1::20] = x[0] + 0.5
    asked = np.flatnonzero(np.arange(200) % 3 == 0)
    df = _table(spark, x)
    got = _got(neighbors.knn_join(df, "id", "x", 4, block_rows=20, pivots=12))
    assert got == _brute(x, 4)
    some = df.where("id % 3 = 0")
    got = _got(neighbors.knn_join(df, "id", "x", 4, queries=some, block_rows=20, pivots=12))
    assert got == {i: n for i, n in _brute(x, 4).items() if i in asked}


def test_cells_meet_in_bundles(spark):
    pivots = np.random.default_rng(23).normal(size=(40, 16))
    sizes = {"a": {c: 100 for c in range(40)}, "b": {0: 2500, 1: 10}}
    plan = {
        (g, q): (1, [(c, -1.0 - q, 1) for c in cells]) for g, cells in sizes.items() for q in cells
    }
    queries, points, meetings = neighbors._meeting_tables(plan, sizes, sizes, pivots, 1000)
    assert meetings <= 5 * 5 + 4 * 4
    homes = {(g, c): h for g, c, h, _ in points}
    assert len(homes["b", 0]) == 3 and all(len(h) == 1 for at, h in homes.items() if at != ("b", 0))
    for g, bundles in (("a", 5), ("b", 4)):
        assert len({b for (of, _), h in homes.items() if of == g for b in h}) <= bundles
        # every pair of cells has a meeting, from the least radius that a cell of the bundle asks for
        theirs = {q: h for of, q, h, _ in queries if of == g}
        for of, c, _, goes in points:
            if of == g:
                assert dict(goes) == {b: min(-1.0 - q for q, h in theirs.items() if b in h) for h in theirs.values() for b in h}
        for of, q, _, goes in queries:
            if of == g:
                assert set(goes) == {b for c in sizes[g] for b in homes[g, c]}


def test_a_point_is_sent_to_a_fixed_number_of_tasks_however_many_points_there_are():
    for rows in (10**5, 10**6, 9 * 10**6):
        held = neighbors.held_rows(rows, 64, 1024)
        assert rows / held <= neighbors.STREAMS and 8 * 64 * held <= neighbors.HELD_BYTES
    pivots = np.random.default_rng(25).normal(size=(100, 64))
    sizes = {0: {c: 30_000 for c in range(100)}}
    plan = {(0, q): (1, [(c, 0.0, 1) for c in range(100)]) for q in range(100)}
    _, points, _ = neighbors._meeting_tables(plan, sizes, sizes, pivots, neighbors.held_rows(3_000_000, 64, 1024))
    assert max(len(goes) for _, _, _, goes in points) <= 2 * neighbors.STREAMS


def test_points_that_stream_past_leave_the_nearest_of_every_query(spark):
    """Many batches, equal distances (the smaller id wins), text ids, and vectors that need double precision."""
    rng = np.random.default_rng(26)
    corners = np.array([[float(i >> b & 1) for b in range(10)] for i in range(256)])
    fine = 1e3 + rng.normal(size=(256, 12)) * 1e-7
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for x in (corners, fine):
            df = _table(spark, x).withColumn("id", F.format_string("%03d", "id"))
            got = _got(neighbors.knn_join(df, "id", "x", 5, block_rows=64))
            assert {int(i): [int(n) for n in near] for i, near in got.items()} == _brute(x, 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_groups_share_the_pivots_by_the_largest_of_them(spark, monkeypatch):
    rng = np.random.default_rng(24)
    labels = [str(i % 5) for i in range(200)]
    seen = []
    place = neighbors._nearest_pivot
    monkeypatch.setattr(neighbors, "_nearest_pivot", lambda df, pivots: seen.append(len(pivots)) or place(df, pivots))
    x = rng.normal(size=(200, 3))
    got = _got(neighbors.knn_join(_table(spark, x, labels), "id", "x", 3, group="label", block_rows=20))
    assert got == _brute(x, 3, labels) and seen == [2]


def test_smote_fills_every_class_on_segments(spark):
    rng = np.random.default_rng(7)
    labels = ["a"] * 40 + ["b"] * 13 + ["c"] * 8
    x = rng.normal(size=(61, 3))
    made = balance.smote(_table(spark, x, labels), "label", "id", "x").collect()
    counts = {c: sum(1 for r in made if r["label"] == c) for c in "abc"}
    assert counts == {"a": 0, "b": 27, "c": 32}
    near = _brute(x, 5, labels)
    for r in made:
        assert r["neighbor"] in near[r["base"]]
        a, b = x[r["base"]], x[r["neighbor"]]
        t = np.dot(np.array(r["x"]) - a, b - a) / np.dot(b - a, b - a)
        assert 0 <= t < 1 and np.allclose(r["x"], a + t * (b - a))
    assert len({r["synthetic_id"] for r in made}) == len(made)


def test_smote_needs_a_neighbour(spark):
    with pytest.raises(ValueError, match="single row"):
        balance.smote(_table(spark, np.eye(4), ["a", "a", "a", "b"]), "label", "id", "x")


@pytest.mark.parametrize(
    "sizes, strategy",
    [((421, 397, 422), balance.SKIPPED), ((50, 50, 5), "ADASYN"), ((100, 100, 10), "SMOTE")],
)
def test_balance_rule(spark, sizes, strategy):
    rows = [(c,) for c, n in zip("xyz", sizes) for _ in range(n)]
    assert balance.balance_decision(spark.createDataFrame(rows, "y string"), "y").first()["strategy"] == strategy


def test_balance_adds_rows_near_the_other_class(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (60, 2)), rng.normal(0.5, 1, (5, 2))])
    rows, strategy = balance.balance(_table(spark, x, ["a"] * 60 + ["b"] * 5), "label", "id", "x")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    assert strategy == "ADASYN" and counts["a"] == 60 and 50 <= counts["b"] <= 65


def test_silhouettes_against_brute_force_with_copies_and_a_lone_row(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(60, 2)), 1)
    x[:20] = x[0]
    labels = np.array(["a"] * 30 + ["b"] * 29 + ["c"])
    df = _table(spark, x, labels)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))

    def expected(dist):
        out = []
        for i in range(60):
            own = (labels == labels[i]).sum() - 1
            if own == 0:
                out.append(0.0)
                continue
            a = dist[i][labels == labels[i]].sum() / own
            b = min(dist[i][labels == c].mean() for c in set(labels) - {labels[i]})
            out.append((b - a) / max(a, b))
        return out

    got = {r["id"]: r["silhouette"] for r in cluster.silhouette_euclidean(df, "id", "x", "label", block_rows=10).collect()}
    assert [got[i] for i in range(60)] == pytest.approx(expected(d))
    codes = cluster.as_vectors(df, "x").withColumn("cluster", F.ascii("label"))
    assert cluster.silhouette_squared(codes) == pytest.approx(np.mean(expected(d**2)))


def test_silhouette_of_wide_rows_far_from_zero_in_blocks_that_one_side_misses(spark):
    rng = np.random.default_rng(25)
    x = rng.normal(size=(60, 12)) * np.repeat([1e-3, 1.0], 30)[:, None] + np.repeat([1e4, 1e4 + 3], 30)[:, None]
    x[5] = x[4]
    labels = np.array(["a", "b"]).repeat(30)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for rows in (1, 8, 100):
        made = cluster.silhouette_euclidean(_table(spark, x, labels), "id", "x", "label", block_rows=rows).collect()
        assert len(made) == 60
        for r in made:
            same = labels == labels[r["id"]]
            assert r["a"] == pytest.approx(d[r["id"]][same].sum() / 29, rel=1e-9)
            assert r["b"] == pytest.approx(d[r["id"]][~same].mean(), rel=1e-9)


def test_distances_that_cancel_are_taken_from_differences():
    rng = np.random.default_rng(26)
    a = rng.normal(size=(50, 20))
    b = np.concatenate([a[:3] + 1e-9, rng.normal(size=(70, 20))])
    assert cluster._distances(a, b) == pytest.approx(np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2)), rel=1e-9)


def test_a_pass_over_blocks_returns_its_numbers_once(spark, monkeypatch):
    x = np.random.default_rng(27).normal(size=(90, 3))
    got, received = {}, []
    with blocks.dense_blocks(_table(spark, x), "x") as packed:
        assert packed.blocks > 2
        collect = type(packed.frame).collect
        monkeypatch.setattr(type(packed.frame), "collect", lambda df: received.append(collect(df)) or received[-1])
        for most in (1 << 18, 0):
            monkeypatch.setattr(blocks, "DIRECT_BYTES", most)
            got[most] = packed.sums(lambda block: block.x.sum(0), 3)
    assert got[0].tolist() == got[1 << 18].tolist() and got[0] == pytest.approx(x.sum(0))
    assert [len(r) for r in received] == [packed.blocks, 1]


def test_ward_on_few_rows_and_on_micro_clusters(spark):
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(c, 0.2, (30, 2)) for c in (0, 5, 10)])
    df = _table(spark, x)
    for micro in (200, 20):
        rows = cluster.hierarchical(df, 3, "x", "id", micro=micro).collect()
        groups = [{r["cluster"] for r in rows if r["id"] // 30 == i} for i in range(3)]
        assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3


def test_pca_signs_and_shares(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(80, 3)) * [5, 2, 0.1] + [100, 0, 0]
    projected, shares = cluster.pca_project(cluster.as_vectors(_table(spark, x), "x"))
    centred = x - x.mean(axis=0)
    s = np.linalg.svd(centred, compute_uv=False) ** 2
    assert shares == pytest.approx(list(s[:2] / s.sum()))
    got = {r["id"]: r["pc1"] for r in projected.collect()}
    assert np.corrcoef([got[i] for i in range(80)], centred[:, 0])[0, 1] > 0.99


def test_adasyn_weights_search_the_neighbours_once(spark):
    rows = [(i, [float(i % 7), float(i % 5)], "few" if i % 4 == 0 else "many") for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, x array<double>, label string")
    made = balance.adasyn_weights(df, "label", "row_id", "x")
    assert "FlatMapCoGroups" not in made._jdf.queryExecution().analyzed().toString()
    assert made.count() == 15 and made.agg(F.sum("weight")).first()[0] == pytest.approx(1)
