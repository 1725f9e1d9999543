"""The histogram booster against a plain numpy one over the same bins."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from meridia.functions.blocks import dense_blocks
from meridia.operators import boosting, models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(500, 4)), 2)
    x[:, 3] = rng.integers(0, 2, 500)
    y = np.where(x[:, 0] + 0.4 * rng.normal(size=500) > 0.4, 2, np.where(x[:, 1] * (1 - 2 * x[:, 3]) > 0, 1, 0))
    data = [(i, [float(v) for v in r], float(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "row_id long, x array<double>, label_index double").repartition(3, "row_id")
    return df.withColumn("features", array_to_vector("x")).persist()


def plain(bins: np.ndarray, y: np.ndarray, k: int, rounds: int, rate: float, depth: int, least: int) -> list[float]:
    """Mean log loss before and after every round, one tree at a time by direct sums."""
    scores = np.tile(np.log(np.bincount(y, minlength=k) / len(y)), (len(y), 1))

    def loss() -> float:
        return float((np.log(np.exp(scores).sum(1)) - scores[np.arange(len(y)), y]).mean())

    def grow(rows: np.ndarray, r: np.ndarray, left: int, out: np.ndarray) -> None:
        best = (1e-12 * max(1, len(rows)), None)
        if left:
            for f in range(bins.shape[1]):
                for cut in range(bins[:, f].max() + 1):
                    side = bins[rows, f] <= cut
                    a, b = r[rows[side]], r[rows[~side]]
                    if len(a) >= least and len(b) >= least:
                        gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - r[rows].sum() ** 2 / len(rows)
                        if gain > best[0] + 1e-9:
                            best = (gain, side)
        if best[1] is None:
            up, down = r[rows].sum(), (np.abs(r[rows]) * (1 - np.abs(r[rows]))).sum()
            out[rows] = rate * (k - 1) / k * up / down
        else:
            grow(rows[best[1]], r, left - 1, out)
            grow(rows[~best[1]], r, left - 1, out)

    losses = [loss()]
    for _ in range(rounds):
        chance = np.exp(scores) / np.exp(scores).sum(1, keepdims=True)
        moves = np.zeros_like(scores)
        for c in range(k):
            grow(np.arange(len(y)), (y == c) - chance[:, c], depth, moves[:, c])
        scores += moves
        losses.append(loss())
    return losses


@pytest.mark.parametrize(("depth", "least"), [(1, 1), (3, 5)])
def test_deviance_of_every_round(rows, depth, least):
    params = {"n_estimators": 4, "max_depth": depth, "min_samples_leaf": least, "max_bins": 12, "learning_rate": 0.3}
    made, losses = boosting.SoftmaxBooster(params, 3).fit_with_progress(rows, progress=True)
    data = rows.collect()
    x = np.array([r["x"] for r in data])
    bins = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(made.edges)], axis=1)
    assert all(len(e) <= 11 for e in made.edges) and bins.max() <= 11
    y = np.array([int(r["label_index"]) for r in data])
    assert losses == pytest.approx(plain(bins, y, 3, 4, 0.3, depth, least), abs=1e-6)
    assert all(b < a for a, b in zip(losses, losses[1:]))
    # the model scores rows as the loop did
    scored = made.transform(rows).select("label_index", "probability").collect()
    again = np.mean([-np.log(r["probability"][int(r["label_index"])]) for r in scored])
    assert again == pytest.approx(losses[-1], abs=1e-9)


def test_passes_do_not_grow_with_the_classes(rows, monkeypatch):
    calls = []
    whole = boosting._Rows.histograms
    monkeypatch.setattr(boosting._Rows, "histograms", lambda self, *a: calls.append(1) or whole(self, *a))
    boosting.SoftmaxBooster({"n_estimators": 2, "max_depth": 2}, 3).fit(rows)
    assert len(calls) == 4
    many = rows.withColumn("label_index", F.col("row_id") % 9 + 0.0)
    boosting.SoftmaxBooster({"n_estimators": 2, "max_depth": 2}, 9).fit(many)
    assert len(calls) == 8


def test_a_share_of_the_rows_is_drawn_by_key(rows, monkeypatch):
    # approximate quantiles may depend on how rows are dealt; the draw must not
    monkeypatch.setattr(boosting, "bin_edges", lambda df, width, *_: [np.linspace(-2, 2, 20)] * width)
    params = {"n_estimators": 3, "max_depth": 2, "subsample": 0.5}
    one = boosting.SoftmaxBooster(params, 3).fit_with_progress(rows, progress=True)[1]
    other = boosting.SoftmaxBooster(params, 3).fit_with_progress(rows.repartition(2), progress=True)[1]
    whole = boosting.SoftmaxBooster({**params, "subsample": 1.0}, 3).fit_with_progress(rows, progress=True)[1]
    assert one == pytest.approx(other, abs=1e-9) and one != pytest.approx(whole, abs=1e-6)


def test_an_absent_class_and_a_constant_feature(spark):
    data = [(i, [1.0, float(i % 2)], float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(data, "row_id long, x array<double>, label_index double")
    df = df.withColumn("features", array_to_vector("x"))
    made = boosting.SoftmaxBooster({"n_estimators": 5}, 3).fit(df)
    assert made.transform(df).where("prediction <> label_index").count() == 0
    with pytest.raises(ValueError, match="no Spark counterpart"):
        boosting.SoftmaxBooster({"alpha": 1}, 3)
    assert models.UNLIMITED_DEPTH == 30


def test_rows_are_packed_with_a_byte_a_bin_and_rounds_count_nothing(spark, monkeypatch):
    rng = np.random.default_rng(41)
    x = np.round(rng.normal(size=(90, 3)), 1)
    made = [(Vectors.dense(r), float(i % 3), i) for i, r in enumerate(x.tolist())]
    df = spark.createDataFrame(made, ["features", "label_index", "row_id"])
    edges = [np.unique(x[:, f])[:-1] for f in range(3)]
    with dense_blocks(df, "features", ["label_index", "row_id"]) as raw:
        frame = boosting._binned(raw, edges, [0.0, 0.5, 1.0])
    for row in frame.collect():
        n, ids = row["n"], np.frombuffer(row["code1"], np.int64)
        assert row["width"] == 3 and len(row["x"]) == 8 * 3 * n and len(row["code2"]) == 3 * n + -3 * n % 8
        bins = np.frombuffer(row["code2"], np.uint8)[: 3 * n].reshape(3, n)
        assert all((bins[f] == np.searchsorted(edges[f], x[ids, f])).all() for f in range(3))
    booster = boosting.SoftmaxBooster({"n_estimators": 3, "max_depth": 2, "max_bins": 16}, 3)
    counted, whole = [], boosting.Blocks.__init__
    monkeypatch.setattr(
        boosting.Blocks, "__init__", lambda self, frame, like=None: counted.append(like is None) or whole(self, frame, like)
    )
    _, losses = booster.fit_with_progress(df, progress=True)
    # the table is counted once as it is read and once in bins
    assert sum(counted) <= 2 and losses == sorted(losses, reverse=True)
