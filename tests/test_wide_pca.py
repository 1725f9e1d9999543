from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from meridia.operators import wide_pca


def _exact(x, k):
    values, vectors = np.linalg.eigh(np.cov(x.T))
    return (values[::-1] / values.sum())[:k], vectors[:, ::-1][:, :k]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 24)) * np.linspace(3, 0.5, 24) + 50
    x[rng.random(x.shape) < 0.3] = 0
    return x, spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")


def test_shares_and_scores_equal_the_exact_ones(data):
    x, df = data
    made = wide_pca.fit(df.repartition(3), 3, "x")
    shares, vectors = _exact(x, 3)
    assert made.settled and made.shares == pytest.approx(shares, abs=1e-6)
    assert made.variance == pytest.approx(np.cov(x.T).trace())
    got = np.array([[r["pc1"], r["pc2"], r["pc3"]] for r in made.apply(df, "x").orderBy("id").collect()])
    want = (x - x.mean(0)) @ vectors
    for j in range(3):
        assert abs(np.corrcoef(got[:, j], want[:, j])[0, 1]) > 1 - 1e-5
        assert np.abs(made.components[:, j]).max() == pytest.approx(made.components[:, j].max())


def test_totals_added_up_by_spark_are_the_same(data, monkeypatch):
    _, df = data
    before = wide_pca.fit(df, 2, "x")
    monkeypatch.setattr(wide_pca, "DRIVER_BYTES", 0)
    assert wide_pca.fit(df, 2, "x").shares == pytest.approx(before.shares, abs=1e-9)


def test_a_hundred_thousand_slots(spark):
    rng = np.random.default_rng(9)
    width, levels = 100_000, 4
    rows = []
    for i in range(400):
        # one of a few frequent slots decides which of two far slots is set as well
        kind = int(rng.integers(levels))
        slots = {kind: 1.0, 50_000 + kind % 2: 2.0, int(rng.integers(60_000, width)): 1.0}
        rows.append((i, Vectors.sparse(width, slots)))
    df = spark.createDataFrame(rows, ["id", "features"])
    made = wide_pca.fit(df, 1)
    x = np.array([[v[j] for j in [0, 1, 2, 3, 50_000, 50_001]] for _, v in rows])
    found = np.abs(made.components[:, 0])
    assert set(np.argsort(found)[-2:]) == {50_000, 50_001}
    assert made.shares[0] * made.variance == pytest.approx(_exact(x, 1)[0][0] * np.cov(x.T).trace(), rel=0.02)


def test_nulls_empty_and_equal_rows(spark, data):
    _, df = data
    made = wide_pca.fit(df, 2, "x")
    odd = df.unionAll(spark.createDataFrame([(-1, None)], df.schema))
    assert wide_pca.fit(odd, 2, "x").shares == pytest.approx(made.shares, abs=1e-9)
    assert made.apply(odd, "x").where("id = -1").first()["pc1"] is None
    zero = spark.createDataFrame([(0, [0.0] * 24)], df.schema)
    assert made.apply(zero, "x").first()["pc1"] == pytest.approx(-(made.mean @ made.components)[0])
    for bad in (df.where("false"), df.where("id = 3"), df.where("id = 3").select(F.explode(F.array(F.lit(1), F.lit(2))).alias("id"), "x")):
        with pytest.raises(ValueError):
            wide_pca.fit(bad, 2, "x")
