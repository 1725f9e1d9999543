from __future__ import annotations

import random
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridia.functions.quantiles import exact_quantiles
from meridia.functions.ranks import hash_rank, running_totals
from meridia.operators import split


def test_hash_rank_matches_a_plain_sort_and_keeps_null_groups(spark):
    rows = [(i, random.Random(i).choice(["a", "b", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, g string")
    got = {r["id"]: (r["rank"], r["n"]) for r in hash_rank(df, ["g"], "id", 7, size="n").collect()}
    assert len(got) == 300
    for g in ("a", "b", None):
        ids = [i for i, h in rows if h == g]
        ids.sort(key=lambda i: md5(f"7:{i}".encode()).hexdigest())
        assert [got[i] for i in ids] == [(k + 1, len(ids)) for k in range(len(ids))]


def test_hash_rank_does_not_depend_on_partitioning(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 2)
    one = {r["id"]: r["rank"] for r in hash_rank(df.repartition(1), ["g"], "id").collect()}
    many = {r["id"]: r["rank"] for r in hash_rank(df.repartition(8), ["g"], "id").collect()}
    assert one == many


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_several_buckets(spark, descending):
    rows = [(g, float(v), (v * 7) % 5) for g in ("x", "y") for v in range(200 if g == "x" else 3)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    got = {(r["g"], r["v"]): (r["cum_n"], r["total_n"]) for r in running_totals(df, ["g"], "v", ["n"], descending, 16).collect()}
    for g in ("x", "y"):
        total, whole = 0, sum(n for h, _, n in rows if h == g)
        for _, v, n in sorted((r for r in rows if r[0] == g), reverse=descending):
            total += n
            assert got[g, v] == (total, whole)


@pytest.mark.parametrize("small", [10_000, 20])
def test_exact_quantiles_with_ties_nulls_and_narrowing(spark, small):
    rng = np.random.default_rng(1)
    a = np.where(rng.random(4000) < 0.4, 5.0, rng.normal(size=4000))
    rows = [(float(v), None if i % 7 == 0 else float(i % 11)) for i, v in enumerate(a)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    probabilities = [0.0, 0.1, 1 / 3, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, ["a", "b"], probabilities, small=small)
    b = [r[1] for r in rows if r[1] is not None]
    assert got["a"] == pytest.approx(np.quantile(a, probabilities), abs=1e-12)
    assert got["b"] == pytest.approx(np.quantile(b, probabilities), abs=1e-12)


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}


def test_split_sizes_of_the_published_table(spark):
    sizes = {"High": 526, "Low": 496, "Medium": 528}
    assert split.train_sizes(sizes) == {"High": 421, "Low": 397, "Medium": 422}
    rows = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    df = split.stratified_split(spark.createDataFrame(rows, "id string, y string"), "y", "id")
    counts = {(r["y"], r["split"]): r["count"] for r in df.groupBy("y", "split").count().collect()}
    assert counts == {
        ("High", "train"): 421, ("Low", "train"): 397, ("Medium", "train"): 422,
        ("High", "test"): 105, ("Low", "test"): 99, ("Medium", "test"): 106,
    }


@pytest.mark.parametrize("shuffle", [True, False])
def test_folds_are_even_per_class(spark, shuffle):
    rows = [(i, "a" if i % 3 else "b") for i in range(101)]
    df = split.stratified_kfold(spark.createDataFrame(rows, "id int, y string"), "y", "id", 5, shuffle=shuffle)
    folds = df.collect()
    assert len(folds) == 101
    for c in "ab":
        counts = [sum(1 for r in folds if r["y"] == c and r["fold"] == f) for f in range(5)]
        assert max(counts) - min(counts) <= 1
    if not shuffle:
        order = [r["fold"] for r in sorted(folds, key=lambda r: r["id"]) if r["y"] == "a"]
        assert order == sorted(order)


def test_learning_subsets_nest(spark):
    df = spark.createDataFrame([(i, "a" if i < 80 else "b") for i in range(100)], "id int, y string")
    points = split.learning_subsets(df, ["y"], "id", [0.1, 0.5, 1.0]).collect()
    sets = [{r["id"] for r in points if r["point"] == p} for p in range(3)]
    assert sets[0] < sets[1] < sets[2] and [len(s) for s in sets] == [10, 50, 100]
