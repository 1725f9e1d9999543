"""Registered queries hand their operators whole jobs: defaults or the fixed values of the plans."""

from __future__ import annotations

import inspect
from types import SimpleNamespace

import pytest

from meridia.operators import cluster, curves, models, search
from meridia.plans import study
from workload import catalog, modelling, registry, views


class Called(Exception):
    pass


def call_of(monkeypatch, query, owner, name):
    """Arguments with which a query calls an operator, and those it would have by default."""
    signature = inspect.signature(getattr(owner, name))

    def stop(*args, **kwargs):
        raise Called(signature.bind(*args, **kwargs).arguments)

    stub = SimpleNamespace(train=None, test=None, names=[])
    monkeypatch.setattr(registry, "ship", lambda spark: None)
    monkeypatch.setattr(modelling, "_dataset", lambda *args, **kwargs: stub)
    monkeypatch.setattr(views, "vectors", lambda *args: None)
    monkeypatch.setattr(cluster, "as_vectors", lambda *args: None)
    monkeypatch.setattr(owner, name, stop)
    with pytest.raises(Called) as caught:
        catalog.QUERIES[query](None, "")
    return caught.value.args[0]


@pytest.mark.parametrize("query", sorted(q for q in catalog.QUERIES if q.startswith("fit_")))
def test_fits_take_default_parameters(monkeypatch, query):
    assert not call_of(monkeypatch, query, models, "fit").get("params")


def test_platt_scaling_takes_default_parameters(monkeypatch):
    assert not call_of(monkeypatch, "platt_scaling", models, "platt_scaling")["params"]


@pytest.mark.parametrize(
    ("query", "owner", "operator"),
    [("mlp_loss_curve", curves, "network_progress"), ("kmeans", cluster, "kmeans"), ("elbow_sweep", cluster, "elbow_sweep")],
)
def test_iterations_and_starts_are_the_defaults(monkeypatch, query, owner, operator):
    given = call_of(monkeypatch, query, owner, operator)
    assert not set(given) & {"hidden", "step", "max_iter", "patience", "starts"}


def test_earlier_booster_is_fitted_again(monkeypatch):
    monkeypatch.setattr(models, "fit", lambda *args, **kwargs: None)
    given = call_of(monkeypatch, "retrain_compare", study, "retrain_compare")
    assert given["first"] == (models.BOOSTING, study.EARLIER_BOOSTER)


def test_random_search_tries_every_candidate_that_is_drawn(monkeypatch):
    given = call_of(monkeypatch, "random_search", search, "search")
    assert given["candidates"] == search.draw(search.RANDOM_PRESET[models.FOREST])
    assert len(given["candidates"]) == search.N_ITER and not given.get("fixed")
