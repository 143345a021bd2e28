"""Searches: draws that learn, determinism, parameters without an equivalent."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest

from tsengine.operators import parzen, search

SPACE = search.mapped(search.DEFAULT_SPACE)


def bowl(p):
    """Best near learning_rate 0.03, depth 7, share 0.7, gamma 1e-4; ``min_child_weight`` does not matter."""
    return -((math.log10(p["learning_rate"]) + 1.5) ** 2 / 4 + (p["max_depth"] - 7) ** 2 / 40
             + (p["colsample_bytree"] - 0.7) ** 2 * 6 + (math.log10(p["gamma"]) + 4) ** 2 / 20)


def run(seed, learn, trials=50):
    rng, finished = random.Random(seed), []
    for _ in range(trials):
        draw = parzen.propose(SPACE, finished, rng) if learn else parzen.draw_uniform(SPACE, rng)
        finished.append((draw, bowl(draw)))
    return finished


def test_learning_draws_beat_independent_ones():
    best = [[max(s for _, s in run(seed, learn)) for seed in range(20)] for learn in (True, False)]
    assert sum(a > b for a, b in zip(*best)) >= 17
    assert statistics.mean(best[0]) > 0.6 * statistics.mean(best[1])     # scores are negative
    late = [s for seed in range(5) for _, s in run(seed, True)[-10:]]
    early = [s for seed in range(5) for _, s in run(seed, True)[:10]]
    assert statistics.mean(late) > statistics.mean(early)


def test_draws_follow_seed_and_scores():
    assert run(3, True) == run(3, True) != run(4, True)
    finished = run(3, True, 20)
    turned = [(p, -s) for p, s in finished]
    a, b = (parzen.propose(SPACE, f, random.Random(1)) for f in (finished, turned))
    assert a != b                                                      # depends on the scores
    few = [(p, s) for p, s in finished[:parzen.START - 1]]
    assert parzen.propose(SPACE, few, random.Random(1)) == parzen.draw_uniform(SPACE, random.Random(1))


def test_draws_stay_inside_and_survive_odd_trials():
    space = {"a": ("int", 2, 3), "b": ("log", 1e-8, 1.0), "c": ("uniform", 0.2, 1.0), "d": ("uniform", 0.5, 0.5), "e": ("int", 4, 4)}
    rng, finished = random.Random(0), []
    for i in range(60):
        p = parzen.propose(space, finished, rng)
        assert p["a"] in (2, 3) and 1e-8 <= p["b"] <= 1 and 0.2 <= p["c"] <= 1 and p["d"] == 0.5 and p["e"] == 4
        finished.append((p, math.nan if i % 7 == 0 else 1.0))          # ties and failed scores
    with pytest.raises(ValueError):
        parzen.draw_uniform({"a": ("choice", 1, 2)}, rng)


def test_density_integrates_to_one():
    for points, low, high in (([], 0, 1), ([0.2, 0.2, 0.9], 0, 1), ([-3.0], -4, 9), ([0.5], 0, 1)):
        d = parzen.Density(points, low, high)
        xs = np.linspace(low, high, 20_001)
        assert np.trapezoid([math.exp(d.log_at(x)) for x in xs[::10]], xs[::10]) == pytest.approx(1, abs=1e-3)
        cells = parzen.Density([3, 3, 5], *parzen.bounds("int", 2, 9))
        assert sum(math.exp(cells.log_at(v, 0.5)) for v in range(2, 10)) == pytest.approx(1, abs=1e-9)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(a), float(b), float(2 * a - b))
            for i, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    return spark.createDataFrame(rows, "datetime timestamp, a double, b double, y_future double")


def test_search_proposes_from_its_own_trials(spark, table):
    space = {"max_depth": ("int", 1, 3), "learning_rate": ("log", 0.05, 1.0)}
    runs = [search.sampled_search(spark, table, ["a", "b"], space, n_trials=4, n_splits=2, max_iter=2, start=2,
                                  validation_fraction=None)[0].orderBy("trial", "fold").collect() for _ in range(2)]
    assert [tuple(r) for r in runs[0]] == [tuple(r) for r in runs[1]] and len(runs[0]) == 8
    # the draws recomputed from the recorded scores
    rng, finished = random.Random(42), []
    draws = [parzen.draw_uniform(space, rng) for _ in range(2)]
    for t in range(4):
        if t >= 2:
            draws.append(parzen.propose(space, finished, rng, 2))
        mine = [r for r in runs[0] if r["trial"] == t]
        assert all(r["params"] == search.effective_params(draws[t]) for r in mine)
        finished.append((draws[t], sum(r["metric"] for r in mine) / 2))


def test_parameters_without_equivalent_are_refused(spark, table):
    for space in ({"lambda": ("log", 1e-8, 1.0)}, {"max_depth": ("int", 1, 2), "alpha": ("log", 1e-8, 1.0)}):
        with pytest.raises(ValueError, match="no equivalent"):
            search.sampled_search(spark, table, ["a"], space)
    with pytest.raises(ValueError, match="no equivalent"):
        search.random_search(spark, table, ["a"], {"grow_policy": ["depthwise"]}, n_iter=1)
    assert not set(search.mapped(search.DEFAULT_GRID)) & set(search.UNMAPPED)
    for bad in ({"sampler": "grid"}, {"at_once": 0}, {"objective": "test"}):
        with pytest.raises(ValueError):
            search.sampled_search(spark, table, ["a"], **bad)


def test_searches_stop_early_by_default(spark, table):
    grid = {"max_depth": [2], "learning_rate": [1]}
    _, _, model = search.random_search(spark, table, ["a", "b"], grid, n_iter=1, n_splits=2, max_iter=30)
    _, _, whole = search.random_search(spark, table, ["a", "b"], grid, n_iter=1, n_splits=2, max_iter=30, validation_fraction=None)
    assert model.getNumTrees < whole.getNumTrees == 30
