"""Likelihoods, their derivatives, and fits."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from patronlens.functions.special import log_gamma, polygamma
from patronlens.plans import clv_forecast as clv
from patronlens.plans import fitting


def histories(seed=2, n=400):
    rng = np.random.default_rng(seed)
    t = rng.uniform(5, 60, n)
    x = rng.integers(0, 9, n).astype(float)
    tx = np.where(x > 0, t * rng.uniform(0, 1, n), 0.0)
    return {"x": x, "tx": tx, "t": t, "m": rng.uniform(1, 90, n), "w": rng.integers(1, 4, n).astype(float)}


def test_polygamma_against_known_values_and_slopes():
    first, second = polygamma([1.0, 0.5, 2.0, 1e7])
    euler = 0.5772156649015329
    assert first[:3] == pytest.approx([-euler, -euler - 2 * math.log(2), 1 - euler], abs=1e-12)
    assert second[:3] == pytest.approx([math.pi**2 / 6, math.pi**2 / 2, math.pi**2 / 6 - 1], abs=1e-11)
    assert first[3] == pytest.approx(math.log(1e7) - 0.5e-7, rel=1e-14)
    x = np.array([0.01, 0.3, 4.0, 77.0, 5000.0])
    h = 1e-4 * x
    assert polygamma(x)[0] == pytest.approx((log_gamma(x + h) - log_gamma(x - h)) / (2 * h), rel=1e-6)
    assert polygamma(x)[1] == pytest.approx((polygamma(x + h)[0] - polygamma(x - h)[0]) / (2 * h), rel=1e-6)


@pytest.mark.parametrize(
    "model, params",
    [(clv.bgnbd_model, (0.7, 4.0, 0.4, 2.0)), (clv.bgnbd_model, (6.0, 200.0, 1e-4, 0.2)), (clv.gamma_gamma_model, (3.0, 0.6, 4.0))],
)
def test_derivatives_are_those_of_the_likelihood(model, params):
    data = histories()
    if model is clv.gamma_gamma_model:
        data["x"] = data["x"] + 1
    params = np.array(params)
    _, slope, bend = model(params, data)
    for i in range(len(params)):
        h = np.eye(len(params))[i] * params[i] * 1e-5
        up, down = model(params + h, data), model(params - h, data)
        assert slope[i] == pytest.approx((up[0] - down[0]) / (2 * h[i]), rel=1e-4, abs=1e-5)
        assert bend[:, i] == pytest.approx((up[1] - down[1]) / (2 * h[i]), rel=1e-4, abs=1e-5)


def test_sums_of_several_vectors_over_partitions(spark):
    data = histories()
    table = spark.createDataFrame(pd.DataFrame(data)).repartition(5).select("x", "tx", "t", "w")
    vectors = [np.array(v) for v in ((0.7, 4.0, 0.4, 2.0), (2.0, 9.0, 0.1, 1.0))]
    for v, (value, slope, bend) in zip(vectors, fitting.likelihood_sums(table, clv.bgnbd_model, vectors)):
        each = clv.bgnbd_model(v, data)
        assert value == pytest.approx((each[0] * data["w"]).sum())
        assert slope == pytest.approx((each[1] * data["w"]).sum(axis=-1))
        assert bend == pytest.approx((each[2] * data["w"]).sum(axis=-1))


def test_a_fit_ends_where_the_gradient_is_nought_in_few_passes(spark):
    rng = np.random.default_rng(5)
    n, p, q, v = 3000, 6.0, 4.0, 15.0
    nu, x = rng.gamma(q, 1 / v, n), rng.integers(1, 9, n)
    table = spark.createDataFrame(pd.DataFrame({"frequency": x, "monetary_avg": rng.gamma(p * x, 1 / (nu * x))}))
    found = fitting.fit(clv.spend_histories(table), clv.gamma_gamma_model, clv.SPEND_STARTS)
    assert found.passes < 10 and found.limits == ()
    report = clv.likelihood_report(clv.GammaGamma(*map(float, found.params)), table).collect()
    assert [r.parameter for r in report] == ["p", "q", "v"]
    assert max(abs(r.gradient) for r in report) < 1e-5
    assert report[0].log_likelihood == pytest.approx(-found.objective)


def falling(rising: bool):
    """A model that grows without end with its first parameter, or is best at 1, and falls with the second."""

    def model(params, data):
        a, b = params
        zero = np.zeros_like(data["x"])
        cost = 0.0 if rising else 1.0
        bend = np.zeros((2, 2, len(zero)))
        bend[0, 0] = -1 / a**2
        return np.log(a) - cost * a - b + zero, np.stack([zero + 1 / a - cost, zero - 1.0]), bend

    return model


def test_bounds_are_errors_unless_they_are_limits_of_the_model(spark):
    table = spark.createDataFrame([(1.0, 1.0)] * 3, "x double, w double")
    with pytest.raises(RuntimeError, match="went to a bound"):
        fitting.fit(table, falling(True), [(1.0, 1.0)], vanishing=[1])
    with pytest.raises(RuntimeError, match="went to a bound"):
        fitting.fit(table, falling(False), [(2.0, 1.0)], tolerance=1e-9)
    found = fitting.fit(table, falling(False), [(2.0, 1.0)], tolerance=1e-9, vanishing=[1])
    assert found.limits == (1,) and found.params[0] == pytest.approx(1.0, rel=1e-6)


def test_nothing_to_fit(spark):
    none = spark.createDataFrame([], "frequency double, monetary_avg double")
    with pytest.raises(ValueError, match="nothing to fit"):
        clv.fit_gamma_gamma(none)
    with pytest.raises(ValueError, match="no customers"):
        clv.likelihood_report(clv.GammaGamma(1.0, 1.0, 1.0), none)
