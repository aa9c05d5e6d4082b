"""Purchase histories, model formulas and fits."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.parameters import BG, GG, PARETO
from clientele.config import horizon
from clientele.functions import jets
from clientele.functions.special import gammaln, hyp2f1_one, hyp2f1_tail
from clientele.operators import rfm
from clientele.operators.bgnbd import BgNbd
from clientele.operators.fitting import (
    Likelihood, fit, fit_bgnbd, fit_gamma_gamma, likelihoods, purchase_model, sufficient_rows)
from clientele.operators.gammagamma import GammaGamma
from clientele.operators.pareto import ParetoNbd
from clientele.operators.scoring import discounted_purchases, lifetime_value, predict


def _train(spark, data):
    return spark.createDataFrame([(u, dt.date.fromisoformat(d), v) for u, d, v in data],
                                 "userId string, order_date date, order_value double")


def _one(df, *columns):
    return df.select(*columns).first()


def test_known_history(spark):
    train = _train(spark, [("a", "2020-01-10", 5.0), ("a", "2020-01-20", 6.0), ("a", "2020-03-02", 7.5)])
    row = rfm.rfm_summary(train, "M").first()
    span = 60 / 30.436875
    assert tuple(row) == ("a", 1.0, pytest.approx(span), pytest.approx(span), 7.5)


def test_one_period_is_no_repeat(spark):
    train = _train(spark, [("a", "2020-01-10", 5.0), ("a", "2020-01-20", 6.0), ("b", "2020-02-01", 1.0)])
    summary = rfm.rfm_summary(train, "M")
    assert {r["userId"]: r["monetary_value"] for r in summary.collect()} == {"a": 0.0, "b": 0.0}
    assert rfm.repeat_buyers(summary).isEmpty()


def test_weeks_start_on_monday(spark):
    train = _train(spark, [("a", "2024-01-07", 5.0), ("a", "2024-01-08", 6.0), ("a", "2024-01-14", 2.0)])
    assert tuple(rfm.rfm_summary(train, "W").first())[1:] == (1.0, 1.0, 1.0, 8.0)


def test_observation_end(spark):
    train = _train(spark, [("a", "2020-01-10", 5.0), ("a", "2020-03-02", 7.5), ("a", "2020-05-01", 1.0)])
    row = rfm.rfm_summary(train, "M", dt.date(2020, 4, 30), unit="calendar").first()
    assert tuple(row) == ("a", 1.0, 2.0, 3.0, 7.5)


def test_horizon():
    assert [horizon(f, 6) for f in ("M", "D", "w")] == [6.0, 180.0, pytest.approx(26.07)]
    with pytest.raises(ValueError):
        horizon("Q", 6)
    with pytest.raises(ValueError):
        purchase_model("ARIMA")


@pytest.fixture(scope="module")
def customer(spark):
    return spark.createDataFrame(
        [("a", 2.0, 30.43, 38.86, 50.0), ("b", 0.0, 0.0, 38.86, 0.0), ("c", 1.0, 38.86, 38.86, 10.0)],
        "userId string, frequency double, recency double, T double, monetary_value double")


def test_golden_values(customer):
    a = customer.where("userId = 'a'")
    assert _one(a, BG.p_alive())[0] == pytest.approx(0.726579, abs=1e-6)
    assert _one(a, BG.expected_purchases(39.0))[0] == pytest.approx(1.226028, abs=1e-6)
    assert _one(a, PARETO.p_alive())[0] == pytest.approx(0.869168, abs=1e-6)
    assert _one(a, PARETO.expected_purchases(39.0))[0] == pytest.approx(1.455123, abs=1e-6)
    means = {r[0]: r[1] for r in
             customer.select("userId", GG.expected_average_value()).collect()}
    assert means == {"a": pytest.approx(47.34252, abs=1e-5), "b": pytest.approx(35.21898, abs=1e-5),
                     "c": pytest.approx(17.68632, abs=1e-5)}


@pytest.mark.parametrize("model", [BG, PARETO, BgNbd(0.5, 3.0, 1.0, 2.0), ParetoNbd(0.5, 20.0, 1.0, 5.0)])
def test_limits(customer, model):
    grown = customer.select(model.expected_purchases(0.0), model.expected_purchases(5.0),
                            model.expected_purchases(50.0)).collect()
    for none, some, more in grown:
        assert none == pytest.approx(0.0, abs=1e-12) and 0 < some < more
    alive = {r[0]: r[1] for r in customer.select("userId", model.p_alive()).collect()}
    assert all(0 < p <= 1 for p in alive.values())
    if isinstance(model, BgNbd):
        assert alive["b"] == 1.0
    else:
        assert alive["c"] == pytest.approx(1.0)


@pytest.mark.parametrize("near, at", [
    (BgNbd(0.5, 3.0, 1.0 + 1e-7, 2.0), BgNbd(0.5, 3.0, 1.0, 2.0)),
    (ParetoNbd(0.5, 20.0, 1.0 + 1e-7, 5.0), ParetoNbd(0.5, 20.0, 1.0, 5.0)),
    (ParetoNbd(0.5, 5.0, 0.7, 5.0 + 1e-7), ParetoNbd(0.5, 5.0 + 1e-7, 0.7, 5.0))])
def test_continuous_at_special_parameters(customer, near, at):
    for one, other in customer.select(near.expected_purchases(9.0), at.expected_purchases(9.0)).collect():
        assert one == pytest.approx(other, rel=1e-5)


def test_undiscounted_month_is_value_times_purchases(customer):
    left = customer.select(lifetime_value(BG, GG, 1, 0.0)).collect()
    right = customer.select(GG.expected_average_value() * BG.expected_purchases(1.0)).collect()
    assert [r[0] for r in left] == pytest.approx([r[0] for r in right])


def test_discounting_by_parts(customer):
    total = _one(customer, discounted_purchases(BG, 3, 0.05))[0]
    e = _one(customer, *[BG.expected_purchases(float(i)) for i in range(4)])
    assert total == pytest.approx(sum((e[i] - e[i - 1]) / 1.05 ** i for i in (1, 2, 3)))


def test_prediction_columns(customer):
    scored = predict(customer.withColumn("current_total_revenue", F.lit(100.005)), BG, GG,
                     transactions=True)
    assert scored.columns == ["userId", "clv", "churn_probability", "predicted_value_next_6_month",
                              "current_total_revenue", "predicted_transactions_next_6_month"]
    row = scored.where("userId = 'a'").first()
    assert row["churn_probability"] == 0.2734
    assert row["clv"] == pytest.approx(100.005 + row["predicted_value_next_6_month"], abs=0.011)


def test_gammaln(spark):
    points = [1e-6, 0.01, 0.5, 1.0, 3.7, 40.0, 1e4]
    df = spark.createDataFrame([(p,) for p in points], "z double")
    ours = [r[0] for r in df.select(gammaln(F.col("z"))).collect()]
    assert ours == pytest.approx([math.lgamma(p) for p in points], rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("b, c, z", [(1.6, 3.1, 0.9), (5.5, 8.2, 0.98), (0.3, 1.2, 0.5), (3.0, 4.0, 0.0)])
def test_hypergeometric(b, c, z):
    term = total = 1.0
    for n in range(5000):
        term *= (b + n) / (c + n) * z
        total += term
    assert hyp2f1_one(np.array([b]), np.array([c]), np.array([z]))[0] == pytest.approx(total)
    # With lower parameter 1 the tail is the same sum without its first term.
    assert hyp2f1_tail(b, 1.0, np.array([c]), np.array([z]))[0] == pytest.approx(total - 1.0)


def _panel(spark, n, seed=3):
    """Simulated BG/NBD histories with Gamma-Gamma values, from known parameters."""
    truth, value = BgNbd(0.8, 6.0, 0.9, 2.5), GammaGamma(6.0, 4.0, 15.0)
    rng = np.random.default_rng(seed)
    rate, drop = rng.gamma(truth.r, 1 / truth.alpha, n), rng.beta(truth.a, truth.b, n)
    scale, data = rng.gamma(value.q, 1 / value.v, n), []
    for i in range(n):
        age = float(rng.integers(20, 40))
        t, x, last = 0.0, 0, 0.0
        while True:
            t += rng.exponential(1 / rate[i])
            if t > age:
                break
            x, last = x + 1, t
            if rng.random() < drop[i]:
                break
        mean = float(rng.gamma(value.p * max(x, 1), 1 / (scale[i] * max(x, 1))))
        data.append((float(x), last, age, mean))
    return truth, value, spark.createDataFrame(
        data, "frequency double, recency double, T double, monetary_value double").cache()


def test_parameters_are_recovered(spark):
    truth, value, panel = _panel(spark, 4000)
    found = fit_bgnbd(panel)
    assert found.converged and found.n_customers == 4000
    rows = sufficient_rows(panel, BgNbd)
    assert found.log_likelihood >= likelihoods(rows, BgNbd, [vars(truth)])[0]
    assert found.model.r == pytest.approx(truth.r, rel=0.2)
    assert found.model.alpha == pytest.approx(truth.alpha, rel=0.2)
    assert found.model.a / (found.model.a + found.model.b) == pytest.approx(0.9 / 3.4, rel=0.25)
    # The time scale moves the search, not the result.
    plain = fit(BgNbd, panel, time_scale=None)
    assert list(vars(plain.model).values()) == pytest.approx(list(vars(found.model).values()), rel=1e-2)
    worth = fit_gamma_gamma(panel.where("frequency > 0"))
    assert worth.converged
    assert worth.model.p * worth.model.v / (worth.model.q - 1) == pytest.approx(30.0, rel=0.1)


def test_pareto_fit_and_penalty(spark):
    _, _, panel = _panel(spark, 1500, seed=5)
    loose, tight = (fit(ParetoNbd, panel, penalizer) for penalizer in (0.0, 0.1))
    assert loose.log_likelihood > tight.log_likelihood
    assert math.isfinite(tight.log_likelihood)


def test_equal_histories_are_weighted(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0)] * 3 + [(2.0, 3.0, 6.0)],
                               "frequency double, recency double, T double")
    grouped = likelihoods(sufficient_rows(df, BgNbd), BgNbd, [vars(BG)])[0]
    assert grouped == pytest.approx(likelihoods(df.withColumn("weight", F.lit(1)), BgNbd, [vars(BG)])[0])


def test_nothing_to_fit(spark):
    with pytest.raises(ValueError):
        fit_bgnbd(spark.createDataFrame([], "frequency double, recency double, T double"))


@pytest.mark.parametrize("z", [0.9, 0.9999, 0.999999])
def test_hypergeometric_tail_close_to_one(z):
    """Against the defining series, summed until nothing is left to add."""
    upper, lower, c = 2.976, -0.207, 4.219
    term = upper / c * z
    terms, n = [term], 1
    while abs(term) > 1e-19:
        term *= (upper + n) * (lower + n) / (n + 1.0) / (c + n) * z
        terms.append(term)
        n += 1
    assert hyp2f1_tail(upper, lower, np.array([c]), np.array([z]))[0] == pytest.approx(math.fsum(terms), rel=1e-12)


def test_hypergeometric_values_do_not_depend_on_their_neighbours():
    c, z = np.array([2.2, 3.0, 50.0, 900.0]), np.array([0.1, 0.6, 0.9999, 0.99])
    alone = [hyp2f1_tail(3.0, -0.2, c[i:i + 1], z[i:i + 1])[0] for i in range(4)]
    assert hyp2f1_tail(3.0, -0.2, c, z).tolist() == alone
    alone = [hyp2f1_one(c[i:i + 1] / 2, c[i:i + 1], z[i:i + 1])[0] for i in range(4)]
    assert hyp2f1_one(c / 2, c, z).tolist() == alone


def test_hypergeometric_fraction_says_when_it_cannot_reach_its_tolerance():
    with pytest.raises(ArithmeticError):
        hyp2f1_one(np.array([1.5]), np.array([2.5]), np.array([1.0 - 1e-16]))


def test_gammaln_derivatives():
    z = np.array([0.02, 0.5, 1.0, 3.7, 40.0])
    value, slope, bend = jets.gammaln_derivatives(z)
    assert value == pytest.approx([math.lgamma(v) for v in z], rel=1e-12, abs=1e-12)
    euler = 0.5772156649015329
    assert slope[1:3] == pytest.approx([-euler - 2 * math.log(2), -euler], rel=1e-13)
    assert bend[1:3] == pytest.approx([math.pi ** 2 / 2, math.pi ** 2 / 6], rel=1e-13)


def _jet_of_hypergeometric(b, c, z):
    one = jets.variables([1.0, 1.0, 1.0])
    inner = [v + (np.asarray(x) - 1.0) for v, x in zip(one, (b, c, z))]
    return jets.log_hyp2f1_one(*inner)


def test_hypergeometric_derivatives():
    """Values against the library's function, slopes against differences of values, bends against those of slopes."""
    rng = np.random.default_rng(11)
    b = rng.uniform(0.3, 6, 200)
    c, z = b + rng.uniform(0.6, 9, 200), rng.uniform(0.01, 0.97, 200)
    z[:3] = 0.0999999, 0.1000001, 0.02
    here = _jet_of_hypergeometric(b, c, z)
    assert here.value == pytest.approx(np.log(hyp2f1_one(b, c, z)), abs=1e-13)
    for k in range(3):
        move = [1e-5 * (i == k) for i in range(3)]
        up = _jet_of_hypergeometric(b + move[0], c + move[1], z + move[2])
        down = _jet_of_hypergeometric(b - move[0], c - move[1], z - move[2])
        assert here.gradient[k] == pytest.approx((up.value - down.value) / 2e-5, rel=1e-5, abs=1e-7)
        for place, (i, j) in enumerate(jets.pairs(3)):
            if k in (i, j):
                other = j if k == i else i
                slope = (up.gradient[other] - down.gradient[other]) / 2e-5
                assert here.hessian[place] == pytest.approx(slope, rel=1e-4, abs=1e-6)


@pytest.mark.parametrize("model", [BG, PARETO, ParetoNbd(0.5, 11.0, 0.7, 4.0), ParetoNbd(1.0, 1.0, 1.0, 1.0), GG])
def test_slopes_of_the_likelihood(spark, model):
    """One pass gives the value that the plain likelihood has, and its derivatives."""
    family, p = type(model), np.array(list(vars(model).values()))
    rng = np.random.default_rng(2)
    data = [(float(rng.integers(1, 6)), float(t * rng.uniform(0.1, 1)), float(t), float(rng.gamma(3, 10) + 0.1))
            for t in rng.uniform(5, 40, 150)]
    data += [(2.0, 9.0, 9.0, 5.0)] * 2 + ([] if family is GammaGamma else [(0.0, 0.0, 20.0, 0.0)])
    rows = sufficient_rows(spark.createDataFrame(
        data, "frequency double, recency double, T double, monetary_value double"), family).cache()
    likelihood, unit = Likelihood(rows, family), np.eye(len(p)) * 1e-4
    here, *around = likelihood.slopes([p, *(p + e for e in unit), *(p - e for e in unit)])
    plain = likelihoods(rows, family, [dict(zip(likelihood.names, map(float, q)))
                                       for q in (p, *(p + e for e in unit), *(p - e for e in unit))])
    up, down = slice(1, 1 + len(p)), slice(1 + len(p), None)
    assert here.value == pytest.approx(plain[0], rel=1e-12)
    assert here.gradient == pytest.approx((np.array(plain[up]) - plain[down]) / 2e-4, rel=1e-4, abs=1e-5)
    ups, downs = around[:len(p)], around[len(p):]
    for i in range(len(p)):
        assert here.hessian[i] == pytest.approx((ups[i].gradient - downs[i].gradient) / 2e-4, rel=1e-4, abs=1e-4)


def test_customers_who_never_leave_send_a_parameter_to_the_floor(spark):
    rng = np.random.default_rng(8)
    data = [(float(x), float(t * x / (x + 1.0)), float(t)) for x, t in zip(rng.integers(4, 9, 300), rng.uniform(30, 40, 300))]
    rfm_ = spark.createDataFrame(data, "frequency double, recency double, T double")
    found = fit(BgNbd, rfm_, 0.03)
    assert found.converged and found.steps < 40
    assert found.model.a == pytest.approx(1e-8, rel=1e-6)


def test_value_fit_visits_rows_for_one_logarithm(spark):
    rows = spark.createDataFrame([(1.0, 5.0)], "frequency double, monetary_value double")
    likelihood = Likelihood(sufficient_rows(rows, GammaGamma), GammaGamma)
    assert sum(str(c).count("ln(") for step in likelihood._steps for c in step.values()) == 1
    assert "ln(" not in " ".join(map(str, likelihood._sums))
