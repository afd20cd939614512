"""Learners against plain NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticktide.models.learners import LinearLearner, NetworkLearner, feature_stats, forward_pass, train
from ticktide.models.state import ModelState, latest_models, load, to_frame
from ticktide.schemas import FEATURE_COLUMNS

WIDTH = len(FEATURE_COLUMNS)


@pytest.fixture(scope="module")
def sample(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(3.0, 2.0, (200, WIDTH))
    y = x @ draw.normal(size=WIDTH) + draw.normal(size=200)
    columns = ", ".join(f"{name} double" for name in [*FEATURE_COLUMNS, "y"])
    rows = [tuple(map(float, [*row, target])) for row, target in zip(x, y)]
    return x, y, spark.createDataFrame(rows, columns).repartition(5).persist()


def test_feature_stats_merge(sample):
    x, _, frame = sample
    n, mean, spread = feature_stats(frame)
    assert n == 200 and np.allclose(mean, x.mean(0)) and np.allclose(spread, x.var(0) * n)
    state = ModelState("m")
    for part in (x[:30], x[30:31], x[31:]):
        state.observe(len(part), part.mean(0), part.var(0) * len(part))
    assert np.allclose(state.mean, x.mean(0)) and np.allclose(state.scale(), x.std(0)) and state.seen == 200


def test_linear_gradient(sample):
    x, y, frame = sample
    learner, state = LinearLearner(), LinearLearner().start()
    state.weights = np.linspace(-1, 1, WIDTH + 1)
    z = np.hstack([x, np.ones((200, 1))])
    error = z @ state.weights - y
    got = learner.gradient(frame, state)
    assert np.allclose(got.values, (error[:, None] * z).mean(0)) and got.squared_error == pytest.approx((error**2).mean())
    predicted = learner.predict(frame, state).agg(F.sum("y_hat")).first()[0]
    assert predicted == pytest.approx((z @ state.weights).sum())


def test_network_gradient_is_the_slope_of_the_error(sample):
    x, y, frame = sample
    learner = NetworkLearner()
    state = learner.start()
    state.observe(200, x.mean(0), x.var(0) * 200)
    z = (x - state.mean) / state.scale()

    def loss(weights):
        return ((forward_pass(z, learner.layers(weights))[-1][:, 0] - y) ** 2).mean() / 2

    got = learner.gradient(frame, state)
    assert len(got.values) == learner.size == 3051
    assert got.squared_error == pytest.approx(2 * loss(state.weights))
    for at in np.random.default_rng(2).choice(learner.size, 25, replace=False):
        shift = np.zeros(learner.size)
        shift[at] = 1e-6
        slope = (loss(state.weights + shift) - loss(state.weights - shift)) / 2e-6
        assert got.values[at] == pytest.approx(slope, rel=1e-3, abs=1e-6)


def test_network_first_adam_step(sample):
    x, _, frame = sample
    learner = NetworkLearner(penalty=0.0)
    start = learner.start()
    before = start.weights.copy()
    after, gradient = train(frame, learner, start)
    assert after.step == 1 and after.fitted
    moved = after.weights - before
    used = np.abs(gradient.values) > 1e-2
    assert np.allclose(moved[used], -learner.rate * np.sign(gradient.values[used]), rtol=1e-3)
    predicted = learner.predict(frame, after).agg(F.sum("y_hat")).first()[0]
    z = (x - after.mean) / after.scale()
    assert predicted == pytest.approx(forward_pass(z, learner.layers(after.weights))[-1].sum())


@pytest.mark.parametrize("learner", [LinearLearner(rate=0.2, power=0.0), NetworkLearner(rate=0.005)])
def test_training_lowers_the_error(sample, learner):
    _, _, frame = sample
    state, errors = learner.start(), []
    for _ in range(8):
        state, gradient = train(frame, learner, state)
        errors.append(gradient.squared_error)
    assert errors[-1] < errors[0] * 0.9 and errors[-1] == min(errors)


def test_empty_batch_trains_nothing(sample):
    _, _, frame = sample
    learner = LinearLearner()
    state, gradient = train(frame.limit(0), learner, learner.start())
    assert gradient is None and not state.fitted


def test_state_round_trip(spark):
    learner = NetworkLearner()
    old, new = learner.start(), learner.start()
    old.version, new.version, new.step = 1, 2, 9
    frame = to_frame(spark, [new, old])
    assert latest_models(frame).count() == 1
    found = load(frame, "mlp")
    assert (found.version, found.step, found.fitted) == (2, 9, True) and np.array_equal(found.weights, new.weights)
    assert load(frame, "sgd") is None
